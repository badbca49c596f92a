"""Registry of queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL counterpart where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def sql_round(expr: str, places: int) -> str:
    """Round half away from zero on the shortest decimal reading of a double, as Spark does."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,15)), {places}) AS DOUBLE)"


def sql_even(expr: str, places: int) -> str:
    """Round half to even on the shortest decimal reading of a double."""
    return f"CAST(round_even(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,15)), {places}) AS DOUBLE)"
