"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row of each key in the given order.

    ``min`` over a struct combines on the map side, so a key holding a large share of the
    rows shrinks to one row per task before the shuffle; a ranking window would sort them all
    in one task.  ``order`` should be total, otherwise ties fall to the smallest remaining values.
    """
    return _keep(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Last row of each key in the given order."""
    return _keep(df, keys, order, F.max)


def _keep(df, keys, order, pick):
    rest = [c for c in df.columns if c not in keys]
    rank = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    packed = F.struct(*rank, F.struct(*rest).alias("_row")) if rest else F.struct(*rank)
    kept = df.groupBy(*keys).agg(pick(packed).alias("_kept"))
    picked = [F.col(f"_kept._row.{c}").alias(c) for c in rest]
    return kept.select(*keys, *picked).select(*df.columns)
