"""Supervised bins of one numeric column by a best-first gini tree.

The column is summed to its distinct values with running totals, written once; a split
round is then one map-side-combined scan that returns the best cut of the newest leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import count_below
from tidemark.operators.ordered import running_totals
from tidemark.session import materialize

_INF = float("inf")


@dataclass
class _Leaf:
    low: float
    high: float
    before_n: int
    before_e: int
    n: int
    events: int
    cut: dict | None = None


def tree_bins(
    df: DataFrame, n_categories: int, target: str, column: str, range_rows: int | None = None
) -> DataFrame:
    """(Leaf, Taxa_de_Evento, Volume, Lower_Bound, Upper_Bound), one row per leaf in value order."""
    spark = df.sparkSession
    x = F.col(column).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x) & F.col(target).isNotNull()).select(
        x.alias("x"), F.col(target).cast("bigint").alias("y")
    )
    steps = materialize(
        running_totals(
            rows, "x", {"n": F.count(F.lit(1)), "e": F.sum("y")}, descending=False, range_rows=range_rows
        )
    )
    whole = steps.agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("n"), F.sum("e").alias("e")
    ).first()
    if not whole["n"]:
        return _result(spark, [])
    leaves = [_Leaf(whole["lo"], whole["hi"], 0, 0, whole["n"], whole["e"])]
    fresh = leaves[:]
    while len(leaves) < n_categories:
        _find_cuts(steps, fresh)
        open_ = [leaf for leaf in leaves if leaf.cut]
        if not open_:
            break
        best = max(open_, key=lambda leaf: (leaf.cut["gain"], -leaf.low))
        fresh = _split(best)
        at = leaves.index(best)
        leaves[at : at + 1] = fresh
    return _result(spark, leaves)


def _impurity(n, e):
    """Rows times gini index; the constant factor 2 is left out.

    The product of two counts is a whole number of any size, also where both counts are literals.
    """
    events, others = e.cast("decimal(19,0)"), (n - e).cast("decimal(19,0)")
    return (events * others).cast("double") / n.cast("double")


def _find_cuts(steps: DataFrame, leaves: list[_Leaf]) -> None:
    leaves = [leaf for leaf in leaves if leaf.low < leaf.high and 0 < leaf.events < leaf.n]
    if not leaves:
        return
    asked = []
    for i, leaf in enumerate(leaves):
        n, e = F.col("cum_n") - leaf.before_n, F.col("cum_e") - leaf.before_e
        total_n, total_e = F.lit(leaf.n), F.lit(leaf.events)
        gain = _impurity(total_n, total_e) - _impurity(n, e) - _impurity(total_n - n, total_e - e)
        inside = (F.col("x") >= F.lit(leaf.low)) & (F.col("x") < F.lit(leaf.high))
        # Equal gains go to the lowest cut.
        found = F.struct(gain.alias("gain"), (-F.col("x")).alias("neg_x"), n.alias("n"), e.alias("e"))
        asked.append(F.max(F.when(inside, found)).alias(f"c{i}"))
    row = steps.agg(*asked).first()
    starts = []
    for i, leaf in enumerate(leaves):
        cut = row[f"c{i}"]
        if cut is not None:
            leaf.cut = {"gain": cut["gain"], "x": -cut["neg_x"], "n": cut["n"], "e": cut["e"]}
            starts.append(leaf)
    if starts:
        # First value right of each cut.
        nxt = steps.agg(
            *[F.min(F.when(F.col("x") > F.lit(leaf.cut["x"]), F.col("x"))).alias(f"n{i}") for i, leaf in enumerate(starts)]
        ).first()
        for i, leaf in enumerate(starts):
            leaf.cut["next"] = nxt[f"n{i}"]


def _split(leaf: _Leaf) -> list[_Leaf]:
    c = leaf.cut
    left = _Leaf(leaf.low, c["x"], leaf.before_n, leaf.before_e, c["n"], c["e"])
    right = _Leaf(
        c["next"], leaf.high, leaf.before_n + c["n"], leaf.before_e + c["e"], leaf.n - c["n"], leaf.events - c["e"]
    )
    return [left, right]


def _result(spark: SparkSession, leaves: list[_Leaf]) -> DataFrame:
    rows = []
    for i, leaf in enumerate(leaves):
        low = max(leaf.low, leaves[i - 1].high) if i else -_INF
        high = _INF if i == len(leaves) - 1 else leaf.high
        rows.append((i, leaf.events / leaf.n, leaf.n, low, high))
    schema = "Leaf int, Taxa_de_Evento double, Volume bigint, Lower_Bound double, Upper_Bound double"
    return spark.createDataFrame(rows, schema)


def apply_tree_bins(df: DataFrame, leaves: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by ``TFT_column``: how many upper bounds lie at or below the value."""
    uppers = sorted(r["Upper_Bound"] for r in leaves.select("Upper_Bound").collect())
    finite = [u for u in uppers if u != _INF]
    code = count_below(F.col(column).cast("double"), finite, inclusive=True)
    return df.withColumn(f"TFT_{column}", code).drop(column)
