"""Connected components by alternating large and small stars.

Each half step joins the edges with one minimum per node, so no node's neighbours are gathered,
and each round is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node of its component for every node but those: node, component."""

    def mark(e):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    kept = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    kept = materialize(kept)
    before = mark(kept)
    while True:
        both = kept.unionByName(kept.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        kept = materialize(small)
        after = mark(kept)
        if after == before:
            return kept.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after
