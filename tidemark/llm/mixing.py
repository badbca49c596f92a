"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order (MD5 of the id), repeated up to
``repeats`` times.  A queued copy finishes at the virtual time "words of its source up to its end,
divided by the source's target".  All copies are range-sorted by that time and taken until the
budget is reached, so every source advances in proportion to its target.

Running totals need no large group.  The shuffled order of a source is cut into about
``sqrt(rows)`` buckets of about ``sqrt(rows)`` rows: totals run inside a bucket, and the totals of
earlier buckets are added.  The global order is cut by Spark's range partitioning; only the one
partition in which the budget runs out is looked at row by row.  The driver sees one cut position.

Defined results: a NULL text has size 0; documents of size 0 are never taken; NULL is a source of
its own, last in order; repeated rows are queued one after the other.  A copy that would pass the
budget is not taken, so a source ends within about one document of its target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.text import code_point_key, row_count, word_count
from tidemark.session import materialize

WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """One row per source: its size and its target in words.

    Targets share ``share`` of all words by weight; a target stops at ``repeats`` times its
    source's size and the excess is shared again.  That fixed point is a level times the weight:
    with sources ordered by size per weight, the level is the largest of "what the sources before
    leave, per weight of the rest".  The window runs over one row per source.
    """
    totals = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("skey"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1)
    ranked = totals.select("skey", "source_size", weight.alias("w"), (F.col("source_size") * float(repeats)).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "skey")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * float(share)
    levels = ranked.select("*", ((budget - before) / rest).alias("level"))
    target = F.least(F.col("cap"), F.col("w") * F.max("level").over(everything))
    return levels.select("skey", "source_size", target.alias("target"))


def weighted_mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    repeats: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: id, skey, size, source_size, target, finish (virtual time of
    the first copy), copies taken, taken words."""
    spark = docs.sparkSession
    key = F.md5(F.coalesce(F.col(id).cast("string"), F.lit("")))
    sizes = materialize(
        docs.select(F.col(id), code_point_key(F.col(source)).alias("skey"), word_count(F.col(text)).alias("size"))
    )
    rows = row_count(sizes)
    buckets = max(1, int(rows**0.5))
    lead = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    queued = sizes.withColumn("key", key).withColumn("bucket", F.shiftright(lead * buckets, 32))

    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        queued.groupBy("skey", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .join(source_targets(sizes, weights, share, repeats), "skey")
        .drop("words")
    )
    inside = Window.partitionBy("skey", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    ran = materialize(
        queued.withColumn("run", F.sum("size").over(inside))
        .join(offsets, ["skey", "bucket"])
        .select(id, "skey", "key", "size", "source_size", "target", (F.col("run") + F.col("offset")).alias("run"))
    )

    def finish(epoch):
        return F.try_divide(epoch * F.col("source_size") + F.col("run"), F.col("target"))

    copies = ran.where("size > 0").select(
        "skey", "key", "size", "source_size", "target", "run", F.explode(F.array(*map(F.lit, range(repeats)))).alias("epoch")
    )
    order = ["finish", "key", "skey", "epoch"]
    timed = copies.select(finish(F.col("epoch")).alias("finish"), "key", "skey", "epoch", "size")
    lane = materialize(timed.repartitionByRange(*order).withColumn("lane", F.spark_partition_id()))
    budget = float(share) * (sizes.agg(F.sum("size")).first()[0] or 0)
    lanes = lane.groupBy("lane").agg(F.sum("size").alias("words"))
    before = F.coalesce(
        F.sum("words").over(Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # One row per partition of the range sort.
    crossed = lanes.select("lane", before.alias("before"), "words").where(F.col("before") + F.col("words") > budget)
    at = crossed.orderBy("lane").first()
    cut = None
    if at:
        run = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + at["before"]
        cut = (
            lane.where(F.col("lane") == at["lane"])
            .withColumn("total", run)
            .where(F.col("total") > budget)
            .orderBy(*order)
            .select(*order)
            .limit(1)
        )
        cut = cut.first()

    def is_taken(epoch):
        if cut is None:
            return F.lit(1)
        mine = F.struct(
            finish(F.lit(epoch)).alias("finish"), F.col("key"), F.col("skey"), F.lit(epoch).alias("epoch")
        )
        return (mine < F.struct(*[F.lit(cut[c]).alias(c) for c in order])).cast("int")

    taken = sum((is_taken(e) for e in range(1, repeats)), is_taken(0))
    copies_taken = F.when(F.col("size") > 0, taken).otherwise(F.lit(0))
    return ran.select(
        id, "skey", "size", "source_size", "target", finish(F.lit(0)).alias("finish"), copies_taken.alias("copies")
    ).withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes, once per copy, with the columns of ``docs``."""
    columns = docs.columns
    mixed = weighted_mix(docs, id, text, source, **how)
    twin = Window.partitionBy("_i").orderBy("_s", "_n")
    left = docs.select(
        F.struct(*columns).alias("_row"),
        F.col(id).alias("_i"),
        code_point_key(F.col(source)).alias("_s"),
        word_count(F.col(text)).alias("_n"),
    ).withColumn("_k", F.row_number().over(twin))
    right = (
        mixed.select(F.col(id).alias("_i"), F.col("skey").alias("_s"), F.col("size").alias("_n"), "copies")
        .withColumn("_k", F.row_number().over(twin))
        .select(F.col("_i").alias("_j"), F.col("_k").alias("_l"), "copies")
    )
    found = left.join(right, F.col("_i").eqNullSafe(F.col("_j")) & (F.col("_k") == F.col("_l")))
    repeated = found.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    return repeated.select(*[F.col("_row").getField(c).alias(c) for c in columns])
