"""Exact dedup with a heavy-hitter split.

Each text becomes a SHA-256 digest of its normalised form.  Misra-Gries summaries (Spark's
``approx_top_k_accumulate``) are taken per task, merged as a tree with ``FAN_IN`` branches, and name
every digest that holds more than ``support`` of the rows; they name ``2 / support`` digests at most,
whatever the size of the input.  Their exact counts and winners are aggregated (the verification),
and those winners, bounded in the same way, are broadcast, so that the rows of a frequent digest are
decided on the map side and never meet in one task.  All other digests are shuffled once; none of
their groups can hold more than ``support`` of the rows.

Defined results: a NULL text counts as empty; the largest id of a group stays, a NULL id only
where the group has no other; repeated rows of one id and text carry the same verdict (an id names
one document) and count in ``group_size``.  An empty table gives an empty result.  Only the id and
the text are read, so further columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.text import ascii_lower, whole
from tidemark.session import materialize

# At most 9,362 broadcast winners, and summaries of 24,576 digests.
SUPPORT = 7 / (1 << 15)
#: Summaries that one task merges.
FAN_IN = 64


def frequent_digests(digests: DataFrame, column: str, support: float = SUPPORT) -> DataFrame:
    """The values of the column that may hold more than ``support`` of the rows, and others.

    A summary with a table of ``size`` places keeps every value above ``3.5 / size`` of the rows and
    estimates counts too high by no more than that.  So fewer than ``size / 3.5`` values are estimated
    at twice that share, and all values that hold it are among them.
    """
    size = 1 << math.ceil(math.log2(7 / support) - 1e-9)
    tracked, named = size * 3 // 4, int(size / 3.5)
    lane = F.floor(F.spark_partition_id() / FAN_IN)
    summaries = digests.withColumn("lane", lane).groupBy("lane").agg(
        F.expr(f"approx_top_k_accumulate({column}, {tracked})").alias("summary")
    )
    lanes = -(-digests.rdd.getNumPartitions() // FAN_IN)
    while lanes > 1:
        lanes = -(-lanes // FAN_IN)
        summaries = summaries.groupBy(F.floor(F.col("lane") / FAN_IN).alias("lane")).agg(
            F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary")
        )
    return summaries.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {named})")["item"]).alias(column))


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    digests = materialize(
        docs.select(F.col(id).alias(id), F.sha2(ascii_lower(whole(F.col(text))), 256).alias("text_sha256"))
    )
    frequent = frequent_digests(digests, "text_sha256", support)
    winners = (
        digests.join(F.broadcast(frequent), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.max(id).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    winners = F.broadcast(materialize(winners))
    by_digest = Window.partitionBy("text_sha256")
    light = digests.join(winners, "text_sha256", "left_anti").select(
        id,
        "text_sha256",
        F.max(id).over(by_digest).alias("keep_id"),
        F.count(F.lit(1)).over(by_digest).alias("group_size"),
    )
    return (
        digests.join(winners, "text_sha256")
        .unionByName(light)
        .select(
            id,
            "keep_id",
            F.col("group_size").cast("long").alias("group_size"),
            F.col(id).eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )
