"""Sharding by proportional stratified interleaving.

The rows of each source are put into a seeded random order.  Row ``r`` of a source of ``c`` rows
gets the fractional rank ``(2 r - 1) / (2 c)``, so every source is spread evenly over (0, 1).
All rows sorted by that number are cut into equal runs: each shard holds every source in
proportion to its size, within a few rows, and shard counts are at most one apart.

Neither order needs a large group.  A source is cut by its hash into about ``sqrt(rows)`` buckets of
about ``sqrt(rows)`` rows; ranks run inside a bucket and the counts of earlier buckets are added.
Fractional ranks are even by construction, so the global order is cut in the same way.  Texts are
read once and never shuffled; what is shuffled has the same few bytes for every row.

Rows equal in id, source, size and checksum are counted before they are shuffled and share one
place in the order of their source, one rank after the other, so a row that repeats a million
times is one row until its ranks are dealt out, in runs of ``RUN``.

Defined results: a NULL text has no bytes and the checksum of the empty text; NULL is a source of
its own; a NULL id is an id like any other; repeated rows get ranks of their own; shards beyond the
number of rows stay empty; an empty table gives an empty result.  Equal input gives equal output,
whatever the order of its rows.  Only id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.text import code_point_key, whole
from tidemark.session import materialize

SHARDS = 40
#: Bytes that a row takes besides its text.
OVERHEAD = 16
#: Ranks of one repeated row that a task deals out at once.
RUN = 1 << 16
# Values of the leading hash digits that choose a bucket.
_LEADS = 1 << 32

_KEY = ["id", "skey", "size", "crc"]


def row_key(id: Column, text: Column, source: Column) -> list[Column]:
    """What tells rows apart: id, source, size and checksum."""
    return [
        id.alias("id"),
        code_point_key(source).alias("skey"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.crc32(whole(text)).alias("crc"),
    ]


def shuffle_order(seed: int) -> Column:
    """Hex digits that put the rows of a source into a seeded random order."""
    parts = [F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("size").cast("string"), F.col("crc").cast("string")]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def stratified_shards(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shards: int = SHARDS,
    seed: int = 42,
) -> DataFrame:
    """One row per row of ``docs``: id, skey, size, crc, nth (of rows with this key, from 1), rank (in
    its source), source_rows, position (in the global order), shard, slot (place in the shard)."""
    keys = docs.select(*row_key(F.col(id), F.col(text), F.col(source)))
    stored = materialize(keys.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("times")))
    rows = stored.agg(F.sum("times")).first()[0] or 0
    buckets = max(1, int(rows**0.5))
    lead = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    counted = stored.withColumn("order", shuffle_order(seed)).withColumn("bucket", F.floor(lead * buckets / _LEADS))

    # One row per source and bucket; per source about sqrt(rows) at most.
    sums = counted.groupBy("skey", "bucket").agg(F.sum("times").alias("n"))
    by_source = Window.partitionBy("skey")
    upto = by_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    skips = sums.select(
        "skey", "bucket", (F.sum("n").over(upto) - F.col("n")).alias("skip"), F.sum("n").over(by_source).alias("source_rows")
    )
    inside = Window.partitionBy("skey", "bucket").orderBy("order", "id", "size", "crc")
    upto_row = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = materialize(
        counted.withColumn("before", F.sum("times").over(upto_row) - F.col("times"))
        .join(skips, ["skey", "bucket"])
        .select(*_KEY, "times", "source_rows", (F.col("before") + F.col("skip")).alias("before"))
    )

    # 2 r - 1 over 2 c, for each of the row's ranks r.
    fraction = (2 * F.col("rank") - 1) / (2 * F.col("source_rows"))
    ranked = _dealt(placed).withColumn("fraction", fraction)
    sliced = materialize(ranked.withColumn("slice", F.floor(F.col("fraction") * buckets)))
    slices = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    # One row per slice, about sqrt(rows) of them.
    upto_slice = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = slices.select("slice", (F.sum("n").over(upto_slice) - F.col("n")).alias("skip"))
    in_slice = Window.partitionBy("slice").orderBy("fraction", "skey", "rank")
    positioned = sliced.withColumn("row", F.row_number().over(in_slice)).join(offsets, "slice")
    position = F.col("row") - 1 + F.col("skip")
    # Position p of n rows lies in shard p * shards div n, which begins at ceil(shard * n / shards).
    begin = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    return (
        positioned.select(*_KEY, "nth", "rank", "source_rows", position.cast("long").alias("position"))
        .withColumn("shard", F.expr(f"cast((position * {shards}L) div {max(rows, 1)}L as int)"))
        .withColumn("slot", F.col("position") - begin)
        .withColumnRenamed("id", id)
    )


def _dealt(placed: DataFrame) -> DataFrame:
    """One row per rank.  Runs of a row that repeats very often are spread over tasks first."""
    firsts = F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(RUN).cast("long"))
    often = placed.where(F.col("times") > RUN).withColumn("first", F.explode(firsts)).repartition("id", "crc", "first")
    runs = placed.where(F.col("times") <= RUN).withColumn("first", F.lit(0).cast("long")).unionByName(often)
    each = F.explode(F.sequence(F.col("first") + 1, F.least(F.col("first") + RUN, "times")))
    return runs.select(*_KEY, "source_rows", "before", each.alias("nth")).select(
        *_KEY, "source_rows", "nth", (F.col("before") + F.col("nth")).alias("rank")
    )


def sharded_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", shards: int = SHARDS, seed: int = 42
) -> DataFrame:
    """The rows of ``docs`` as structs ``row``, with ``shard`` and ``slot``.

    Repeated rows are told apart by a number that counts them per stored partition first, so no
    group of them meets in one task.
    """
    # A column the key is made of may share its name with a key column: the row is one struct.
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *row_key(F.col(id), F.col(text), F.col(source)))
    stored = materialize(keyed.withColumn("part", F.spark_partition_id()))
    found = stratified_shards(docs, id, text, source, shards, seed).withColumnRenamed(id, "id")
    counts = stored.groupBy(*_KEY, "part").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*_KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    skips = counts.select(*_KEY, "part", (F.sum("n").over(upto) - F.col("n")).alias("skip"))
    local = F.row_number().over(Window.partitionBy(*_KEY, "part").orderBy(F.lit(0)))
    left = stored.withColumn("local", local).alias("l").join(skips.alias("s"), _same("l", "s", [*_KEY, "part"]))
    left = left.select("l.row", *[f"l.{k}" for k in _KEY], (F.col("local") + F.col("skip")).alias("nth"))
    both = left.alias("l").join(found.alias("r"), _same("l", "r", [*_KEY, "nth"]))
    return both.select("l.row", "r.shard", "r.slot")


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """Write the rows of ``docs`` as Parquet, one folder ``shard=N`` per shard, rows by slot."""
    found = sharded_documents(docs, **how)
    rows = found.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.select("row", "slot", "shard").write.partitionBy("shard").parquet(path)


def _same(a: str, b: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out
