"""Token counts of flat token files by a separator scan.

A flat file is nothing but ids, cut into equal blocks that ignore documents; only the
end-of-document id tells where one stops.  Each block is searched for it by one vectorised
comparison.  A document that runs over block ends is stitched by a prefix scan over one summary
row per block (ids, separators, place of the last separator): first inside chunks of
``CHUNK`` blocks, then over the chunks, so that no task sees all blocks of a large file.

``write_flat`` makes such files from documents: a Parquet table with the blocks' bytes, and next
to it, in a column the scan does not read, the ids of the documents that begin in a block, which
name the counted documents afterwards.

Defined results: a NULL or empty text counts 0; ids after the last separator of a file are one
document with ``ended`` false; repeated rows are counted one by one; no blocks, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.encoder import WordEncoder, slices, with_end

BLOCK_IDS = 1 << 17
# Less than elsewhere: the scan's workers stand beside the writer's.
REMEMBERED = 350_000
SLICE_BYTES = 1 << 20
CHUNK = 1024


def write_flat(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
    dtype: str = "<u2",
) -> None:
    """Encode every text, end each with ``end_id``, and write flat blocks: file, block, payload, names."""
    id_type = docs.schema[id].dataType
    arrow_id = to_arrow_type(id_type)
    schema = T.StructType(
        [
            T.StructField("file", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("payload", T.BinaryType()),
            T.StructField("names", T.ArrayType(id_type)),
        ]
    )

    def flat(batches):
        file, block, held, names = TaskContext.get().partitionId(), 0, np.zeros(0, dtype), []

        def row(ids, named):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([named], pa.list_(arrow_id)),
                ],
                names=schema.names,
            )

        # A special string in a text is ordinary text, so the end id never comes from a text.
        encoder = WordEncoder.of_worker(tokenizer, special_is_text=True, remembered=REMEMBERED)
        for batch in slices(batches, "text", SLICE_BYTES):
            counts, ids = with_end(*encoder.encode(batch.column("text")), end_id)
            own = batch.column("id").to_pylist()
            starts = len(held) + np.cumsum(counts) - counts
            held = np.concatenate([held, ids.astype(dtype)])
            cut = 0
            while len(held) - cut * block_ids >= block_ids:
                part = held[cut * block_ids : (cut + 1) * block_ids]
                low, high = np.searchsorted(starts, [cut * block_ids, (cut + 1) * block_ids])
                yield row(part, names + own[low:high])
                names, block, cut = [], block + 1, cut + 1
            names += own[int(np.searchsorted(starts, cut * block_ids)) :]
            held = held[cut * block_ids :]
        if len(held):
            yield row(held, names)

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    rows.mapInArrow(flat, schema).write.parquet(path)


def count_tokens(blocks: DataFrame, end_id: int, dtype: str = "<u2") -> DataFrame:
    """One row per document of flat files (file, block, payload): file, ordinal in the file, start,
    n_tokens without the separator, ended."""
    schema = "file int, block int, n long, seps long, last long, ends array<long>"

    def search(batches):
        for batch in batches:
            rows = {name: [] for name in ("file", "block", "n", "seps", "last", "ends")}
            for file, block, payload in zip(*(batch.column(c) for c in ("file", "block", "payload"))):
                ids = np.frombuffer(payload.as_buffer(), dtype)
                at = np.flatnonzero(ids == end_id)
                for name, value in zip(
                    rows, (file.as_py(), block.as_py(), len(ids), len(at), int(at[-1]) if len(at) else None, at)
                ):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["file"], pa.int32()),
                    pa.array(rows["block"], pa.int32()),
                    pa.array(rows["n"], pa.int64()),
                    pa.array(rows["seps"], pa.int64()),
                    pa.array(rows["last"], pa.int64()),
                    pa.array(rows["ends"], pa.list_(pa.int64())),
                ],
                names=list(rows),
            )

    found = blocks.select("file", "block", "payload").mapInArrow(search, schema)
    found = found.withColumn("chunk", F.floor(F.col("block") / CHUNK).cast("long"))
    inside = Window.partitionBy("file", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = found.select(
        "*",
        F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("ids_in"),
        F.coalesce(F.sum("seps").over(inside), F.lit(0)).alias("seps_in"),
    ).withColumn("last_in", F.col("ids_in") + F.col("last"))
    chunks = scanned.groupBy("file", "chunk").agg(
        F.sum("n").alias("n"), F.sum("seps").alias("seps"), F.max("last_in").alias("last")
    )
    earlier = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("file").orderBy("chunk").rowsBetween(1, Window.unboundedFollowing)
    chunks = chunks.select(
        "file",
        "chunk",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ids_before"),
        F.coalesce(F.sum("seps").over(earlier), F.lit(0)).alias("seps_before"),
        "last",
        F.coalesce(F.sum("n").over(later), F.lit(0)).alias("ids_after"),
    ).select(
        "file",
        "chunk",
        "ids_before",
        "seps_before",
        "ids_after",
        F.max(F.col("ids_before") + F.col("last")).over(earlier).alias("last_before"),
    )
    placed = scanned.join(chunks, ["file", "chunk"])
    base = F.col("ids_before") + F.col("ids_in")
    stitched = placed.select(
        "file",
        base.alias("base"),
        (F.col("seps_before") + F.col("seps_in")).alias("ordinal"),
        "n",
        "ends",
        # Position of the last separator before this block, -1 at the start of the file.
        F.coalesce(
            F.max(F.col("ids_before") + F.col("last_in")).over(inside), F.col("last_before"), F.lit(-1)
        ).alias("open"),
        F.lead("block").over(Window.partitionBy("file", "chunk").orderBy("block")).isNull().alias("tail"),
        "ids_after",
    )
    ended = stitched.select(
        "file", "base", "ordinal", "open", "ends", F.posexplode("ends").alias("i", "at")
    ).select(
        "file",
        (F.col("ordinal") + F.col("i")).alias("ordinal"),
        (F.when(F.col("i") > 0, F.col("base") + F.get("ends", F.col("i") - 1)).otherwise(F.col("open")) + 1).alias("start"),
        (F.col("base") + F.col("at")).alias("end"),
        F.lit(True).alias("ended"),
    )
    # What follows the last separator of a file.
    end = F.col("base") + F.col("n")
    last = F.coalesce(F.col("base") + F.get("ends", F.size("ends") - 1), F.col("open"))
    rest = stitched.where(F.col("tail") & (F.col("ids_after") == 0) & (last + 1 < end)).select(
        "file",
        (F.col("ordinal") + F.size("ends")).alias("ordinal"),
        (last + 1).alias("start"),
        end.alias("end"),
        F.lit(False).alias("ended"),
    )
    return ended.unionByName(rest).select(
        "file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "ended"
    )


def document_names(blocks: DataFrame, id: str = "doc_id") -> DataFrame:
    """Id of the document with each ordinal, from the names that ``write_flat`` keeps."""
    sized = blocks.select("file", "block", "names", F.size("names").cast("long").alias("n"))
    sized = sized.withColumn("chunk", F.floor(F.col("block") / CHUNK).cast("long"))
    inside = Window.partitionBy("file", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chunks = sized.groupBy("file", "chunk").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("file", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counted = sized.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(chunks, ["file", "chunk"])
    return counted.select(
        "file", (F.col("before") + F.col("inside")).alias("at"), F.posexplode("names").alias("i", id)
    ).select("file", (F.col("at") + F.col("i")).alias("ordinal"), id)


def document_token_counts(docs: DataFrame, path: str, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` as flat files below ``path`` and count each document's tokens by scanning them."""
    write_flat(docs, path, tokenizer, end_id, id, text)
    blocks = docs.sparkSession.read.parquet(path)
    return count_tokens(blocks, end_id).join(document_names(blocks, id), ["file", "ordinal"])
