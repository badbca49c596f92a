"""Token ids in a bit-packed file.

A file is a Parquet table of blocks that Spark writes, so it can lie in any store Spark reaches.
A block holds whole documents, ``BLOCK_IDS`` ids or slightly more (one long document may be more).
Its ids are stored in the fewest bits that hold the vocabulary, most significant bit first.  A
block knows its shard, its number, the position of its first id in the shard, and the ids and ends
of its documents; with the sizes of the shards before, that gives every document's place, and any
range of ids can be read by opening the blocks that cover it.

Documents are range-partitioned by id, then sorted inside each partition; a partition is a shard.
The hash of the text breaks ties, so that rows sharing an id need not share a task.  Nothing but
one row per shard is summed across shards.

Defined results: a NULL text is an empty document and has its end id only; NULL ids come first;
repeated rows are written one after the other; an empty table gives a file without blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.encoder import WordEncoder, slices, with_end

BLOCK_IDS = 1 << 16


def bit_width(vocabulary: int) -> int:
    """Fewest bits for the ids 0 ... vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each, most significant bit first."""
    if width == 16:
        return ids.astype(">u2").tobytes()
    bits = np.unpackbits(np.ascontiguousarray(ids.astype(">u4")).view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :]).tobytes()


def unpack(payload: bytes, width: int, n: int, first: int = 0) -> np.ndarray:
    """``n`` ids from the ``first`` on; only the bytes that hold them are touched."""
    if width == 16:
        return np.frombuffer(payload, ">u2", n, first * 2).astype(np.uint32)
    low, high = first * width // 8, -(-(first + n) * width // 8)
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, high - low, low))
    own = bits[first * width - low * 8 :][: n * width].reshape(n, width)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - width :] = own
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


def _block_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("payload", T.BinaryType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("ends", T.ArrayType(T.LongType())),
        ]
    )


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    vocabulary: int,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending order of the documents."""
    schema = _block_schema(docs.schema[id].dataType)
    arrow_id = to_arrow_type(docs.schema[id].dataType)
    width = bit_width(vocabulary)

    def blocks(batches):
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        names, sizes, parts, held = [], [], [], 0

        def close():
            nonlocal block, first, names, sizes, parts, held
            ids = np.concatenate(parts)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([width], pa.int32()),
                    pa.array([pack(ids, width)], pa.binary()),
                    pa.array([names], pa.list_(arrow_id)),
                    pa.array([np.cumsum(np.concatenate(sizes)).tolist()], pa.list_(pa.int64())),
                ],
                names=schema.names,
            )
            block, first = block + 1, first + len(ids)
            names, sizes, parts, held = [], [], [], 0
            return row

        encoder = WordEncoder.of_worker(tokenizer)
        for batch in slices(batches, "text"):
            counts, ids = with_end(*encoder.encode(batch.column("text")), end_id)
            own = batch.column("id").to_pylist()
            ends, at = np.cumsum(counts), 0
            while at < len(own):
                before = int(ends[at - 1]) if at else 0
                # Up to and including the document that fills the block.
                stop = min(len(own), int(np.searchsorted(ends, before + block_ids - held)) + 1)
                names += own[at:stop]
                sizes.append(counts[at:stop])
                parts.append(ids[before : int(ends[stop - 1])])
                held += int(ends[stop - 1]) - before
                at = stop
                if held >= block_ids:
                    yield close()
        if parts:
            yield close()

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(blocks, schema).write.parquet(path)


def shard_bases(blocks: DataFrame) -> DataFrame:
    """Ids before each shard; one row per shard, so one task sums them."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return sizes.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_documents(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """One row per document, from the files: id, start, n_tokens, ids_crc32."""
    blocks = spark.read.parquet(path)
    id_type = blocks.schema["ids"].dataType.elementType
    arrow_id = to_arrow_type(id_type)
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField(id, id_type),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def documents(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name, i=i: batch.column(name)[i].as_py()
                ids = unpack(get("payload"), get("width"), get("n_ids")).astype("<u4")
                ends = np.array(get("ends"), np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ends), get("shard"), np.int32)),
                        pa.array(get("ids"), arrow_id),
                        pa.array(starts + get("first")),
                        pa.array(ends - starts),
                        pa.array(crc, pa.int64()),
                    ],
                    names=schema.names,
                )

    found = blocks.mapInArrow(documents, schema)
    return found.join(shard_bases(blocks), F.col("shard") == F.col("_shard")).select(
        id, (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """The ``n`` ids from position ``start`` on, opening only the blocks that cover them."""
    blocks = spark.read.parquet(path)
    at = F.col("first") + F.col("base")
    # Places only: about n / block size rows are listed.
    cover = (
        blocks.select("shard", "block", "first", "n_ids")
        .join(shard_bases(blocks), F.col("shard") == F.col("_shard"))
        .where((at < start + n) & (at + F.col("n_ids") > start))
        .select("shard", "block", at.alias("at"))
    )
    places = {(r["shard"], r["block"]): r["at"] for r in cover.collect()}
    shards: dict[int, list[int]] = {}
    for shard, block in places:
        shards.setdefault(shard, []).append(block)
    # Literal bounds, which the reader compares with the statistics of row groups.
    wanted = F.lit(False)
    for shard, own in shards.items():
        wanted = wanted | ((F.col("shard") == shard) & F.col("block").between(min(own), max(own)))
    found = blocks.where(wanted).select("shard", "block", "n_ids", "width", "payload").collect()
    out = [np.zeros(0, np.uint32)]
    for row in sorted(found, key=lambda r: places[r["shard"], r["block"]]):
        begin = places[row["shard"], row["block"]]
        low, high = max(start, begin), min(start + n, begin + row["n_ids"])
        out.append(unpack(row["payload"], row["width"], high - low, low - begin))
    return np.concatenate(out)
