"""N-gram Jaccard join by parity sketches.

A document is the set of hashes of its word n-grams.  Two sets with Jaccard similarity ``t`` or
more differ in at most ``d = s (1 - t) / t`` elements, ``s`` being the size of the smaller one.
Sizes are cut into bands; in a band the hash range is cut into more than ``d`` parts, and the
hashes of a part's elements are XORed into a 64-bit sketch.  An element that differs changes the
sketch of one part only: the distance between sketches, counted in parts, never exceeds the
symmetric difference.  So two similar sets agree in at least one part.  Sets that share a sketch
are candidates; candidates are verified on the sets themselves.

No group of candidates is expanded into all pairs.

1. Documents with equal sets are one class, represented by the smallest id.
2. In every run of representatives that share a sketch, each is verified against one of them. The
   links found give components; runs that still hold several repeat this with another member.
3. A run that lies in one component needs nothing more.  In the others, pairs across components
   are verified.  A run of more than ``LIGHT`` representatives is dealt into blocks, and a task
   compares the parity sketches of two blocks (``SKETCH_BITS`` bits of the whole set); only pairs
   that pass the Hamming bound leave it.

So every link is either verified or joins two documents that other links have joined already:
components are exact.  Sets of candidates are made again from their texts, which a Bloom filter
of bounded size and a join pick out.

Defined results: without words or text a set is empty and is linked with nothing; fewer than ``n``
words are one n-gram; rows that share an id are one node; a NULL id gets the component of its
equal copies, if any; an empty table gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.arrays import NOT_SPACE, expanded, mixed, raw, runs, words
from tidemark.llm.components import components
from tidemark.llm.encoder import slices
from tidemark.llm.text import row_count
from tidemark.llm.url_filter import BITS_PER_ENTRY, MAX_BLOCKS, _bits, _block, bloom_blocks
from tidemark.llm.text import rows_without
from tidemark.session import materialize

# Members of a run whose pairs are verified without looking at whole-set sketches first.
LIGHT = 16
# Members of a large run in one block, and the bits of a whole-set sketch.
BLOCK = 2048
SKETCH_BITS = 2048
# Members of a run against which all others are verified, one after the other.
STARS = 3
BAND_RATIO = 1.45
# Parts to spare, relative to the parts times the odds of differing elements.
SPARE = 1.6
# Elements up to which a part may be left out.
MOST_LEFT_OUT = 6
_SLICE_BYTES = 2 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def ngram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every text, ascending in each, and the bounds of each text."""
    data, bounds = raw(texts)
    found = words(data, bounds, NOT_SPACE)
    counts = found.counts
    grams = runs(found.hashes, n)
    starts = expanded(found.bounds[:-1][counts >= n], counts[counts >= n] - n + 1)
    owners = [np.repeat(np.flatnonzero(counts >= n), counts[counts >= n] - n + 1)]
    hashes = [grams[starts]]
    for short in range(1, n):
        of = np.flatnonzero(counts == short)
        if len(of):
            owners.append(of)
            hashes.append(runs(found.hashes, short, seed=short)[found.bounds[of]])
    owner, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[fresh], hashes[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def band_edges(threshold: tuple[int, int]) -> np.ndarray:
    """Smallest size of each band, from the first size at which similar sets can differ."""
    num, den = threshold
    edges = [-(-num // (den - num))]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
    return np.array(edges, np.int64)


def sketch_keys(hashes: np.ndarray, bounds: np.ndarray, threshold: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of part sketches of every set, and the bounds of each set's keys.

    ``hashes`` ascend in each set.  A set takes part in the band of its size and, as the larger one
    of a pair, in each band below of which a set can be similar to it.

    A set of size s differs from a similar one in at most ``s (1 - t) / t`` parts, so parts that
    hold few elements, and say little, need no key as long as they are fewer than the parts that
    must agree: whichever of two similar sets leaves out more of them, a part with more elements
    than it leaves out still agrees.
    """
    num, den = threshold
    edges = band_edges(threshold)
    # Most differing elements where the smaller set is the largest of its band.  So many parts are
    # made beyond that that those with few elements can be left out.
    most = (edges[1:] - 1) * (den - num) // num
    parts_of = most + 1 + np.ceil((most + 1) * SPARE * (den - num) / num).astype(np.int64)
    sizes = np.diff(bounds)
    band = np.searchsorted(edges, sizes, side="right") - 1
    owners, groups = [np.flatnonzero(band >= 0)], [band[band >= 0]]
    for down in range(1, len(edges)):
        lower = (band >= down) & (sizes * num <= (edges[np.maximum(band - down + 1, 0)] - 1) * den)
        if not lower.any():
            break
        owners.append(np.flatnonzero(lower))
        groups.append(band[lower] - down)
    owner, group = np.concatenate(owners), np.concatenate(groups)
    order = np.argsort(owner, kind="stable")
    owner, group = owner[order], group[order]
    parts = parts_of[group] if len(group) else np.zeros(0, np.int64)
    base = np.cumsum(parts) - parts
    total = int(parts.sum())
    sketch, held = np.zeros(total, np.uint64), np.zeros(total, np.int64)
    at = expanded(bounds[owner], sizes[owner])
    if len(at):
        h = hashes[at]
        k = np.repeat(parts.astype(np.uint64), sizes[owner])
        # Ascending hashes give ascending parts.
        slot = np.repeat(base, sizes[owner]) + (((h >> np.uint64(32)) * k) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        sketch[slot[first]] = np.bitwise_xor.reduceat(mixed(h ^ _GOLDEN), first)
        held[slot[first]] = np.diff(np.append(first, len(slot)))
    member = np.repeat(np.arange(len(parts)), parts)
    spare = parts - np.minimum(sizes[owner] * (den - num) // num, most[group]) - 1 if len(group) else parts
    left_out = np.full(len(parts), -1)
    for few in range(MOST_LEFT_OUT + 1):
        enough = np.bincount(member, held <= few, len(parts)) <= spare
        left_out[enough] = few
    kept = held > left_out[member]
    part = np.arange(total) - np.repeat(base, parts)
    label = group[member].astype(np.uint64) * np.uint64(1 << 40) + part.astype(np.uint64)
    keys = mixed(sketch ^ mixed(label + _GOLDEN))[kept]
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[member][kept], minlength=len(sizes)))])
    return keys, ends


def _sets(docs: DataFrame, n: int, columns: dict[str, T.DataType], make) -> DataFrame:
    """(id, text) mapped to id and further columns made from the sets of each batch."""
    schema = T.StructType([docs.schema["id"], *[T.StructField(k, v) for k, v in columns.items()]])
    arrow_id = to_arrow_type(docs.schema["id"].dataType)

    def run(batches):
        for batch in slices(batches, "text", _SLICE_BYTES):
            hashes, bounds = ngram_sets(batch.column("text"), n)
            made = make(hashes, bounds)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(arrow_id), *made], names=schema.names)

    return docs.select("id", "text").mapInArrow(run, schema)


def _longs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def _sums(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return pa.array((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))


def _maybe(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """``docs`` with a column ``maybe``, false only where the id is certainly not listed.

    A Bloom filter of bounded size tells, so that most texts need no shuffle to be told apart.
    """
    blocks, wanted = 1, min(MAX_BLOCKS, row_count(listed) * BITS_PER_ENTRY // 64 + 1)
    while blocks < wanted:
        blocks *= 2
    bloom = F.broadcast(bloom_blocks(listed, "listed", blocks))
    tested = docs.withColumns({"block": _block(F.col("id"), blocks), "want": _bits(F.col("id"))})
    hit = F.col("bits").bitwiseAND(F.col("want")) == F.col("want")
    return tested.join(bloom, "block", "left").withColumn("maybe", F.coalesce(hit, F.lit(False)))


def _picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is listed."""
    listed = ids.select(F.col("id").alias("listed"))
    possible = _maybe(docs, listed).where("maybe").select("id", "text")
    return possible.join(listed, F.col("id") == F.col("listed"), "left_semi")


def _others(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is not listed."""
    listed = ids.select(F.col("id").alias("listed"))
    tested = _maybe(docs, listed)
    possible = tested.where("maybe").select("id", "text")
    rest = possible.join(listed, F.col("id") == F.col("listed"), "left_anti")
    return tested.where("NOT maybe").select("id", "text").unionByName(rest)


def _candidate_sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """Sets of the listed documents: id, grams (64-bit hashes, ascending)."""

    def sets(hashes, bounds):
        return [pa.array([hashes[i:j].tobytes() for i, j in zip(bounds, bounds[1:])], pa.binary())]

    return _sets(_picked(docs, ids), n, {"grams": T.BinaryType()}, sets)


def _verified(sets: DataFrame, pairs: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    num, den = threshold
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("grams_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b")

    def similar(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("grams_a"), batch.column("grams_b"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) and len(y):
                    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    common = int((y[place] == x).sum())
                    keep[i] = den * common >= num * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return materialize(both.mapInArrow(similar, both.select("a", "b").schema))


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` bits, each the parity of the elements hashed to it."""
    bits = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8))


def _sketches(sets: DataFrame) -> DataFrame:
    """Parity sketches of stored sets: id, sketch."""
    schema = T.StructType([sets.schema["id"], T.StructField("sketch", T.BinaryType())])

    def run(batches):
        for batch in batches:
            made = [parity_sketch(np.frombuffer(g.as_buffer(), np.uint64)).tobytes() for g in batch.column("grams")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.binary())], names=schema.names)

    return sets.select("id", "grams").mapInArrow(run, schema)


def near_pairs(sketches, sizes, component, side, threshold) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places across components whose sketches allow the similarity.

    ``side`` is 0 for the members of a cell's first block and 1 for those of its second; in a cell
    of one block with itself all are 0.
    """
    num, den = threshold
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1) if side.any() else first
    out_a, out_b = [], []
    for at in range(0, len(first), 64):
        rows = first[at : at + 64]
        differing = np.zeros((len(rows), len(second)), np.int64)
        for word in range(sketches.shape[1]):
            differing += np.bitwise_count(sketches[rows, word][:, None] ^ sketches[second, word][None, :])
        a, b = sizes[rows][:, None], sizes[second][None, :]
        near = (differing * (num + den) <= (a + b) * (den - num)) & (den * np.minimum(a, b) >= num * np.maximum(a, b))
        near &= component[rows][:, None] != component[second][None, :]
        i, j = np.nonzero(near)
        out_a.append(rows[i])
        out_b.append(second[j])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _across_large(members: DataFrame, sketches: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs like ``_across`` that also pass the Hamming bound, for runs of any size.

    A run is dealt into blocks of about ``BLOCK`` members, and a task compares two blocks; what it
    gives are only the pairs that pass.
    """
    id_type = members.schema["id"].dataType
    arrow_id = to_arrow_type(id_type)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = members.join(sketches, "id").withColumn("blocks", blocks)
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
        "id",
        "n",
        "component",
        "sketch",
    )
    schema = T.StructType([T.StructField("a", id_type), T.StructField("b", id_type)])

    def compare(cell):
        sketch = np.frombuffer(b"".join(cell["sketch"].to_pylist()), np.uint64).reshape(cell.num_rows, -1)
        component = cell["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        i, j = near_pairs(sketch, cell["n"].to_numpy(), component, cell["side"].to_numpy(), threshold)
        ids = cell["id"].combine_chunks()
        a, b = ids.take(pa.array(i)), ids.take(pa.array(j))
        return pa.Table.from_arrays([a.cast(arrow_id), b.cast(arrow_id)], names=["a", "b"])

    found = cells.groupBy("key", "low", "high").applyInArrow(compare, schema)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _similar_sizes(n_a, n_b, threshold):
    num, den = threshold
    return den * F.least(n_a, n_b) >= num * F.greatest(n_a, n_b)


def _with_links(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Edges with the components of ``labels`` and the links of ``found``."""
    return labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found.select("a", "b"))


def _unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the runs that lie in more than one component, with component and size of the run."""
    named = members.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("component")
    )
    spread = (
        named.groupBy("key")
        .agg(F.count(F.lit(1)).alias("members"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("key", "members")
    )
    return named.join(spread, "key")


def _across(members: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs of members of one run in different components that can be similar by their sizes."""
    a = members.select("key", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"))
    b = members.select("key", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"))
    near = (F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b"))
    return a.join(b, "key").where(near & _similar_sizes(F.col("n_a"), F.col("n_b"), threshold)).select("a", "b")


def ngram_jaccard_join(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 3, threshold: tuple[int, int] = (90, 100)
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, the smallest id reachable by links
    of similarity ``threshold`` (numerator, denominator) or more."""
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def summary(hashes, bounds):
        sums = [_sums(mixed(hashes), bounds), _sums(mixed(hashes ^ _GOLDEN), bounds)]
        return [pa.array(np.diff(bounds).astype(np.int64)), *sums]

    def part_sketches(hashes, bounds):
        return [pa.array(np.diff(bounds).astype(np.int64)), _longs(*sketch_keys(hashes, bounds, threshold))]

    digest = ["d1", "d2", "n"]
    sets = materialize(_sets(texts, n, {"n": T.LongType(), "d1": T.LongType(), "d2": T.LongType()}, summary))
    classes = sets.where("n > 0").groupBy(*digest).agg(F.min("id").alias("first")).where("first IS NOT NULL")
    classes = materialize(classes)
    copies = sets.join(classes, digest).where("id != first").select("id").distinct()
    copies = materialize(copies.join(classes, F.col("id") == F.col("first"), "left_anti"))

    # Runs of two or more representatives with an equal part sketch.
    kinds = {"n": T.LongType(), "keys": T.ArrayType(T.LongType())}
    leaders = materialize(_sets(_others(texts, copies), n, kinds, part_sketches).where("id IS NOT NULL"))
    runs_of = leaders.select("id", "n", F.explode("keys").alias("key"))
    # Counted on the map side first, and joined, which Spark can split where many share a key.
    shared = runs_of.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    members = materialize(runs_of.join(shared, "key", "left_semi").select("key", "id", "n"))
    grams = materialize(_candidate_sets(texts, materialize(members.select("id").distinct()), n))

    # Stars: every run against one of its members, another one each time.
    left = members.withColumn("component", F.col("id"))
    labels = None
    for star in range(STARS):
        rank = F.col("id") if star == 0 else F.xxhash64("id", F.lit(star))
        hubs = left.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), "id", "n", "component")).alias("hub"))
        starred = (
            left.join(hubs, "key")
            .where(F.col("hub.component") != F.col("component"))
            .where(_similar_sizes(F.col("hub.n"), F.col("n"), threshold))
            .groupBy("id", F.col("hub.id").alias("hub"))
            .agg(F.count(F.lit(1)).alias("shared"))
        )
        # Of the hubs of its runs, a document is verified against the one it shares most parts with.
        best = starred.groupBy("id").agg(F.max(F.struct("shared", "hub")).alias("best")).select("id", "best.hub")
        pairs = best.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
        found = _verified(grams, pairs, threshold)
        if star and found.isEmpty():
            break
        labels = components(found if labels is None else _with_links(labels, found))
        left = materialize(_unresolved(members if star == 0 else left.select("key", "id", "n"), labels))
        if left.isEmpty():
            break

    # Runs across components: small ones pair by pair, large ones by their sketches.
    across = _across(left.where(F.col("members") <= LIGHT), threshold)
    large = left.where(F.col("members") > LIGHT)
    across = across.unionByName(_across_large(large, _sketches(grams), threshold))
    across = materialize(across.distinct())
    if not across.isEmpty():
        labels = components(_with_links(labels, _verified(grams, across, threshold)))

    named = classes.join(labels.withColumnRenamed("node", "first"), "first", "left").select(
        "d1", "d2", "n", F.coalesce("component", "first").alias("component")
    )
    own = F.col("id")
    return sets.select("id", "n", "d1", "d2").join(named, ["d1", "d2", "n"], "left").select(
        own.alias(id), F.col("n").alias("n_shingles"), F.coalesce("component", own).alias("component_id")
    )


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Rows of ``docs`` that stay when one document of each component does (the one that names it).

    The columns of ``docs`` may have any names.  Rows without text, without words or with a NULL id
    stay; repeated rows of an id stay or go together.
    """
    joined = ngram_jaccard_join(docs, id, text, **how)
    gone = joined.where(F.col(id) != F.col("component_id")).select(F.col(id).alias("id")).distinct()
    return rows_without(docs, [F.col(id)], materialize(gone))
