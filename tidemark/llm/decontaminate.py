"""Benchmark decontamination with suffix arrays of the training text.

A run of documents (a shard) gets a suffix array over its words.  Every suffix of every test item
is searched in it by bisection: the first ``window`` words of the suffix bound a range of the
array, which holds all places where they occur verbatim.  The array is sparse: a suffix that does
not begin with the first words of any test suffix can be in no such range, so it is left out, and
what is sorted is about as much as there are matches.  Places whose words before differ are where a
verbatim match begins; it is extended to its last common word, and the longest match of every
document and item is given with both its places.

Test items are read in blocks of a bounded size, each block broadcast and searched in one pass
over the documents.  Passes after the first give rows only for documents with matches.  Documents
are never shuffled.

Defined results: a NULL text has no words and is never contaminated; an item with fewer words than
the window, but not none, is one window; NULL items and items without words match nothing;
repeated rows get the same result; an id in several rows of items is listed once; no items, no
matches.  Only the id and the text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.arrays import ALNUM, expanded, raw, runs, words
from tidemark.llm.encoder import slices
from tidemark.llm.text import rows_without
from tidemark.session import materialize

WINDOW = 13
# Text of the test items that is broadcast at once, as some 15 times as many bytes.
BLOCK_BYTES = 4 << 20
# Pairs of places that are listed at once before those within a match are left out.
PAIRS = 1 << 20
SHARD_BYTES = 4 << 20
# Words by which suffixes are chosen for the array.
LEAD = 3


@dataclass
class Suffixes:
    """Distinct windows of a block of test items."""

    vocabulary: np.ndarray  # hashes of the words, ascending; a word's number is its place + 1
    windows: dict[int, np.ndarray]  # by length: rows of word numbers, distinct
    leads: np.ndarray  # hashes of the first words of the windows, ascending
    lead: int
    item_bounds: dict[int, np.ndarray]  # by length: bounds of each window's occurrences ...
    items: dict[int, np.ndarray]  # ... in this list of places in ``numbers``, ascending per window
    numbers: np.ndarray  # word numbers of all items
    bounds: np.ndarray  # of each item's words


def suffixes_of(texts: list[str | None], window: int = WINDOW) -> Suffixes:
    data, bounds = raw(pa.array(texts, pa.large_string()))
    found = words(data, bounds, ALNUM)
    vocabulary, number = np.unique(found.hashes, return_inverse=True)
    number, counts = number.ravel() + 1, found.counts
    windows, item_bounds, items, leads = {}, {}, {}, []
    lead = min([LEAD, *counts[counts > 0].tolist()])
    for length in sorted({min(window, int(c)) for c in np.unique(counts) if c}):
        of = counts >= window if length == window else counts == length
        starts = expanded(found.bounds[:-1][of], counts[of] - length + 1)
        rows = number[starts[:, None] + np.arange(length)]
        distinct, which = np.unique(rows, axis=0, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        windows[length] = distinct.astype(np.int32)
        item_bounds[length] = np.searchsorted(which.ravel()[order], np.arange(len(distinct) + 1)).astype(np.int32)
        items[length] = starts[order].astype(np.int32)
        leads.append(runs(found.hashes, lead)[starts])
    joined = np.unique(np.concatenate(leads)) if leads else np.zeros(0, np.uint64)
    return Suffixes(vocabulary, windows, joined, lead, item_bounds, items, number.astype(np.int32), found.bounds)


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Whether each value is in the ascending list; most are told apart by their last 20 bits."""
    if not len(listed):
        return np.zeros(len(values), bool)
    low = np.zeros(1 << 20, bool)
    low[(listed & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    out = low[(values & np.uint64((1 << 20) - 1)).astype(np.int64)]
    at = np.flatnonzero(out)
    place = np.minimum(np.searchsorted(listed, values[at]), len(listed) - 1)
    out[at] = listed[place] == values[at]
    return out


def _key(numbers: np.ndarray, depth: int, fill: int) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like them, filled up to ``depth`` words."""
    wide = np.full((len(numbers), depth), fill, ">u4")
    wide[:, : numbers.shape[1]] = numbers
    return np.ascontiguousarray(wide).view(f"S{4 * depth}").ravel()


def search(texts: pa.Array, test: Suffixes):
    """The texts' words; (place, length) of each window found; and for every text and item with a
    common window the longest match: text, item, place, place in the item, length."""
    data, bounds = raw(texts)
    found = words(data, bounds, ALNUM)
    owner = found.owner
    ends = found.bounds[1:][owner] if len(owner) else owner
    places = np.flatnonzero(_among(runs(found.hashes, test.lead), test.leads))
    hits, begun = [], []
    if len(places) and test.windows:
        depth = max(test.windows)
        at = np.searchsorted(test.vocabulary, found.hashes)
        known = np.minimum(at, len(test.vocabulary) - 1)
        number = np.where(test.vocabulary[known] == found.hashes, known + 1, 0)
        ahead = places[:, None] + np.arange(depth)
        suffix = np.where(ahead < ends[places][:, None], number[np.minimum(ahead, len(number) - 1)], 0)
        keys = _key(suffix, depth, 0)
        array = np.argsort(keys, kind="stable")
        keys = keys[array]
        for length, windows in test.windows.items():
            low = np.searchsorted(keys, _key(windows, depth, 0), side="left")
            high = np.searchsorted(keys, _key(windows, depth, 0xFFFFFFFF), side="right")
            which = np.repeat(np.arange(len(windows)), high - low)
            place = places[array[expanded(low, high - low)]]
            hits.append(np.stack([place, np.full(len(place), length)], axis=1))
            before = np.where(place > found.bounds[owner[place]], number[place - 1], -1)
            begun += [(length, *pair) for pair in _beginnings(place, before, which, length, test)]
    hits = np.concatenate([np.zeros((0, 2), np.int64), *hits])
    hits = hits[np.argsort(hits[:, 0], kind="stable")]
    if not begun:
        return found, hits, np.zeros((0, 5), np.int64)
    own = np.concatenate([b[1] for b in begun])
    item = np.concatenate([b[2] for b in begun])
    length = np.concatenate([np.full(len(b[1]), b[0]) for b in begun])
    item_of = np.searchsorted(test.bounds, item, side="right") - 1
    _extend(number, ends, own, test.numbers, test.bounds[item_of + 1], item, length)
    # The longest of a text and item; of equals the first in the text, then in the item.
    order = np.lexsort([item, own, -length, item_of, owner[own]])
    head = np.ones(len(order), bool)
    head[1:] = (np.diff(owner[own][order]) != 0) | (np.diff(item_of[order]) != 0)
    best = order[head]
    text = owner[own[best]]
    columns = [text, item_of[best], own[best] - found.bounds[text], item[best] - test.bounds[item_of[best]], length[best]]
    return found, hits, np.stack(columns, axis=1)


def _beginnings(place, before, which, length: int, test: Suffixes):
    """Pairs of a place in the texts and one in the items where a window's match begins, that is, where
    the words before differ.  ``which`` ascends; ``before`` holds the number of the word before, 0 if
    no item has it and -1 at the start of a text."""
    listed, bounds = test.items[length], test.item_bounds[length]
    first = np.isin(listed, test.bounds[:-1])
    earlier = np.where(first, -2, test.numbers[np.maximum(listed, 1) - 1])
    counts = np.bincount(which, minlength=len(bounds) - 1)
    product = counts * np.diff(bounds)
    low = np.cumsum(counts) - counts
    large = product > PAIRS
    # Windows with few pairs, a run of them at a time.
    small = np.flatnonzero((product > 0) & ~large)
    group = np.cumsum(product[small]) // PAIRS
    for g in np.unique(group):
        own = small[group == g]
        rows = expanded(low[own], counts[own])
        window = which[rows]
        each = np.diff(bounds)[window]
        left, right = np.repeat(rows, each), expanded(bounds[window], each)
        kept = before[left] != earlier[right]
        yield place[left[kept]], listed[right[kept]].astype(np.int64)
    for w in np.flatnonzero(large):
        rows, spots = np.arange(low[w], low[w] + counts[w]), np.arange(bounds[w], bounds[w + 1])
        for word in np.unique(before[rows]):
            mine, others = rows[before[rows] == word], spots[earlier[spots] != word]
            yield np.repeat(place[mine], len(others)), np.tile(listed[others], len(mine)).astype(np.int64)


def _extend(number, ends, own, numbers, item_ends, item, length) -> None:
    """Lengthen the matches at ``own`` and ``item`` to their last common word, in place."""
    open_ = np.arange(len(own))
    while len(open_):
        a, b = own[open_] + length[open_], item[open_] + length[open_]
        inside = (a < ends[own[open_]]) & (b < item_ends[open_])
        open_, a, b = open_[inside], a[inside], b[inside]
        same = number[a] == numbers[b]
        open_ = open_[same]
        length[open_] += 1


def _spans(found, hits: np.ndarray):
    """Maximal runs of hit words: text, first word, word after the last (counted in the text)."""
    mark = np.zeros(len(found.hashes) + 1, np.int64)
    np.add.at(mark, hits[:, 0], 1)
    np.add.at(mark, hits[:, 0] + hits[:, 1], -1)
    hit = np.cumsum(mark)[:-1] > 0
    owner = found.owner
    fresh = np.ones(len(hit), bool)
    fresh[1:] = ~hit[:-1] | (owner[1:] != owner[:-1])
    start = np.flatnonzero(hit & fresh)
    stop = np.ones(len(hit), bool)
    stop[:-1] = ~hit[1:] | (owner[1:] != owner[:-1])
    end = np.flatnonzero(hit & stop) + 1
    text = owner[start]
    return text, start - found.bounds[text], end - found.bounds[text]


def _pass(docs: DataFrame, test, item_type: T.DataType, all_rows: bool) -> DataFrame:
    id_type = docs.schema["id"].dataType
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    places = [T.StructField(name, T.LongType()) for name in ("start", "item_start", "length")]
    match = T.StructType([T.StructField("item", item_type), *places])
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("items", T.ArrayType(item_type)),
            T.StructField("matches", T.ArrayType(match)),
        ]
    )
    arrow = [to_arrow_type(f.dataType) for f in schema]

    def lists(owner, values, n):
        """Values with ascending owners as one list per owner."""
        bounds = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), values)

    def find(batches):
        made, names = test.value
        suffixes = Suffixes(**made)
        names = pa.array(names, arrow[4].value_type)
        for batch in slices(batches, "text", SHARD_BYTES):
            found, hits, longest = search(batch.column("text"), suffixes)
            text, start, end = _spans(found, hits)
            spans = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], names=["start", "end"])
            named = names.take(pa.array(longest[:, 1]))
            matches = pa.StructArray.from_arrays(
                [named, *map(pa.array, longest[:, 2:].T)], fields=list(arrow[5].value_type)
            )
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("id").cast(arrow[0]),
                    batch.column("text_hash"),
                    pa.array(found.counts.astype(np.int64)),
                    lists(text, spans, batch.num_rows).cast(arrow[3]),
                    lists(longest[:, 0], named, batch.num_rows).cast(arrow[4]),
                    lists(longest[:, 0], matches, batch.num_rows).cast(arrow[5]),
                ],
                names=schema.names,
            )
            yield out if all_rows else out.filter(pa.array(np.isin(np.arange(batch.num_rows), text)))

    return docs.mapInArrow(find, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_words, n_hit, spans (unions of matching windows of
    any items, as word places), items (ids of the items that occur), matches (per row of items the
    longest verbatim match: item, start, item_start, length, in words) and the length of the longest."""
    spark = docs.sparkSession
    tests = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    tests = tests.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    rows = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash")
    )
    passes = []
    for block in range(blocks):
        part = tests.where(F.col("block") == block).select("item", "text").orderBy("item", "text").collect()
        # Plain arrays: workers need no class of this package to read them.
        made = vars(suffixes_of([r["text"] for r in part], window))
        test = spark.sparkContext.broadcast((made, [r["item"] for r in part]))
        found = _pass(rows, test, tests.schema["item"].dataType, all_rows=block == 0)
        # One block in memory at a time: with several, each pass is stored before the next.
        passes.append(found if blocks == 1 else materialize(found))
        if blocks > 1:
            test.destroy()
    result = passes[0] if blocks == 1 else _merged(passes)
    words_of = F.transform("spans", lambda s: s["end"] - s["start"])
    return result.select(
        F.col("id").alias(id),
        "text_hash",
        "n_words",
        F.aggregate(words_of, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        "spans",
        F.coalesce(F.array_max(F.col("matches.length")), F.lit(0)).alias("longest"),
        F.array_distinct("items").alias("items"),  # an id can stand in several rows
        "matches",
    )


def _merged(passes: list[DataFrame]) -> DataFrame:
    """Matches of all passes; spans of one document that touch or overlap become one."""
    more = passes[1]
    for p in passes[2:]:
        more = more.unionByName(p)
    more = (
        more.distinct()
        .groupBy("id", "text_hash")
        .agg(
            F.flatten(F.collect_list("spans")).alias("s2"),
            F.flatten(F.collect_list("items")).alias("i2"),
            F.flatten(F.collect_list("matches")).alias("m2"),
        )
    )
    first = passes[0].alias("a")
    both = first.join(more.alias("b"), F.expr("a.id <=> b.id AND a.text_hash <=> b.text_hash"), "left")
    merge = """
      aggregate(array_sort(concat(spans, coalesce(s2, array()))), cast(array() as array<struct<start:bigint,end:bigint>>),
        (acc, x) -> CASE WHEN size(acc) > 0 AND acc[size(acc) - 1].end >= x.start
          THEN concat(slice(acc, 1, size(acc) - 1),
                      array(named_struct('start', acc[size(acc) - 1].start, 'end', greatest(acc[size(acc) - 1].end, x.end))))
          ELSE concat(acc, array(x)) END)"""
    return both.select(
        "a.id",
        "a.text_hash",
        "n_words",
        F.expr(merge).alias("spans"),
        F.expr("concat(items, coalesce(i2, array()))").alias("items"),
        F.expr("concat(matches, coalesce(m2, array()))").alias("matches"),
    )


def is_contaminated(share: int = 20) -> Column:
    """At least one hit word, and at least one in ``share`` words is hit."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with its columns, whatever their names.

    A NULL or empty text stays; repeated rows stay or go together, and so do rows with a NULL id and
    equal texts; no rows or no items: nothing goes.
    """
    found = contamination(docs, benchmark, id, text, **how).where(is_contaminated())
    bad = materialize(found.select(F.col(id).alias("id"), "text_hash").distinct())
    return rows_without(docs, [F.col(id), F.xxhash64(F.col(text))], bad)
