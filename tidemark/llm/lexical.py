"""Ranked lexical search over FP-trees of documents.

Queries are read in blocks of a bounded size.  For a block, every document becomes the vector of its
words that some query of the block holds, with their counts; one pass over the texts makes these
vectors, which are small, and stores them.  Counts over the corpus (documents, words, documents per
word) are Spark aggregations.

A task puts its vectors into FP-trees of up to ``TREE_CELLS`` cells.  The words of a vector are ordered
from the most to the least frequent, so documents share the beginnings of their paths.  Each node
knows, for its whole subtree, the largest count of every word and the smallest length factor
``m``; a word's gain grows with its count and falls with ``m``, so these give an upper bound of every
score below the node.  Each query descends depth first, the child with the higher bound first, and
leaves out subtrees whose bound lies below its ``k``-th best score so far, which it carries from tree
to tree.  What ties with that score is still looked at, since a smaller id wins.  The best ``k``
of every task are merged by Spark.

Scores are sums of ``w * ((1000000000 * tf) div (1000 * tf + 20 * m))`` with 64-bit integers.

Defined results: NULL texts and texts without words match nothing and count nowhere; an item
without words, or with none that a document holds, has no rows; repeated rows of documents are
ranked one by one, repeated rows of items each get their own list (``item_row`` tells them apart); of
equal scores the smaller id comes first, a NULL id last.  Words are told apart by 64-bit hashes.
Only id and text of both tables are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.arrays import ALNUM, expanded, raw, words
from tidemark.llm.encoder import slices
from tidemark.session import materialize

TOP = 50
#: Text of the queries that is searched for at once.
BLOCK_BYTES = 1 << 20
#: Nodes times words of a tree, four bytes each.
TREE_CELLS = 1 << 23
#: Documents that a task searches, at most about; vectors are small, so their bytes say little.
TASK_ROWS = 10_000
#: A subtree of so few documents is not divided further.
LEAF = 16


@dataclass
class Block:
    """Distinct words of a block of queries and the words of each query."""

    vocabulary: np.ndarray  # hashes, ascending; a word's number is its place
    terms: np.ndarray  # word numbers of all queries, ascending within one
    bounds: np.ndarray  # of each query's words


def block_of(texts: list[str | None]) -> Block:
    found = words(*raw(pa.array(texts, pa.large_string())), ALNUM)
    vocabulary, number = np.unique(found.hashes, return_inverse=True)
    pairs = np.unique(np.stack([found.owner, number.ravel()], axis=1), axis=0)
    return Block(vocabulary, pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(texts) + 1)))


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """id, n (words of the text), terms (numbers of the vocabulary's words in it), counts."""
    schema = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
    )

    def find(batches):
        listed = vocabulary.value
        for batch in slices(batches, "text"):
            found = words(*raw(batch.column("text")), ALNUM)
            at = np.searchsorted(listed, found.hashes)
            at[at == len(listed)] = 0
            known = listed[at] == found.hashes if len(listed) else np.zeros(len(at), bool)
            # Text and word in one number: sorted by text, then word.
            pairs, counts = np.unique(found.owner[known] * max(1, len(listed)) + at[known], return_counts=True)
            owner, term = np.divmod(pairs, max(1, len(listed)))
            ends = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (term, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.counts.astype(np.int64)), *lists], schema=schema)

    return docs.mapInArrow(find, "id long, n long, terms array<int>, counts array<int>")


def _frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents per word of the vocabulary, summed per task first."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)
        seen = np.flatnonzero(total)
        for i in range(0, len(seen), 10_000):
            part = seen[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["term", "df"])

    sums = vectors.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for r in sums.collect():  # a row per word of the block at most
        out[r["term"]] = r["df"]
    return out


def gain(w, tf, m):
    """What a word adds to the score of a document."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Tree:
    """FP-tree of some documents.

    Documents stand in the order of their paths, so a subtree is a run of them.  Nodes with one
    child are merged with it.  ``most`` has a row of largest counts per node, a column per word.
    """

    def __init__(self, ids, absent, m, terms, counts, bounds, place, size):
        # Words by falling frequency: place is each word's rank in that order.
        owner = np.repeat(np.arange(len(ids)), np.diff(bounds))
        order = np.lexsort([place[terms], owner])
        ranked, counts = place[terms][order], counts[order]
        paths = ranked.astype(">u4").tobytes()
        docs = np.array(sorted(range(len(ids)), key=lambda d: paths[4 * bounds[d] : 4 * bounds[d + 1]]), np.int64)
        lengths = np.diff(bounds)[docs]
        entries = expanded(bounds[:-1][docs], lengths)
        self.ids, self.absent, self.m = ids[docs], absent[docs], m[docs]
        self.terms, self.counts = terms[order][entries], counts[entries]
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.size = size
        self._grow(self._shared(ranked[entries], lengths))

    def _shared(self, ranked, lengths) -> np.ndarray:
        """Length of the path that each document shares with the one before; -1 for the first."""
        shared = np.full(len(lengths), -1, np.int64)
        if len(lengths) < 2:
            return shared
        both = np.minimum(lengths[1:], lengths[:-1])
        left = expanded(self.bounds[:-2], both)
        right = expanded(self.bounds[1:-1], both)
        differs = np.flatnonzero(ranked[left] != ranked[right])
        ends = np.cumsum(both)
        # The first difference of each pair, or its end where there is none.
        first = np.append(differs, ends[-1])[np.searchsorted(differs, ends - both)]
        shared[1:] = np.minimum(first, ends) - (ends - both)
        return shared

    def _grow(self, shared) -> None:
        start, stop, children = [0], [len(shared)], [[]]
        todo = [0] if len(shared) > LEAF else []
        while todo:
            node = todo.pop()
            low, high = start[node], stop[node]
            depths = shared[low + 1 : high]
            cuts = low + 1 + np.flatnonzero(depths == depths.min())
            if depths.min() == self.bounds[low + 1] - self.bounds[low] and len(cuts) == high - low - 1:
                continue  # all the same path
            # Small neighbours among the children share a node.
            edge = low
            for end in [*cuts.tolist(), high]:
                last = children[node][-1] if children[node] else None
                if last is not None and end - start[last] <= LEAF:
                    stop[last] = end
                else:
                    children[node].append(len(start))
                    start.append(edge)
                    stop.append(end)
                    children.append([])
                edge = end
            todo += [c for c in children[node] if LEAF < stop[c] - start[c] < high - low]
        self.start, self.stop, self.children = start, stop, children
        self.least = np.array([self.m[a:b].min() for a, b in zip(start, stop)])
        self.most = np.zeros((len(start), self.size), np.int32)
        # Children come after their parents, so every row is complete before it is passed up.
        for node in range(len(start) - 1, -1, -1):
            row = self.most[node]
            if children[node]:
                self.most[children[node]].max(axis=0, out=row)
            else:
                run = slice(self.bounds[start[node]], self.bounds[stop[node]])
                np.maximum.at(row, self.terms[run], self.counts[run])

    def search(self, terms, weights, best: "Best", slot_of: np.ndarray) -> None:
        """Offer the documents to ``best`` that may be among its first.  ``slot_of``: -1 for every word."""
        tf = self.most[:, terms].astype(np.int64)
        bound = gain(weights, tf, self.least[:, None]).sum(axis=1)
        slot_of[terms] = np.arange(len(terms))
        stack = [0]
        while stack:
            node = stack.pop()
            if bound[node] < best.least:
                continue
            if self.children[node]:
                # The highest bound is popped first.
                stack += sorted((c for c in self.children[node] if bound[c] >= best.least), key=bound.__getitem__)
                continue
            low, high = self.start[node], self.stop[node]
            run = slice(self.bounds[low], self.bounds[high])
            slot = slot_of[self.terms[run]]
            hit = np.flatnonzero(slot >= 0)
            doc = np.repeat(np.arange(high - low), np.diff(self.bounds[low : high + 1]))[hit]
            gains = gain(weights[slot[hit]], self.counts[run][hit].astype(np.int64), self.m[low:high][doc])
            score = np.zeros(high - low, np.int64)
            np.add.at(score, doc, gains)
            fit = score >= best.least
            best.offer(score[fit], self.ids[low:high][fit], self.absent[low:high][fit])
        slot_of[terms] = -1


class Best:
    """The first ``k`` documents so far."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.rows = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]

    def offer(self, score, ids, absent) -> None:
        if not len(score):
            return
        rows = [np.concatenate(pair) for pair in zip(self.rows, (score, ids, absent))]
        order = np.lexsort([rows[1], rows[2], -rows[0]])[: self.k]
        self.rows = [r[order] for r in rows]
        if len(order) == self.k:
            self.least = int(self.rows[0][-1])


def _search(vectors: DataFrame, sent, k: int) -> DataFrame:
    """The best ``k`` documents of every task for each query: query, id, score."""

    def find(batches):
        terms, bounds, weights, place = sent.value
        size = len(place)
        best = [Best(k) for _ in range(len(bounds) - 1)]
        slot_of = np.full(size, -1, np.int64)
        # A tree has at most one node per document and its inner nodes.
        limit = max(64, TREE_CELLS // max(1, 2 * size))
        kept, rows = [], 0

        def flush():
            tree = _tree(pa.Table.from_batches(kept).combine_chunks(), place)
            for q in range(len(best)):
                own = terms[bounds[q] : bounds[q + 1]]
                if len(own):
                    tree.search(own, weights[own], best[q], slot_of)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, limit - rows)
                kept.append(part)
                rows, at = rows + part.num_rows, at + part.num_rows
                if rows == limit:
                    flush()
                    kept, rows = [], 0
        if rows:
            flush()
        for i in range(0, len(best), 1000):
            lists = best[i : i + 1000]
            query = np.repeat(np.arange(i, i + len(lists)), [len(b.rows[0]) for b in lists])
            score, ids, absent = (np.concatenate([b.rows[j] for b in lists]) for j in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(ids, pa.int64(), mask=absent), pa.array(score)], names=["query", "id", "score"]
            )

    return vectors.mapInArrow(find, "query long, id long, score long")


def _tree(table: pa.Table, place: np.ndarray) -> Tree:
    def column(name, of=lambda c: c):
        return of(table.column(name).combine_chunks()) if table.num_rows else pa.array([], pa.int64())

    ids = column("id")
    terms = column("terms")
    ends = terms.value_lengths().to_numpy(zero_copy_only=False)
    return Tree(
        ids.fill_null(0).to_numpy(zero_copy_only=False),
        ids.is_null().to_numpy(zero_copy_only=False),
        column("m").to_numpy(zero_copy_only=False),
        terms.flatten().to_numpy(zero_copy_only=False),
        column("counts").flatten().to_numpy(zero_copy_only=False),
        np.concatenate([[0], np.cumsum(ends)]).astype(np.int64),
        place,
        len(place),
    )


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` best documents of every row of ``items``: item_row, item, rank, id, score."""
    spark = docs.sparkSession
    numbered = items.select(F.col(item).alias(item), F.col(item_text).alias("_text"))
    queries = materialize(numbered.withColumn("item_row", F.monotonically_increasing_id()))
    size = queries.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    queries = queries.withColumn("_block", F.pmod(F.xxhash64("item_row"), F.lit(blocks)))
    written = F.octet_length("_text") > 0  # so that a block's bytes bound its rows too
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    found = None
    for block in range(blocks):
        part = queries.where((F.col("_block") == block) & written)
        part = part.select("item_row", "_text").orderBy("item_row").collect()  # about block_bytes
        made = block_of([r["_text"] for r in part])
        rows = spark.createDataFrame([(i, r["item_row"]) for i, r in enumerate(part)], "query long, item_row long")
        vocabulary = spark.sparkContext.broadcast(made.vocabulary)
        vectors = materialize(_vectors(texts, vocabulary))
        counts = vectors.where("n > 0").agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
        df = _frequencies(vectors, len(made.vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * counts["N"] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        place = np.empty(len(df), np.int64)
        place[np.argsort(-df, kind="stable")] = np.arange(len(df))
        sent = spark.sparkContext.broadcast((made.terms, made.bounds, weights, place))
        m = F.expr(f"50 + (50 * n * {counts['N']}L) div {counts['L'] or 1}L")
        wanted = vectors.where(F.size("terms") > 0).select("id", m.alias("m"), "terms", "counts")
        # Dealt out evenly, whatever files the vectors are read from.
        wanted = wanted.repartition(-(-max(1, counts["N"]) // TASK_ROWS))
        best = materialize(_search(wanted, sent, k).join(F.broadcast(rows), "query").select("item_row", "id", "score"))
        vocabulary.destroy()
        sent.destroy()
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return queries.join(ranked, "item_row").select("item_row", item, "rank", F.col("id").alias(id), "score")
