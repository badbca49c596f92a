"""Whitening, lexical search and sharding against plain Python and numpy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import lexical, queries, sharding, whitening
from tidemark.llm.lexical import ranked_search
from tidemark.llm.sharding import sharded_documents, stratified_shards, write_shards
from tidemark.llm.whitening import embedding_whitening, fit_whitening, fixed_point

SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}

# Whitening


def brute_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1], found[:, ::-1]
    return (centred @ found[:, :k]) / np.sqrt(values[:k]), values[:k] / values.sum(), ((n * x - sums) ** 2).sum(axis=1)


def vectors_of(spark, rows, kind="float"):
    """Vectors with extra columns whose names clash with results and inner names."""
    return spark.createDataFrame(
        [(i, v, "x", 1, 2.0) for i, v in rows], f"vec_id long, embedding array<{kind}>, id string, component int, x double"
    )


def test_whitening_of_the_table(spark):
    got = queries.op11_embedding_whitening(spark, SF).collect()
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want, explained, deviation = brute_whitening([r["embedding"] for r in given])
    place = {r["vec_id"]: i for i, r in enumerate(given)}
    assert len(got) == 8 * len(given)
    found = np.zeros_like(want)
    for r in got:
        found[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[place[r["vec_id"]]] and r["n"] == len(given)
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-12)
        assert r["identity_error"] < 1e-12
    assert np.abs(found * np.sign((found * want).sum(axis=0)) - want).max() < 1e-9


def test_whitening_ends_early_only_when_settled(spark):
    rng = np.random.default_rng(3)
    scale = np.concatenate([2.0 ** -np.arange(10), np.full(50, 1e-2)])
    vectors = (rng.standard_normal((400, 60)) * scale @ np.linalg.qr(rng.standard_normal((60, 60)))[0]).tolist()
    stored = fixed_point(vectors_of(spark, list(enumerate(vectors)), "double"), "vec_id", "embedding").cache()
    fit = fit_whitening(stored, 400, 60, components=3)
    assert fit.steps < 50
    want, explained, _ = brute_whitening(vectors, 3)
    assert fit.explained == pytest.approx(explained, rel=1e-12)
    x = np.floor(1024 * np.array(vectors)) + 100_000
    got = (x - x.mean(axis=0)) @ fit.components.T / np.sqrt(fit.variances)
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8


def test_whitening_of_equal_deviations(spark):
    # Three components of one deviation: a single starting vector would find one of them.
    points = [s * np.eye(5)[i] * (8 if i < 3 else 1) for i in range(5) for s in (-1, 1)]
    fit = fit_whitening(fixed_point(vectors_of(spark, [(i, p.tolist()) for i, p in enumerate(points)]), "vec_id", "embedding"), 10, 5, 4)
    assert fit.variances[:3] == pytest.approx([fit.variances[0]] * 3)
    assert fit.variances[3] < fit.variances[0] / 50
    assert fit.components @ fit.components.T == pytest.approx(np.eye(4), abs=1e-12)


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.standard_normal(4).tolist()) for i in range(30)]
    good += [(3, good[3][1]), (None, [0.5, 0.25, 0.0, 1.0]), (50, [-0.0, 1e-30, 3.0, -2.0])]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0, 3.0]), (93, [1.0, math.nan, 0.0, 0.0]), (94, [math.inf, 0.0, 0.0, 0.0]), (95, [1.0, 2.0])]
    got = embedding_whitening(vectors_of(spark, good + odd, "double")).collect()
    assert len(got) == 4 * len(good) and {r["component"] for r in got} == {1, 2, 3, 4}
    want, explained, deviation = brute_whitening([v for _, v in good], 4)
    assert sorted((str(r["vec_id"]), int(r["deviation"])) for r in got if r["component"] == 1) == sorted(
        (str(i), int(d)) for (i, _), d in zip(good, deviation)
    )
    for k in range(4):
        values = sorted(abs(r["whitened"]) for r in got if r["component"] == k + 1)
        assert values == pytest.approx(sorted(np.abs(want[:, k])), abs=1e-9)


def test_whitening_without_deviation(spark):
    assert embedding_whitening(vectors_of(spark, [])).collect() == []
    assert embedding_whitening(vectors_of(spark, [(1, None)])).collect() == []
    one = embedding_whitening(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["deviation"]) for r in one] == [
        (1, None, 0.0, 0), (2, None, 0.0, 0), (1, None, 0.0, 0), (2, None, 0.0, 0)
    ]
    # Two dimensions that move together and a constant one: one component.
    line = embedding_whitening(vectors_of(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)])).collect()
    assert {r["component"]: r["explained"] for r in line} == {1: pytest.approx(1.0), 2: 0.0, 3: 0.0}
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line)
    assert {r["identity_error"] for r in line}.pop() < 1e-12


def test_whitening_sums_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows = vectors_of(spark, [(i, [i % 7 + 0.5, i % 5 * 1.0, i % 3 * 2.0]) for i in range(60)]).repartition(9)
    got = embedding_whitening(rows)
    want, explained, _ = brute_whitening([[i % 7 + 0.5, i % 5 * 1.0, i % 3 * 2.0] for i in range(60)], 3)
    assert {r["component"]: r["explained"] for r in got.collect()} == pytest.approx({i + 1: e for i, e in enumerate(explained)})


def test_whitening_exact_beyond_64_bits():
    y = np.array([[3_000_000_000, -4_000_000_000, 7], [1, 2, 3]], np.int64)
    assert [int(s) for s in whitening._squares(y)] == [9 * 10**18 + 16 * 10**18 + 49, 14]


# Lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        found = []
        for i, b in bags:
            m = 50 + 50 * sum(b.values()) * len(bags) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m))
                for t in terms
                if t in b
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        found.sort()
        out += [(item, n + 1, f[3], -f[0]) for n, f in enumerate(found[:k])]
    return sorted(out, key=str)


def search(spark, docs, items, **how):
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, item_id string, rank int, id long")
    b = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, score int")
    got = ranked_search(d, b, **how).select("item_id", "rank", "doc_id", "score")
    return sorted(map(tuple, got.collect()), key=str)


def corpus(seed, rows):
    rng = random.Random(seed)
    words = ["The", "of", "x1", "É", "zz", *[f"w{i}" for i in range(120)]]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 60)))) for i in range(rows)], rng, words


@pytest.mark.parametrize("cells", [1 << 23, 64])
def test_search_like_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(lexical, "TREE_CELLS", cells)
    docs, rng, words = corpus(1, 700)
    docs += [(1000 + i, docs[5][1]) for i in range(150)]  # ties: smaller ids win
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 20)))) for i in range(25)]
    assert search(spark, docs, items, k=7) == brute_search(docs, items, 7)


def test_search_in_blocks(spark):
    docs, rng, words = corpus(2, 200)
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(12)]
    assert search(spark, docs, items, block_bytes=100) == brute_search(docs, items, 50)


def test_search_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "...\n"), (4, "Ab ab AB"), (4, "Ab ab AB"), (None, "ab"), (7, "Éa éa"), (8, "ab " * 40_000)]
    docs += [(9, "q" * 100_000 + " ab"), (10, "only")]
    items = [(1, "ab"), (1, "AB, ab!"), (2, None), (3, ""), (4, "absent"), (5, "Éa"), (None, "only"), (6, "q" * 100_000)]
    assert search(spark, docs, items) == brute_search(docs, items, 50)
    assert search(spark, [], items) == [] and search(spark, docs, []) == []


def test_trees_share_paths_and_bound_their_documents():
    docs, _, _ = corpus(4, 300)
    block = lexical.block_of([" ".join(t for _, t in docs)])
    numbers = {}
    bags = []
    for _, t in docs:
        bags.append(Counter(numbers.setdefault(w, len(numbers)) for w in t.split()))
    terms = np.array([t for b in bags for t in sorted(b)])
    counts = np.array([b[t] for b in bags for t in sorted(b)])
    bounds = np.cumsum([0, *map(len, bags)])
    df = np.bincount(terms, minlength=len(numbers))
    place = np.empty(len(df), np.int64)
    place[np.argsort(-df, kind="stable")] = np.arange(len(df))
    m = np.arange(300) % 90 + 50
    tree = lexical.Tree(np.arange(300), np.zeros(300, bool), m, terms, counts, bounds, place, len(df))
    assert len(block.vocabulary) == len(numbers)
    assert sorted(tree.ids) == list(range(300)) and len(tree.start) > 20
    for node, (a, b) in enumerate(zip(tree.start, tree.stop)):
        own = [bags[i] for i in tree.ids[a:b]]
        assert tree.most[node].tolist() == [max(o[t] for o in own) for t in range(len(df))]
        assert tree.least[node] == min(m[i] for i in tree.ids[a:b])
        spans = [(tree.start[c], tree.stop[c]) for c in tree.children[node]]
        assert not spans or (spans[0][0], spans[-1][1]) == (a, b) and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    # A subtree of more than LEAF documents below the root shares the beginning of its paths.
    paths = [tuple(sorted(place[t] for t in bags[i])) for i in tree.ids]
    for node in tree.children[0]:
        own = paths[tree.start[node] : tree.stop[node]]
        assert len(own) <= lexical.LEAF or len({p[:1] for p in own}) == 1


# Sharding


def docs_of(spark, rows):
    return spark.createDataFrame(
        [(i, t, s, "x", 1, 2, 3) for i, t, s in rows],
        "doc_id long, text string, source string, id string, shard int, row int, size int",
    )


def check_shards(rows, got, shards):
    assert sorted((str(r["doc_id"]), r["size"], r["crc"]) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    held = Counter(r["shard"] for r in got)
    sizes = [held.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    for key, count in Counter(r["skey"] for r in got).items():
        own = Counter(r["shard"] for r in got if r["skey"] == key)
        # In every shard a source holds its share, within two rows.
        assert all(abs(own.get(s, 0) - count * sizes[s] / len(rows)) <= 2 for s in range(shards))
        assert sorted(r["rank"] for r in got if r["skey"] == key) == list(range(1, count + 1))


def test_shards_hold_the_mixture(spark):
    rng = random.Random(5)
    rows = [(i, f"text {i}", rng.choices(["a", "b", None, "ü"], [50, 5, 3, 1])[0]) for i in range(2000)]
    got = stratified_shards(docs_of(spark, rows)).collect()
    check_shards(rows, got, 40)
    again = stratified_shards(docs_of(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    other = stratified_shards(docs_of(spark, rows), seed=43).collect()
    assert sum(a != b for a, b in zip(sorted(map(str, got)), sorted(map(str, other)))) > 1500
    # Within a source the order is shuffled: ids and ranks go together no more than by chance.
    ranks = [r["rank"] for r in sorted((r for r in got if r["skey"] == "sa"), key=lambda r: r["doc_id"])]
    assert abs(np.corrcoef(ranks, np.arange(len(ranks)))[0, 1]) < 0.1


def test_shards_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 10)
    rows = [(None, None, None), (1, "", "a"), (2, None, "a"), (3, "é" * 50_000, "a"), (4, "x", ""), (4, "y", "")]
    rows += [(7, "same", "hot")] * 95 + [(None, f"t{i}", "a") for i in range(30)]
    check_shards(rows, stratified_shards(docs_of(spark, rows), shards=9).collect(), 9)
    assert stratified_shards(docs_of(spark, [])).collect() == []
    few = stratified_shards(docs_of(spark, rows[:3])).collect()
    assert len({r["shard"] for r in few}) == 3 and {r["slot"] for r in few} == {0}


def test_written_shards_keep_whole_rows(spark, tmp_path):
    rows = [(i, f"t{i}", f"s{i % 3}") for i in range(50)] + [(7, "same", "hot")] * 20 + [(None, None, None)]
    docs = docs_of(spark, rows)
    got = sharded_documents(docs, shards=6).collect()
    assert sorted(map(str, (r["row"] for r in got))) == sorted(map(str, docs.collect()))
    assert len({(r["shard"], r["slot"]) for r in got}) == len(rows)
    path = f"{tmp_path}/shards"
    write_shards(docs, path, shards=6)
    slots = Counter()
    for s in range(6):
        part = pq.read_table(f"{path}/shard={s}").to_pylist()
        slots[s] = len(part)
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    assert sum(slots.values()) == len(rows) and max(slots.values()) - min(slots.values()) <= 1
