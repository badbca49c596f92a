"""N-gram join, decontamination, quality classifier and pipeline against brute force."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import decontaminate, ngram_join, quality, queries
from tidemark.llm.arrays import NOT_SPACE, words
from tidemark.llm.components import components
from tidemark.llm.decontaminate import contamination, is_contaminated, remove_contaminated
from tidemark.llm.ngram_join import ngram_jaccard_join, one_of_each

SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_components(rows, n, num, den):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and den * len(a & b) >= num * len(a | b):
                low, high = sorted((top(i), top(j)))
                parent[high] = low
    return sorted((i, len(s), top(i)) for i, s in sets)


def family(rng, size, words_each, edits, vocabulary=400):
    """Texts that differ from one original in up to ``edits`` words."""
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(words_each)]
    out = []
    for _ in range(size):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a", "A", "a b", "A  b", "a b c", "b a"]
    for size, length, edits in ((12, 30, 2), (40, 120, 3), (60, 150, 9), (8, 1500, 60), (6, 12, 1)):
        texts += family(rng, size, length, edits)
    shared = " ".join(f"s{i}" for i in range(60))
    texts += [f"{shared} " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(8))) for _ in range(50)]
    texts += [" ".join(f"z{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    texts += rng.sample(texts, 20)
    rng.shuffle(texts)
    return [(i * 7 - 50, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("n,num,den,light,block,stars", [(3, 90, 100, 16, 2048, 3), (5, 80, 100, 2, 7, 1)])
def test_join_equals_all_pairs(spark, monkeypatch, n, num, den, light, block, stars):
    monkeypatch.setattr(ngram_join, "LIGHT", light)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "STARS", stars)
    rows = corpus(n)
    docs = spark.createDataFrame([(i, t, 5, "c") for i, t in rows], "doc_id long, text string, n int, component_id string")
    got = sorted(map(tuple, ngram_jaccard_join(docs, n=n, threshold=(num, den)).collect()))
    assert got == brute_components(rows, n, num, den)


def test_similar_sets_share_a_part():
    rng = np.random.default_rng(3)
    for size in (9, 10, 17, 40, 400, 3000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            differ = (len(a) - (-(-9 * len(a) // 10))) // 2
            b = a.copy()
            b[rng.choice(len(a), differ, replace=False)] = rng.integers(0, 1 << 63, differ, dtype=np.uint64)
            b = np.unique(b)
            common = len(np.intersect1d(a, b))
            if 100 * common < 90 * (len(a) + len(b) - common):
                continue
            keys, ends = ngram_join.sketch_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), (90, 100))
            assert set(keys[: ends[1]]) & set(keys[ends[1] :])


def test_sets_of_far_bands_share_a_part():
    """At a similarity of a half, sizes 13 and 26 are bands apart."""
    rng = np.random.default_rng(3)
    for small in (*range(1, 40), 200):
        large = np.unique(rng.integers(0, 1 << 63, 2 * small).astype(np.uint64))
        part = np.sort(rng.choice(large, small, replace=False))
        keys, ends = ngram_join.sketch_keys(np.concatenate([part, large]), np.array([0, small, 3 * small]), (50, 100))
        assert set(keys[: ends[1]].tolist()) & set(keys[ends[1] :].tolist())


def test_join_repeated_ids_and_empty(spark):
    schema = "doc_id long, text string"
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (1, long), (None, long), (None, "alone"), (3, long + " more"), (4, None)]
    got = sorted(map(str, map(tuple, ngram_jaccard_join(spark.createDataFrame(rows, schema)).collect())))
    assert got == sorted(map(str, [(1, 48, 1), (1, 48, 1), (None, 48, 1), (None, 1, None), (3, 49, 1), (4, 0, 4)]))
    assert ngram_jaccard_join(spark.createDataFrame([], schema)).collect() == []
    kept = one_of_each(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "1", "4", "None", "None"]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (5, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 31)} | {100 + i: 100 for i in range(1, 50)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_of_long_and_sliced_texts():
    texts = ["x" * 9000, "x" * 8999 + "y", " a\tB ", "", "b" + "x" * 5000, "a"]
    from tidemark.llm.arrays import raw

    data, bounds = raw(pa.array(["zz", *texts, None]).slice(1))
    found = words(data, bounds, NOT_SPACE)
    assert found.counts.tolist() == [1, 1, 2, 0, 1, 1, 0]
    assert len(set(found.hashes.tolist())) == 5 and found.hashes[2] == found.hashes[5]


TEXT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(rows, items):
    def split(t):
        return TEXT_WORD.findall((t or "").translate(LOWER))

    windows = []
    for name, t in items:
        w = split(t)
        size = min(13, len(w))
        windows += [(name, w[i : i + size]) for i in range(len(w) - size + 1)] if w else []
    out = []
    for i, t in rows:
        w, hit, found = split(t), set(), set()
        for name, win in windows:
            for p in range(len(w) - len(win) + 1):
                if w[p : p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    found.add(name)
        out.append((i, len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def contaminated_corpus():
    rng = random.Random(5)
    items = [(i, " ".join(f"t{rng.randrange(60)}" for _ in range(rng.choice([14, 20, 40])))) for i in range(12)]
    items += [(50, "Alone"), (51, "two, words"), (52, None), (53, "..."), (54, "alone"), (55, items[0][1]), (56, "é Ö1 z")]
    rows = [(1, None), (2, ""), (3, "ALONE"), (4, "x two words y"), (5, "two x words"), (6, "w " * 20_000 + "alone")]
    for i in range(40):
        text = [f"t{rng.randrange(60)}" for _ in range(rng.randrange(60))]
        source = items[rng.randrange(12)][1].split()
        start = rng.randrange(len(source))
        text[3:3] = source[start : start + rng.randrange(20)]
        rows.append((10 + i, " - ".join(text)))
    rows += [(7, "! é  ö1? É Ö1 Z é Ö1-z"), (8, items[3][1] * 1 + " " + items[3][1]), (8, "again alone"), (None, "alone")]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 25, 300])
def test_contamination_equals_brute_force(spark, block_bytes):
    rows, items = contaminated_corpus()
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, n_hit int, spans string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(docs, tests, block_bytes=block_bytes).withColumn("bad", is_contaminated()).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], sorted(str(i) for i in r["items"]), r["bad"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, brute_contamination(rows, items)))
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"] >= r["longest"]
    kept = remove_contaminated(docs, tests, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    want = [i for (i, *_, bad) in brute_contamination(rows, items) if not bad]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, want))


@pytest.mark.parametrize("block_bytes", [1 << 25, 100])
def test_contamination_with_repeated_items(spark, block_bytes):
    """Rows of one item, equal or with different texts, list its id once, in one block or several."""
    a, b = " ".join(f"a{i}" for i in range(14)), " ".join(f"b{i}" for i in range(14))
    items = [(1, a), (1, a), (1, b), (2, b), (2, "alone"), (None, a), (None, a)]
    docs = spark.createDataFrame([(1, f"{a} {b}"), (2, "alone"), (3, f"{b} alone"), (4, "none")], "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(docs, tests, block_bytes=block_bytes).collect()
    listed = {r["doc_id"]: sorted(map(str, r["items"])) for r in got}
    assert listed == {1: ["1", "2", "None"], 2: ["2"], 3: ["1", "2"], 4: []}


def brute_matches(rows, items, window=13):
    """(doc, item, start, item_start, length) of the longest common run of every text and item."""
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    out = []
    for i, text in rows:
        a = cut.findall((text or "").translate(LOWER))
        for j, other in items:
            b = cut.findall((other or "").translate(LOWER))
            best, ahead = (0, 0, 0), [0] * (len(b) + 1)
            for p in range(len(a) - 1, -1, -1):
                now = [0] * (len(b) + 1)
                for q in range(len(b) - 1, -1, -1):
                    now[q] = ahead[q + 1] + 1 if a[p] == b[q] else 0
                    best = max(best, (now[q], -p, -q))
                ahead = now
            if b and best[0] >= min(window, len(b)):
                out.append((i, j, -best[1], -best[2], best[0]))
    return sorted(map(str, out))


@pytest.mark.parametrize("block_bytes, pairs", [(1 << 25, 1 << 20), (300, 1 << 20), (1 << 25, 3)])
def test_longest_matches_equal_brute_force(spark, monkeypatch, block_bytes, pairs):
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    rows, items = contaminated_corpus()
    long = [f"m{i}" for i in range(60)]
    items = items + [(50, " ".join(long)), (51, "x " * 40), (52, "p q " * 20), (53, " ".join(long[:20] + ["u"] + long[5:30] + long[:14]))]
    rows = rows + [
        (900, " ".join(["a"] + long[10:45] + ["b"] + long[3:20])), (901, "x " * 55), (902, "q p " * 25 + "x " * 14), (903, " ".join(long)),
        (904, " ".join(long[2:20] * 3)), (905, "x " * 12),
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, matches int").repartition(3)
    found = contamination(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()
    got = [(r["doc_id"], m["item"], m["start"], m["item_start"], m["length"]) for r in found for m in r["matches"]]
    assert sorted(map(str, got)) == brute_matches(rows, items)
    for r in found:
        assert r["longest"] == max((m["length"] for m in r["matches"]), default=0)


def test_repeated_words_give_no_square_of_pairs():
    made = decontaminate.suffixes_of(["x " * 3000], window=13)
    _, hits, longest = decontaminate.search(pa.array(["x " * 5000]), made)
    assert len(hits) == 5000 - 12 and longest.tolist() == [[0, 0, 0, 0, 3000]]


def test_contamination_without_items_or_documents(spark):
    rows, items = contaminated_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert {r["n_hit"] for r in contamination(docs, tests.where("false")).collect()} == {0}
    assert {r["n_hit"] for r in contamination(docs, tests.where("text IS NULL OR text = '...'")).collect()} == {0}
    assert contamination(docs.where("false"), tests).collect() == []


def test_suffixes_are_distinct_windows():
    made = decontaminate.suffixes_of(["a b", "B a", "a b", None, "c"], window=13)
    assert {k: len(v) for k, v in made.windows.items()} == {1: 1, 2: 2} and made.lead == 1


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op6_quality(spark, sf).collect()}
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    held = [(got[i]["score"], q) for i, q in labels if got[i]["held_out"]]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc >= 0.97
    assert np.mean([(s >= 0.7) == (q == 1) for s, q in held]) >= 0.95


def test_quality_learns_only_from_its_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    spoiled = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 4 = 2, 1 - quality, quality) AS quality")
    a, b = quality.train(docs, labels), quality.train(docs.repartition(5), spoiled)
    assert all((a.weights[k] == b.weights[k]).all() for k in a.weights)
    few = quality.train(docs, labels, sample=10)
    assert not (few.weights["E"] == a.weights["E"]).all()


def test_quality_gradients():
    rng = np.random.default_rng(0)
    x, heads, y = rng.normal(size=(9, 4)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])
    shapes = {"E": (4, 3), "e": (3,), "V": (3, 2), "U": (3, 2), "w": (2,), "c": (3,), "b": ()}
    w = {k: rng.normal(size=s) for k, s in shapes.items()}

    def loss():
        p = quality._forward(w, x, heads)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for k, g in quality._gradients(w, x, heads, y).items():
        for at in np.ndindex(w[k].shape):
            kept = w[k][at] if at else float(w[k])
            found = []
            for step in (1e-6, -1e-6):
                w[k] = w[k].copy()
                w[k][at] = kept + step
                found.append(loss())
            w[k][at] = kept
            assert (found[0] - found[1]) / 2e-6 == pytest.approx(np.asarray(g)[at], abs=1e-6)


def test_quality_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 0), (3, " \n ", None), (3, "x", 1), (None, "w " * 9000, 1), (4, "eé !!", 0)]
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(77, 1)], "doc_id long, quality int")
    for model in (quality.train(docs, labels), quality.train(docs, labels.where("false"))):
        got = quality.score(docs, model).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
        by = {r["doc_id"]: r["score"] for r in got}
        assert by[1] == by[2]
    assert quality.score(docs.where("false"), model).collect() == []
    assert quality.keep_good(docs, model, 0.0).count() == len(rows)
    assert quality.keep_good(docs, model, 0.0).columns == docs.columns


def test_pipeline_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in queries.op6_quality(spark, SF).collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert len(corpus_pipeline.STAGES) == 5
    names = [name for name, _ in corpus_pipeline.STAGES]
    docs = stages[names[0]](spark, docs, SF)
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(i for i, p in scores.items() if p)
    for k, name in enumerate(names[1:4], 1):
        before = docs.collect()
        docs = stages[name](spark, docs, SF)
        assert docs.columns == columns
        after = docs.collect()
        rows = [(r["doc_id"], r["text"]) for r in before]
        if k == 1:
            want = [i for i, _, c in brute_components(rows, 5, 80, 100) if i == c]
        elif k == 2:
            tests = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
            bad = {r[0] for r in brute_contamination(rows, tests) if r[-1]}
            want = [i for i, _ in rows if i not in bad]
        else:
            want = None
        if want is not None:
            assert sorted(r["doc_id"] for r in after) == sorted(want)
        assert {r for r in after} <= {r for r in before}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in after)


CLASH = "doc_id long, text string, lang string, source string, n_chars long, _id int, _hash string, _gone long, row int, k0 long, l0 long, id long"


def odd_documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 1, "h", 2, 3, 4, 5, 6) for i, t in rows], CLASH)


def test_pipeline_stages_on_odd_rows(spark):
    """Clashing names, NULL ids and texts, repeats and empty tables: every stage keeps the columns."""
    passage = " ".join(f"b{i}" for i in range(40))
    clean = [" ".join(f"c{j}_{i}" for i in range(30)) for j in range(4)]
    rows = [(1, passage), (1, passage), (None, passage), (2, clean[0]), (3, clean[0]), (None, None), (None, clean[1])]
    rows += [(5, None), (6, ""), (None, clean[1]), (7, clean[2]), (7, clean[2])]
    docs = odd_documents(spark, rows)
    bench = spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string")
    kept = remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, (r for r in rows if r[1] != passage)))
    one = one_of_each(docs, n=5, threshold=(80, 100))
    assert one.columns == docs.columns
    want = [r for r in rows if r != (3, clean[0])]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in one.collect()))) == sorted(map(str, want))
    none = odd_documents(spark, [])
    assert remove_contaminated(none, bench).collect() == [] and one_of_each(none).collect() == []
    assert remove_contaminated(docs, bench.limit(0)).count() == len(rows)
    # Without labels every text scores one half.
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.keep_good(docs, model, 0.5).columns == docs.columns
    assert quality.keep_good(docs, model, 0.5).count() == len(rows) and quality.keep_good(docs, model, 0.51).count() == 0
    assert quality.keep_good(none, model, 0.5).collect() == []


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
