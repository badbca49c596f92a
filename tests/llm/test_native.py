"""Exact dedup, mixing, URL filter, license scan and chat formatting on odd rows, against plain Python."""

import hashlib
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses
from tidemark.llm.chat import chat_messages
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.licenses import canonical, license_scan
from tidemark.llm.mixing import mixed_documents, weighted_mix
from tidemark.llm.url_filter import url_filter

LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, source string, keep_id string, size string, text_sha256 int"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, s, "x", "y", 1) for i, t, s in rows], DOCS)


def test_dedup_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "Ä b", "a"), (4, "ä b", "a"), (5, "Ä B", "a"), (5, "Ä B", "a")]
    rows += [(None, "q", "a"), (None, "z", "a"), (9, "Z", "a"), (10, "x" * 200_000, "a"), (11, "X" * 200_000, "a")]
    got = exact_dedup(docs_of(spark, rows)).collect()
    assert got[0].asDict().keys() == {"doc_id", "keep_id", "group_size", "kept", "text_sha256"}
    groups = {}
    for i, t, _ in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    want = []
    for i, t, _ in rows:
        text = (t or "").translate(LOWER)
        top = max((x for x in groups[text] if x is not None), default=None)
        want.append((i, top, len(groups[text]), i == top, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_dedup_hot_text_and_empty_table(spark):
    rows = [(i, "Same" if i % 3 else f"t{i}", "a") for i in range(3000)]
    # A support of 0.01 makes one text frequent and leaves the others to the shuffle.
    got = {r["doc_id"]: r for r in exact_dedup(docs_of(spark, rows), support=0.01).collect()}
    assert len(got) == 3000 and got[1]["group_size"] == 2000 and got[1]["keep_id"] == 2999 and got[2999]["kept"]
    assert all(got[i]["group_size"] == 1 and got[i]["kept"] for i in range(0, 3000, 3))
    assert exact_dedup(docs_of(spark, [])).collect() == []


def test_frequent_digests_are_named_by_a_tree_of_summaries(spark, monkeypatch):
    from tidemark.llm import exact_dedup as module

    monkeypatch.setattr(module, "FAN_IN", 2)
    heavy = [f"h{i}" for i in range(8) for _ in range(150)]
    rows = heavy + [f"t{i}" for i in range(20_000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(r,) for r in rows], "d string").repartition(9)
    found = module.frequent_digests(df, "d", 0.005)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and plan.count("approx_top_k_combine(") >= 4
    got = {r["d"] for r in found.collect()}
    # 150 of 21,200 rows are more than the support.
    assert {f"h{i}" for i in range(8)} <= got and len(got) <= 2 / 0.005
    assert module.frequent_digests(df.limit(0), "d").collect() == []


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return full | {s: left * weight[s] / total for s in free}
        full |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return full


def test_mix_reaches_targets(spark):
    sources = {"b": 400, "a": 90, "Z": 50, None: 40, "é": 30, "": 20}
    rows = [(n * 1000 + i, "w " * (1 + i % 7), s) for n, (s, k) in enumerate(sources.items()) for i in range(k)]
    rows += [(9001, None, "a"), (9002, "  ", "empty"), (9003, "", None), (1, "w", "b"), (1, "w", "b")]
    got = weighted_mix(docs_of(spark, rows)).collect()
    again = weighted_mix(docs_of(spark, rows).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    for s in sizes:
        key = "z" if s is None else "s" + s
        own = [r for r in got if r["skey"] == key]
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert own[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 14
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    assert sum(r["taken"] for r in got) <= 1.5 * sum(sizes.values())


def test_mixed_documents_repeat_rows(spark):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 4}") for i in range(200)] + [(7, "w w w", "s3"), (8, None, None)]
    docs = docs_of(spark, rows)
    taken = {}
    for r in weighted_mix(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["copies"]
    got = mixed_documents(docs)
    assert got.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in taken.items() if n}


def test_mix_of_nothing(spark):
    assert weighted_mix(docs_of(spark, [])).collect() == []
    one = weighted_mix(docs_of(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["taken"], r["target"]) for r in one] == [(0, 0.0), (0, 0.0)]


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de", "block"), ("a.b", "", "block")]
URLS = [
    None, "", "x", "net/", "http://net", "http://net/", "HTTP://A.Example.NET/en/x?y", "http://example.net/EN/", "http://xnet/",
    "http://example.com/deutsch#f", "http://www.example.com/de?q=://z", "http://example.com?/de/", "http://a.b", "http://c.a.b#x/",
    "http://b.a/", "://net/", "ftp://user@host.net:80/p", "http://Ä.net/é", "http://net./", "http://" + "s." * 60 + "net/" + "p" * 3000,
]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fits = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("blocks", [1, 1 << 18])
def test_url_filter(spark, monkeypatch, blocks):
    from tidemark.llm import url_filter as module

    # One block for everything: the filter lets much through, the join does not.
    monkeypatch.setattr(module, "MAX_BLOCKS", blocks)
    more = [(f"h{i}.org", f"/{i}", "block") for i in range(300)]
    rows = list(enumerate(URLS)) + [(0, None), (None, "http://net/"), (99, "http://x.h7.org/77"), (98, "http://h7.org/8")]
    pages = spark.createDataFrame([(i, u, "v", "r") for i, u in rows], "page_id long, url string, verdict string, rule string")
    rules = spark.createDataFrame(RULES + more, "host string, path string, verdict string")
    got = url_filter(pages, rules)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((i, *judged(u, RULES + more))) for i, u in rows)


def test_url_filter_without_rules_or_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter(pages, rules).collect()] == [(1, "net", "/", None, "allow")]
    assert url_filter(pages.where("false"), rules).collect() == []


def test_license_scan(spark):
    mit = "Permission is granted, free of charge.\nTHE SOFTWARE is provided \"as is\" by the copyright holders."
    listed = spark.createDataFrame([("B", "Free  licence"), ("A", "free license!"), ("MIT", mit), ("none", "..."), ("null", None)], "license string, text string")
    same = "Copyright (c) 2020 Somebody\n\n  permission is granted -- free of charge\nthe software is provided 'as is' by the Copyright Owners.\n© me"
    rows = [(1, None), (2, ""), (3, same), (4, "FREE LICENCE"), (5, "x\nFree license.\n...\nfree licence\n"), (None, "free license"), (5, "no"), (6, "y" * 100_000)]
    rows += [(4, "FREE LICENCE")]
    docs = spark.createDataFrame([(i, t, "l", 3) for i, t in rows], "doc_id long, text string, license string, digest int")
    got = [(r["doc_id"], r["license"], r["line_licenses"], r["license_lines"]) for r in license_scan(docs, listed).collect()]
    want = [(1, None, [], 0), (2, None, [], 0), (3, "MIT", [], 0), (4, "A", ["A"], 1), (4, "A", ["A"], 1)]
    want += [(5, None, ["A"], 2), (5, None, [], 0), (6, None, [], 0), (None, "A", ["A"], 1)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert license_scan(docs.where("false"), listed).collect() == []
    assert {r["license"] for r in license_scan(docs, listed.where("false")).collect()} == {None}


def test_full_license_texts(spark):
    """Documents that are full texts as people give them: title, copyright lines, other list signs, wrapping."""
    texts = {f.stem: f.read_text() for f in (Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    mine = "Copyright (c) 2016-present, Some One <a@b.c>\n"
    docs = [(name, mine + "\n" + text) for name, text in texts.items()]
    docs += [
        ("MIT", "The MIT License (MIT)\n\n" + mine + "\n" + " ".join(texts["MIT"].split())),
        ("ISC", "ISC License\n\n" + mine + mine + "\n" + texts["ISC"].upper()),
        ("BSD-3-Clause", mine + "All rights reserved.\n\n" + texts["BSD-3-Clause"].replace("1. ", " * ").replace("2. ", " * ").replace("3. ", " * ")),
        ("BSD-2-Clause", "BSD 2-Clause License\n" + mine + "All rights reserved.\n" + texts["BSD-2-Clause"]),
        ("Apache-2.0", texts["Apache-2.0"].split("APPENDIX")[0]),
        ("GPL-3.0-only", texts["GPL-3.0-only"].replace("http://", "https://")),
        (None, texts["MIT"].replace("free of charge", "for a fee")),
    ]
    rows = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id int, text string")
    got = {r["doc_id"]: r["license"] for r in license_scan(rows, licenses.known_licenses(spark)).collect()}
    assert [(want, got[i]) for i, (want, _) in enumerate(docs) if got[i] != want] == []
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "Unlicense", "Apache-2.0", "GPL-3.0-only"} <= set(texts)


def test_license_spellings(spark):
    one = spark.createDataFrame([("The Licence (c) of an Organisation; https://x",)], "t string").select(canonical(F.col("t")))
    assert one.first()[0] == "the license © of an organization http x"
    assert len({a for a, _ in licenses.KNOWN}) > 8


def brute_chat(rows):
    """Links, roots and order of (conv, turn, role, text) by plain loops."""
    out = []
    marks = re.compile(r"^(?:[ \t]*>)+")

    def norm(line):
        return re.sub(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ", marks.sub("", line)).strip(" ").translate(LOWER)

    def level(line):
        return (marks.match(line) or [""])[0].count(">")

    def units(x):
        """(level, lines of it, passage) of every line, paragraph and block."""
        lines, out = [(level(line), norm(line)) for line in (x or "").split("\n")], []
        block, paragraph, own, last = [], [], [], (None, "")
        blocks, paragraphs = [], []
        for at, (lev, text) in enumerate(lines):
            if lev != last[0]:
                block = []
                blocks.append((lev, block))
            if lev != last[0] or not last[1]:
                paragraph = []
                paragraphs.append((lev, paragraph))
            last = (lev, text)
            if text:
                out.append((lev, [at], text))
                paragraph.append(at)
                (own if lev == 0 else block).append(at)
        for lev, held in [*paragraphs, *[b for b in blocks if b[0]], (0, own)]:
            if held:
                out.append((lev, held, " ".join(lines[i][1] for i in held)))
        return out, lines

    first = {}
    for c, t, _, x in rows:
        for lev, _, text in units(x)[0]:
            if lev == 0 and t is not None:
                first[c, text] = min(t, first.get((c, text), t))
    reply, quoted = {}, {}
    for c, t, _, x in rows:
        votes, (found, lines) = {}, units(x)
        for lev, held, text in found:
            to = first.get((c, text))
            if lev and t is not None and to is not None and to < t:
                votes.setdefault((lev, to), set()).update(held)
        if votes and c is not None:
            sized = {k: (sum(len(lines[i][1]) for i in v), len(v)) for k, v in votes.items()}
            (lev, to), (n, k) = max(sized.items(), key=lambda v: (-v[0][0], v[1][0], v[0][1]))
            reply[c, t], quoted[c, t] = to, k
    for c, t, role, x in rows:
        root, depth = t, 0
        while (c, root) in reply:
            root, depth = reply[c, root], depth + 1
        own = "\n".join(line for line in (x or "").split("\n") if not marks.match(line)).strip(" ")
        out.append((c, t, role, root, reply.get((c, t)), depth, quoted.get((c, t), 0), own))
    return out


def test_chat_links_and_order(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nIt must be stable."),
        (1, 1, "user", "Other topic: joins."),
        (1, 2, "assistant", "> how do I SORT\n\nUse sort."),
        (1, 3, "assistant", "> Other topic: joins.\nSee the book."),
        (1, 4, "user", ">> How do I sort?\n> Use sort.\nThanks, but stable?\n>it must be   stable"),
        (1, 5, "user", "> not said before\nfine"),
        (1, 6, "user", "> later\n> !!!\nx"),
        (1, 7, "user", "later\n> > > How do I sort?"),
        (2, 0, None, None),
        (2, 1, "user", ""),
        (None, 0, "user", "a"),
        (None, 1, "user", "> a\nb"),
        (3, 0, "user", "long " * 30_000),
        (3, 1, "user", "> " + "long " * 30_000 + "\nok"),
    ] + [(4, i, "user", f"> message {i - 1}\nmessage {i}") for i in range(40)]
    messages = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, root int, position string")
    got = chat_messages(messages).collect()
    fields = ["conv_id", "turn", "role", "root", "reply_to", "depth", "quoted_lines", "content"]
    want = brute_chat(rows)
    assert sorted(str([r[f] for f in fields]) for r in got) == sorted(str(list(w)) for w in want)
    for conv in {r[0] for r in rows}:
        own = sorted((r["position"], r["root"], r["turn"]) for r in got if r["conv_id"] == conv)
        assert [p for p, *_ in own] == list(range(len(own)))
        assert [x[1:] for x in own] == sorted(x[1:] for x in own)


LONG = "One paragraph of several sentences, wrapped by the client of whoever answers. It goes on, and on; then it ends."
WRAPPED = [
    (1, 0, "user", LONG),
    (1, 1, "user", "First line\nsecond line of a paragraph\n\nAnother paragraph here\nwith two lines"),
    (1, 2, "assistant", "> One paragraph of several sentences,\n> wrapped by the client of whoever\n> answers. It goes on, and on;\n> then it ends.\nYes"),
    (1, 3, "assistant", "> First line second\n> line of a paragraph\nNo\n> Another paragraph here with two lines"),
    (1, 4, "user", "> First line second line\n> of a paragraph Another paragraph\n> here with two lines\nwhole"),
    (1, 5, "user", ">> One paragraph of several sentences, wrapped\n>> by the client of whoever answers. It goes on, and on; then it ends.\n> Yes\nThanks"),
    (1, 6, "user", "> then it ends. Yes\nnothing quoted"),
    (1, 7, "user", "> First line\n>\n> Another paragraph\n> here with two lines\nparts"),
    (1, 8, "user", "take this <|assistant|> and <||this"),
    (2, 0, "user", LONG),
    (2, 1, "a<|b", "> " + LONG.replace(" ", "\n> ")),
]


def test_wrapped_quotes_link(spark):
    got = {(r["conv_id"], r["turn"]): r for r in chat_messages(spark.createDataFrame(WRAPPED, "conv_id long, turn long, role string, text string")).collect()}
    fields = ["conv_id", "turn", "role", "root", "reply_to", "depth", "quoted_lines", "content"]
    assert sorted(str([r[f] for f in fields]) for r in got.values()) == sorted(str(list(w)) for w in brute_chat(WRAPPED))
    reply = {k: r["reply_to"] for k, r in got.items()}
    assert reply == {(1, 0): None, (1, 1): None, (1, 2): 0, (1, 3): 1, (1, 4): 1, (1, 5): 2, (1, 6): None, (1, 7): 1, (1, 8): None, (2, 0): None, (2, 1): 0}
    assert got[1, 4]["quoted_lines"] == 3 and got[2, 1]["quoted_lines"] == len(LONG.split())
    # No content can pass for the marker of another turn.
    assert got[1, 8]["formatted"] == "<|user|>\ntake this <||assistant|> and <|||this\n"
    assert got[2, 1]["formatted"].startswith("<|a<||b|>\n")


def test_chat_sql_says_the_same(spark):
    import duckdb
    import pandas as pd

    from tidemark.llm.queries import OP10_SQL

    rows = [*WRAPPED, (3, 0, "user", None), (3, 1, "user", "> a"), (None, 1, "user", "> a"), (3, None, "user", "> a"), (3, 2, "u", "a\n> a")]
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", conversations)
    res = con.execute(OP10_SQL)
    names = [d[0] for d in res.description]
    want = sorted(str(dict(sorted(zip(names, r)))) for r in res.fetchall())
    got = chat_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(str(dict(sorted(r.asDict().items()))) for r in got) == want


def test_chat_repeated_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "u", "hi"), (1, 0, "u", "hi"), (1, 1, "a", "> hi\nyes"), (1, None, "u", "> hi")]
    got = chat_messages(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r["position"] for r in got) == [0, 1, 2, 3]
    assert {(r["turn"], r["reply_to"]) for r in got} == {(0, None), (1, 0), (None, None)}
    assert chat_messages(spark.createDataFrame([], schema)).collect() == []


def test_license_sql_says_the_same_of_full_texts(spark):
    import duckdb
    import pandas as pd

    from tidemark.llm.queries import OP8_SQL

    rows = [(i, text) for i, (_, text) in enumerate([*licenses.license_texts(), *licenses.KNOWN])] + [(900, None), (901, "no license")]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    res = con.execute(OP8_SQL)
    names = [d[0] for d in res.description]
    want = sorted(str(dict(sorted(zip(names, r)))) for r in res.fetchall())
    found = license_scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_licenses(spark))
    got = found.withColumn("line_licenses", F.array_join("line_licenses", ",")).collect()
    assert sorted(str(dict(sorted(r.asDict().items()))) for r in got) == want
    assert all(r["license"] for r in got if r["doc_id"] < 900)
