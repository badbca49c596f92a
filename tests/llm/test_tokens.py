"""Token files and token counts against encoding every whole text."""

import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import queries
from tidemark.llm.encoder import WordEncoder, with_end
from tidemark.llm.token_counts import count_tokens, document_names, document_token_counts, write_flat
from tidemark.llm.token_packing import bit_width, pack, read_documents, read_ids, unpack, write_tokens
from tidemark.session import shared_path

SF = "/root/testdata/sf0.001"
NASTY = [
    None,
    "",
    " \n\t\x0b\x0c\r ",
    "Don't we've x's' a''s ''s!! I'LL, 'd",
    "abc<|endoftext|>d <|startoftext|>",
    "İstanbul ΑΣ ß ﬁ É, é, Ö. ü!? é, áb ́c ñ#x €,€. 12,345 x2y\x1cz a\xa0b c",
    "naïve,naïve; (Größe) [ŉ] Ǆ Kelvin K Å ſs '",
    "word " * 5000,
    "x" * 3000,
]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(queries.tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def texts_of(sf=SF):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


def test_word_encoder_equals_whole_texts(whole):
    import pyarrow as pa

    texts = NASTY + [t for _, t in texts_of()]
    encoder = WordEncoder(queries.tokenizer_path(), False)
    for _ in range(2):
        counts, ids = encoder.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends):
            assert ids[a:b].tolist() == whole(text), text
    sliced = pa.array(["zzz"] + texts, pa.string()).slice(1)
    assert encoder.encode(sliced)[1].tolist() == ids.tolist()


def test_encoder_of_a_tokenizer_that_keeps_white_space():
    """Its file says that words cannot be encoded one by one, so whole texts are."""
    import pyarrow as pa

    path = queries.tokenizer_path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = NASTY + [text for _, text in texts_of()]
    counts, ids = WordEncoder(path, False).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == t.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("special_is_text", [False, True])
def test_word_encoder_on_random_signs(special_is_text):
    import random

    import pyarrow as pa

    rng = random.Random(7)
    signs = [*"abZ09 '.,;-_<|>\n\t", "İ", "ß", "É", "é", "ſ", "×", "÷", "Ÿ", "ŉ", "Σ", "ς", "e\u0301", "\u0301", "\xa0", "\x1c", "日", "😀", "١"]
    signs += ["<|endoftext|>", "'s", "n't", "don't", "ñ"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(0, 25))) for _ in range(6000)]
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = special_is_text
    encoder = WordEncoder(queries.tokenizer_path(), special_is_text)
    counts, ids = encoder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_encoder_starts_afresh_when_full(monkeypatch, whole):
    import pyarrow as pa

    from tidemark.llm import encoder as module

    monkeypatch.setattr(module, "REMEMBERED", 5)
    encoder = WordEncoder(queries.tokenizer_path(), False)
    for text in ("a b c d", "c d e f g", "one two three four five six seven"):
        assert encoder.encode(pa.array([text]))[1].tolist() == whole(text)


@pytest.mark.parametrize("width", [1, 7, 11, 16, 17, 20, 31])
def test_bits_round_trip(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1001).astype(np.uint32)
    payload = pack(ids, width)
    assert len(payload) == -(-1001 * width // 8)
    assert unpack(payload, width, 1001).tolist() == ids.tolist()
    assert unpack(payload, width, 55, 123).tolist() == ids[123:178].tolist()
    assert bit_width(1 << width) == width and bit_width((1 << width) + 1) == width + 1


def test_with_end():
    counts, ids = with_end(np.array([2, 0, 1]), np.array([5, 6, 7], np.uint32), 9)
    assert counts.tolist() == [3, 1, 2] and ids.tolist() == [5, 6, 9, 9, 7, 9]


def expected(rows, whole, end_id):
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array([*whole(text), end_id], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def test_query_equals_whole_texts(spark, whole):
    got = sorted(tuple(r) for r in queries.op7_token_packing(spark, SF).collect())
    assert got == expected(texts_of(), whole, queries.END_ID)


@pytest.mark.parametrize("block_ids", [1, 7, 100_000])
def test_file_of_odd_texts(spark, whole, block_ids):
    rows = [(i * 3 - 5, t, "x") for i, t in enumerate(NASTY)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    path = shared_path(spark)
    write_tokens(docs, path, queries.tokenizer_path(), queries.VOCABULARY, 2, block_ids=block_ids)
    want = expected([r[:2] for r in rows], whole, 2)
    assert sorted(tuple(r) for r in read_documents(spark, path).collect()) == want
    flat = [i for _, t, _ in rows for i in [*whole(t), 2]]
    assert read_ids(spark, path, 0, 10**9).tolist() == flat
    assert read_ids(spark, path, 13, 40).tolist() == flat[13:53]


def test_repeated_rows_and_null_ids(spark, whole):
    rows = [(None, "b"), (4, "a a"), (4, "a a"), (4, "z"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = shared_path(spark)
    write_tokens(docs, path, queries.tokenizer_path(), queries.VOCABULARY, 2)
    got = sorted(map(tuple, read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 4, 4, 4]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got[:-1]]).tolist()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = shared_path(spark)
    write_tokens(docs, path, queries.tokenizer_path(), queries.VOCABULARY, 2)
    assert read_documents(spark, path).collect() == []
    path = shared_path(spark)
    assert document_token_counts(docs, path, queries.tokenizer_path(), 9).collect() == []


def test_counts_of_query(spark, whole):
    got = sorted(tuple(r) for r in queries.op9_token_counts(spark, SF).collect())
    # A special string is ordinary text in a flat file.
    assert got == [(i, len(whole(t)), True) for i, t in texts_of()]


@pytest.mark.parametrize("block_ids,chunk", [(1, 2), (3, 4), (50, 1024)])
def test_counts_across_blocks(spark, monkeypatch, block_ids, chunk):
    from tidemark.llm import token_counts

    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    rows = [(i, t) for i, t in enumerate(NASTY[:-2] + ["w " * 40, "", None, "end"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    path = shared_path(spark)
    write_flat(docs, path, queries.tokenizer_path(), queries.SEPARATOR_ID, block_ids=block_ids)
    blocks = spark.read.parquet(path)
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    want = {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in rows}
    got = count_tokens(blocks, queries.SEPARATOR_ID).join(document_names(blocks), ["file", "ordinal"])
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == want


def test_ids_after_the_last_separator(spark):
    raw = [np.array(x, "<u2").tobytes() for x in ([1, 2], [9, 3], [9, 4], [5, 6])]
    blocks = spark.createDataFrame([(0, i, b) for i, b in enumerate(raw)], "file int, block int, payload binary")
    got = sorted(tuple(r)[1:] for r in count_tokens(blocks, 9).collect())
    assert got == [(0, 0, 2, True), (1, 3, 1, True), (2, 5, 3, False)]
