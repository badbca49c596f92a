"""URL filters: a blocked Bloom filter before an exact join.

A list holds canonical entries ``host`` + ``path`` with a verdict.  An entry fits its host and all
subdomains where the path starts with the entry's path; the longest fitting entry wins.  Every
URL has a few possible entries (its host suffixes times the path lengths that occur in the list).
They are tested against a blocked Bloom filter: one 64-bit block per hash, four bits in it.  The
filter is a table of (block, bits) with at most ``MAX_BLOCKS`` rows, so it can be broadcast
whatever the length of the list; with a longer list it only lets more false hits through.  What
passes is joined with the list itself on the whole entry, which removes all false positives.

Defined results: a NULL URL, or one without ``://``, has an empty host and path and fits no entry;
URLs that fit no entry get ``default``; repeated rows are judged alike.  An empty list or table is
allowed.  Only the id and the URL are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import ascii_lower, row_count, whole

# 2**18 blocks of 64 bits: 2 MB of bits, some 10 MB as a broadcast table.
MAX_BLOCKS = 1 << 18
BITS_PER_ENTRY = 16


def canonical(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = whole(rest)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def _block(entry: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(entry), F.lit(blocks))


def _bits(entry: Column) -> Column:
    """Four bits of a 64-bit block, from a second hash."""
    h = F.xxhash64(entry, F.lit("bits"))
    one = F.lit(1).cast("long")
    out = F.lit(0).cast("long")
    for i in range(4):
        out = out.bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.shiftright(h, 6 * i), F.lit(64)).cast("int")))
    return out


def bloom_blocks(entries: DataFrame, entry: str, blocks: int) -> DataFrame:
    """The non-empty blocks of the filter over ``entries``."""
    return (
        entries.select(_block(F.col(entry), blocks).alias("block"), _bits(F.col(entry)).alias("bits"))
        .groupBy("block")
        .agg(F.bit_or("bits").alias("bits"))
    )


def url_filter(
    pages: DataFrame,
    rules: DataFrame,
    id: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: id, host, path, rule (NULL where none fits), verdict.

    ``rules`` has the columns host, path, verdict.
    """
    listed = rules.select(
        F.col("host"), F.concat("host", "path").alias("rule"), F.length("path").alias("len"), F.col("verdict")
    )
    entries = row_count(listed)
    blocks = 1
    while blocks < min(MAX_BLOCKS, entries * BITS_PER_ENTRY // 64 + 1):
        blocks *= 2
    bloom = F.broadcast(bloom_blocks(listed.withColumn("probe", _probe("rule", "len")), "probe", blocks))
    # Path lengths of the list: no more than the characters of its longest path.
    lengths = F.array(*[F.lit(r[0]) for r in listed.select("len").distinct().orderBy("len").collect()] or [F.lit(0)])

    host, path = canonical(F.col(url))
    parsed = pages.select(F.col(id), host.alias("host"), path.alias("path"))
    addresses = parsed.where("host != ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    possible = (
        addresses.withColumn("suffix", F.explode(suffixes))
        .withColumn("len", F.explode(lengths))
        .where(F.length("path") >= F.col("len"))
        .withColumn("rule", F.concat("suffix", F.substring("path", F.lit(1), F.col("len"))))
        .select("host", "path", "rule", "len", _probe("rule", "len").alias("probe"))
    )
    hits = (
        possible.withColumns({"block": _block(F.col("probe"), blocks), "want": _bits(F.col("probe"))})
        .join(bloom, "block")
        .where(F.col("bits").bitwiseAND(F.col("want")) == F.col("want"))
        .select("host", "path", "rule", "len")
    )
    best = (
        hits.join(listed.select("rule", "len", "verdict"), ["rule", "len"])
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("found"))
    )
    return parsed.join(best, ["host", "path"], "left").select(
        id, "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict")
    )


def _probe(rule: str, length: str) -> Column:
    """Entry with the length of its path, so that ``a/b`` as a host is not ``a`` with path ``/b``."""
    return F.concat(F.col(length).cast("string"), F.lit(":"), F.col(rule))
