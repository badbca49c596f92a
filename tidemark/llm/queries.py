"""Queries of the operators over the test tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.chat import chat_messages
from tidemark.llm.decontaminate import contamination, is_contaminated
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.lexical import TOP, ranked_search
from tidemark.llm.licenses import COPYRIGHT_LINE, KNOWN, SIGNS, SPELLINGS, known_licenses, license_scan, license_texts
from tidemark.llm.mixing import weighted_mix
from tidemark.llm.ngram_join import ngram_jaccard_join
from tidemark.llm.quality import is_held_out, score, train
from tidemark.llm.sharding import OVERHEAD, SHARDS, stratified_shards
from tidemark.llm.token_counts import document_token_counts
from tidemark.llm.token_packing import read_documents, write_tokens
from tidemark.llm.url_filter import url_filter
from tidemark.llm.whitening import embedding_whitening
from tidemark.session import configure, shared_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
sources AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY skey),
ranked AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS INTEGER)] AS w
  FROM sources),
levels AS (
  SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(w) OVER (ORDER BY cap / w, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
targets AS (SELECT skey, source_size, least(cap, w * max(level) OVER ()) AS target FROM levels),
queued AS (
  SELECT doc_id, key, skey, size, source_size, target,
         sum(size) OVER (PARTITION BY skey ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS run
  FROM sized JOIN targets USING (skey)),
copies AS (
  SELECT doc_id, key, skey, epoch, size, CAST(epoch * source_size + run AS DOUBLE) / target AS finish
  FROM queued, (SELECT unnest([0, 1]) AS epoch) WHERE size > 0),
mixed AS (
  SELECT doc_id, skey, size,
         sum(size) OVER (ORDER BY finish, key, skey, epoch ROWS UNBOUNDED PRECEDING) AS total FROM copies),
took AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM mixed
  WHERE total <= (SELECT sum(size) * 1.5::DOUBLE FROM sized) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0) AS taken
FROM queued q LEFT JOIN took t ON q.doc_id = t.doc_id
"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return weighted_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, w, CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(len(w) - 2, 1) + 1) END AS spots FROM w WHERE w IS NOT NULL),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(spots) AS i FROM places)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 90 * (x.n + y.n - i)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


# (host, path, verdict)
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

OP4_SQL = r"""
WITH rules(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                             ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
split AS (SELECT *, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parsed AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, len(h) + 1), '^[^?#]*') AS path
  FROM split),
judged AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY len(rhost || rpath) DESC, rhost || rpath DESC) AS n
  FROM parsed LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged WHERE n = 1
"""


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


OP5_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
           FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark WHERE text IS NOT NULL),
starts AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM starts),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
own AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM places),
occurs AS (SELECT o.doc_id, o.n, o.i, x.item_id FROM own o JOIN windows x ON o.win = x.win AND o.n = x.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occurs) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occurs) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


GOOD = 0.7


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return score(docs, model).select(
        "doc_id",
        is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


TOKENIZER = "word_bpe_49k.json"
VOCABULARY = 49_408
END_ID = 2
SEPARATOR_ID = 49_407


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = shared_path(spark)
    write_tokens(docs, path, tokenizer_path(), VOCABULARY, END_ID)
    return read_documents(spark, path)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = document_token_counts(docs, shared_path(spark), tokenizer_path(), SEPARATOR_ID)
    return counted.select("doc_id", "n_tokens", "ended")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    out = _LOWER.format(f"coalesce({text}, '')")
    for given, used in SPELLINGS:
        out = f"replace({out}, {_quoted(given)}, {_quoted(used)})"
    out = f"regexp_replace({out}, {_quoted(COPYRIGHT_LINE)}, '', 'g')"
    return f"trim(regexp_replace({out}, {_quoted(SIGNS)}, ' ', 'g'))"


OP8_SQL = f"""
WITH listed(license, text) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in [*KNOWN, *license_texts()])}),
known AS (SELECT sha256({_canonical_sql("text")}) AS digest, min(license) AS license FROM listed GROUP BY 1),
lines AS (
  SELECT doc_id, sha256({_canonical_sql("line")}) AS digest
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM lines JOIN known USING (digest) GROUP BY doc_id),
texts AS (SELECT doc_id, sha256({_canonical_sql("text")}) AS digest FROM documents)
SELECT t.doc_id, k.license, coalesce(f.names, '') AS line_licenses, coalesce(f.n, 0) AS license_lines, t.digest
FROM texts t LEFT JOIN known k USING (digest) LEFT JOIN found f USING (doc_id)
"""


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan(docs, known_licenses(spark)).withColumn("line_licenses", F.array_join("line_licenses", ","))


_PASSAGE = (
    r"trim(regexp_replace(regexp_replace(line, '^(?:[ \t]*>)+', ''), "
    r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'))"
)
OP10_SQL = rf"""
WITH RECURSIVE split AS (
  SELECT conv_id, turn, md5(x) AS r, generate_subscripts(string_split(x, chr(10)), 1) AS pos, unnest(string_split(x, chr(10))) AS line
  FROM (SELECT DISTINCT conv_id, turn, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
leveled AS (
  SELECT conv_id, turn, r, pos, len(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS level,
         {_LOWER.format(_PASSAGE)} AS passage
  FROM split),
marked AS (
  SELECT *, coalesce(lag(level) OVER o <> level, true) AS turned, coalesce(lag(passage) OVER o = '', true) AS rested
  FROM leveled WINDOW o AS (PARTITION BY conv_id, turn, r ORDER BY pos)),
lines AS (
  SELECT * FROM (
    SELECT conv_id, turn, r, pos, level, passage,
           CASE WHEN level = 0 THEN 0 ELSE sum(CAST(turned AS INTEGER)) OVER o END AS block,
           sum(CAST(turned OR rested AS INTEGER)) OVER o AS paragraph
    FROM marked WINDOW o AS (PARTITION BY conv_id, turn, r ORDER BY pos)) q WHERE passage <> ''),
paragraphs AS (
  SELECT conv_id, turn, r, level, block, paragraph, string_agg(passage, ' ' ORDER BY pos) AS passage FROM lines GROUP BY ALL),
blocks AS (
  SELECT conv_id, turn, r, level, block, string_agg(passage, ' ' ORDER BY paragraph) AS passage FROM paragraphs GROUP BY ALL),
written AS (
  SELECT conv_id, passage, min(turn) AS reply_to FROM (
    SELECT conv_id, turn, level, passage FROM lines UNION ALL SELECT conv_id, turn, level, passage FROM paragraphs
    UNION ALL SELECT conv_id, turn, level, passage FROM blocks) w WHERE level = 0 GROUP BY 1, 2),
found AS (
  SELECT l.conv_id, l.turn, l.pos, l.level, l.passage, w.reply_to FROM lines l JOIN written w USING (conv_id, passage)
  UNION
  SELECT l.conv_id, l.turn, l.pos, l.level, l.passage, w.reply_to FROM lines l
    JOIN paragraphs p USING (conv_id, turn, r, level, block, paragraph) JOIN written w ON w.conv_id = l.conv_id AND w.passage = p.passage
  UNION
  SELECT l.conv_id, l.turn, l.pos, l.level, l.passage, w.reply_to FROM lines l
    JOIN blocks b USING (conv_id, turn, r, level, block) JOIN written w ON w.conv_id = l.conv_id AND w.passage = b.passage),
votes AS (
  SELECT conv_id, turn, level, reply_to, sum(len(passage)) AS n, count(*) AS quoted
  FROM found WHERE level > 0 AND reply_to < turn GROUP BY ALL),
links AS (
  SELECT conv_id, turn, reply_to, quoted FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, reply_to DESC) = 1),
up(conv_id, turn, root, depth) AS (
  SELECT conv_id, turn, reply_to, CAST(1 AS BIGINT) FROM links
  UNION ALL
  SELECT u.conv_id, u.turn, l.reply_to, u.depth + 1 FROM up u JOIN links l ON l.conv_id = u.conv_id AND l.turn = u.root),
top AS (SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM up GROUP BY ALL),
threaded AS (
  SELECT c.conv_id, c.turn, role, reply_to, coalesce(root, c.turn) AS root, coalesce(depth, 0) AS depth,
         coalesce(quoted, 0) AS quoted_lines,
         trim(array_to_string(list_filter(string_split(coalesce(text, ''), chr(10)),
                                          lambda x: NOT regexp_matches(x, '^(?:[ \t]*>)+')), chr(10)), ' ') AS content
  FROM conversations c LEFT JOIN links l USING (conv_id, turn) LEFT JOIN top t USING (conv_id, turn))
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY root NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, content) - 1 AS position,
       '<|' || regexp_replace(coalesce(role, ''), '<(\|+)', '<\1|', 'g') || '|>' || chr(10)
       || regexp_replace(content, '<(\|+)', '<\1|', 'g') || chr(10) AS formatted
FROM threaded
"""


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_messages(table(spark, sf_dir, "conversations"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_whitening(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    # Exact as a decimal; a sum that passes a long raises an error.
    return found.withColumn("deviation", F.col("deviation").cast("long"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP12_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS place, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS t FROM documents),
sized AS (SELECT doc_id, place, t, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
b AS (SELECT item_id, row_number() OVER () AS item, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS t FROM benchmark),
wanted AS (SELECT DISTINCT item, item_id, unnest(t) AS term FROM b),
tf AS (
  SELECT place, doc_id, n, term, count(*) AS tf FROM (SELECT place, doc_id, n, unnest(t) AS term FROM sized)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM df, total),
gains AS (
  SELECT place, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS gain
  FROM tf JOIN weights USING (term), total),
scores AS (
  SELECT item, item_id, place, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM wanted JOIN gains USING (term)
  GROUP BY ALL HAVING sum(gain) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores QUALIFY rank <= {TOP}
"""


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ranked_search(docs, table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


# The polynomial of CRC-32; its table follows from it by rule.
_CRC_STEPS = "list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
OP13_SQL = rf"""
WITH steps AS (SELECT list({_CRC_STEPS} ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
bytes AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + {OVERHEAD} AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS b
  FROM documents),
keyed AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS skey, CAST(size AS BIGINT) AS size,
         xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS crc
  FROM bytes, steps),
ordered AS (
  SELECT *, md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || size || '|' || crc) AS o FROM keyed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY skey ORDER BY o, doc_id, size, crc) AS r, count(*) OVER (PARTITION BY skey) AS c
  FROM ordered),
placed AS (
  SELECT *, row_number() OVER (ORDER BY CAST(2 * r - 1 AS DOUBLE) / CAST(2 * c AS DOUBLE), skey, r) - 1 AS p,
         count(*) OVER () AS n
  FROM ranked),
dealt AS (SELECT *, p * {SHARDS} // n AS s FROM placed)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(s AS INTEGER) AS shard,
       p - (s * n + {SHARDS - 1}) // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stratified_shards(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mixing": op2_mixing,
    "op3_ngram_join": op3_ngram_join,
    "op4_url_filter": op4_url_filter,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_token_packing": op7_token_packing,
    "op8_license_scan": op8_license_scan,
    "op9_token_counts": op9_token_counts,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_sharding": op13_sharding,
}
ORACLES: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op2_mixing": OP2_SQL,
    "op3_ngram_join": OP3_SQL,
    "op4_url_filter": OP4_SQL,
    "op5_decontamination": OP5_SQL,
    "op8_license_scan": OP8_SQL,
    "op10_chat_formatting": OP10_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_sharding": OP13_SQL,
}
