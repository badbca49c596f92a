"""Frames and SQL fragments shared by several queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.fixtures import table

DOCS_SQL = (
    "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
LABELLED_SQL = (
    "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, "
    "d.n_chars / (d.n_chars + 1000.0::DOUBLE) AS score "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels where there are any."""
    return (
        table(spark, sf_dir, "documents")
        .drop("text")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a score between 0 and 1 that grows with their length."""
    both = table(spark, sf_dir, "documents").drop("text").join(table(spark, sf_dir, "labels"), "doc_id")
    return both.withColumn("score", F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0)))


def rounded(df: DataFrame, places: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded half away from zero."""
    doubles = [n for n, t in df.dtypes if t == "double" and n not in skip]
    return df.select(*[F.round(c, places).alias(c) if c in doubles else F.col(c) for c in df.columns])


def quantile_list(q: int) -> str:
    return "[" + ", ".join(repr(i / q) for i in range(q + 1)) + "]"


def quantile_edges_sql(source: str, column: str, q: int, where: str = "TRUE") -> str:
    """One row ``e``: distinct q-quantile edges."""
    return (
        f"SELECT list_sort(list_distinct(quantile_cont(CAST({column} AS DOUBLE), {quantile_list(q)}))) AS e "
        f"FROM {source} WHERE {where}"
    )


def width_edges_sql(source: str, column: str, n: int, where: str = "TRUE") -> str:
    """One row ``e``: equal-width edges, the first one lowered by 0.1 % of the range."""
    return f"""SELECT CASE WHEN lo = hi
        THEN list_transform(range({n + 1}), lambda i: CASE WHEN i = {n} THEN hi + pad ELSE (i * ((hi + pad) - (lo - pad)) / {n}) + (lo - pad) END)
        ELSE list_transform(range({n + 1}), lambda i: CASE WHEN i = {n} THEN hi WHEN i = 0 THEN lo - 0.001 * (hi - lo)
                            ELSE i * ((hi - lo) / {n}) + lo END) END AS e
      FROM (SELECT min(CAST({column} AS DOUBLE)) AS lo, max(CAST({column} AS DOUBLE)) AS hi,
                   CASE WHEN min({column}) = 0 THEN 0.001 ELSE 0.001 * abs(CAST(min({column}) AS DOUBLE)) END AS pad
            FROM {source} WHERE {where}) b"""


def bin_sql(column: str, edges: str = "e") -> str:
    """0-based bin of right-closed intervals, NULL when there is no bin."""
    return (
        f"CASE WHEN {column} IS NOT NULL AND len({edges}) > 1 THEN "
        f"CAST(len(list_filter({edges}[2:len({edges}) - 1], lambda x: x < CAST({column} AS DOUBLE))) AS INTEGER) END"
    )
