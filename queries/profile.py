"""Profiling, typing and imputation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import DOCS_SQL, docs, rounded
from queries.registry import query, sql_even, sql_round
from tidemark.operators import impute, profile
from tidemark.sources.fixtures import table


def _stats_sql(source: str, kinds: dict[str, str], roles: dict[str, str]) -> str:
    parts = [
        f"""SELECT '{c}' AS FEATURE, '{roles.get(c, "Explicativa")}' AS USO_FEATURE,
             count(*) - count({c}) AS QT_NULOS,
             {sql_even(f"(count(*) - count({c})) / count(*) * 100", 2)} AS PC_NULOS,
             count(DISTINCT {c}) AS CARDINALIDADE, '{k}' AS TIPO_FEATURE FROM {source}"""
        for c, k in kinds.items()
    ]
    return " UNION ALL ".join(parts)


_DOC_KINDS = {
    "doc_id": "bigint",
    "text": "string",
    "lang": "string",
    "source": "string",
    "n_chars": "bigint",
    "quality": "int",
    "toxic": "int",
}
_DOC_ROLES = {"doc_id": "ID", "quality": "Target", "toxic": "Target"}
_DOC_SOURCE = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) s"
_DOC_STATS = _stats_sql(_DOC_SOURCE, _DOC_KINDS, _DOC_ROLES)
_LINE_KINDS = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp",
}


def _doc_profile(spark, sf_dir):
    full = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return profile.metadata(full, ids=["doc_id"], targets=["quality", "toxic"])


@query("profile", _DOC_STATS)
def _(spark, sf_dir):
    return _doc_profile(spark, sf_dir)


@query(
    "profile_short",
    f"""SELECT FEATURE AS nome_variavel, TIPO_FEATURE AS tipo, QT_NULOS AS qt_nulos,
        PC_NULOS AS percent_nulos, CARDINALIDADE AS cardinalidade
        FROM ({_stats_sql("lineitem", _LINE_KINDS, {})}) q""",
)
def _(spark, sf_dir):
    return profile.metadata_short(table(spark, sf_dir, "lineitem"))


@query("null_heavy_features", f"SELECT FEATURE FROM ({_DOC_STATS}) q WHERE PC_NULOS > 50")
def _(spark, sf_dir):
    names = profile.null_heavy_features(_doc_profile(spark, sf_dir), 50)
    return spark.createDataFrame([(n,) for n in names], "FEATURE string")


@query(
    "feature_classes",
    f"""SELECT FEATURE, CASE WHEN TIPO_FEATURE <> 'string' THEN 'num'
        WHEN CARDINALIDADE < 20 THEN 'cat_low' ELSE 'cat_high' END AS CLASSE FROM ({_DOC_STATS}) q""",
)
def _(spark, sf_dir):
    return profile.feature_classes(_doc_profile(spark, sf_dir))


@query(
    "narrow_types",
    """SELECT feature, old_type,
         CASE WHEN lo IS NULL THEN old_type WHEN old_type = 'double' THEN 'float'
              WHEN lo > -128 AND hi < 127 THEN 'tinyint' WHEN lo > -32768 AND hi < 32767 THEN 'smallint'
              WHEN lo > -2147483648 AND hi < 2147483647 THEN 'int' ELSE 'bigint' END AS new_type
       FROM (
         SELECT 'p_partkey' AS feature, 'bigint' AS old_type, min(p_partkey)::DOUBLE AS lo, max(p_partkey)::DOUBLE AS hi FROM part
         UNION ALL SELECT 'p_name', 'string', NULL, NULL
         UNION ALL SELECT 'p_brand', 'string', NULL, NULL
         UNION ALL SELECT 'p_type', 'string', NULL, NULL
         UNION ALL SELECT 'p_size', 'int', min(p_size), max(p_size) FROM part
         UNION ALL SELECT 'p_retailprice', 'double', min(p_retailprice), max(p_retailprice) FROM part) q""",
)
def _(spark, sf_dir):
    return profile.narrow_types(table(spark, sf_dir, "part"))[1]


@query(
    "narrowed_values",
    """SELECT p_partkey::INTEGER AS p_partkey, p_size::INTEGER AS p_size, p_retailprice::FLOAT AS p_retailprice,
         'int int float' AS kinds FROM part""",
)
def _(spark, sf_dir):
    small = profile.normalize_types(profile.narrow_types(table(spark, sf_dir, "part"))[0])
    chosen = small.select("p_partkey", "p_size", "p_retailprice")
    return chosen.withColumn("kinds", F.lit(" ".join(kind for _, kind in chosen.dtypes)))


@query(
    "rename_as_var",
    """SELECT * FROM (VALUES ('l_orderkey', 'VAR_1'), ('l_partkey', 'VAR_2'), ('l_suppkey', 'VAR_3'),
        ('l_linenumber', 'VAR_4'), ('l_quantity', 'VAR_5'), ('l_extendedprice', 'VAR_6'), ('l_discount', 'VAR_7'),
        ('l_tax', 'VAR_8'), ('l_linestatus', 'VAR_9'), ('l_shipdate', 'VAR_10')) v(nome_original, nome_novo)
       CROSS JOIN (SELECT count(*) AS linhas, count(DISTINCT l_suppkey) AS var_3_distintos FROM lineitem) n""",
)
def _(spark, sf_dir):
    renamed, names = profile.rename_as_var(table(spark, sf_dir, "lineitem"), "l_returnflag")
    sizes = renamed.agg(F.count(F.lit(1)).alias("linhas"), F.countDistinct("VAR_3").alias("var_3_distintos"))
    return names.select(
        "*",
        sizes.select("linhas").scalar().alias("linhas"),
        sizes.select("var_3_distintos").scalar().alias("var_3_distintos"),
    )


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _(spark, sf_dir):
    return profile.drop_columns(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal", "absent"])


@query(
    "sample_rows",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
       FROM orders ORDER BY md5('42|' || o_orderkey) LIMIT 5000""",
)
def _(spark, sf_dir):
    """Seeded sample of fixed size."""
    return profile.sample_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], 5000).drop("o_orderdate")


_MODE = "(SELECT {c} FROM f WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "impute_mean_mode",
    f"""WITH f AS (SELECT *, CASE WHEN toxic = 1 THEN NULL ELSE source END AS origin FROM ({DOCS_SQL}) q)
        SELECT doc_id, lang, coalesce(origin, {_MODE.format(c="origin")}) AS origin,
          CAST(n_chars AS DOUBLE) AS n_chars,
          {sql_round("coalesce(quality, (SELECT avg(quality) FROM f))", 6)} AS quality,
          {sql_round("coalesce(toxic, (SELECT avg(toxic) FROM f))", 6)} AS toxic
        FROM f""",
)
def _(spark, sf_dir):
    df = docs(spark, sf_dir).withColumn("origin", F.when(F.coalesce(F.col("toxic"), F.lit(0)) != 1, F.col("source")))
    df = df.drop("source")
    fitted = impute.fit_imputer(df, numbers=["n_chars", "quality", "toxic"])
    return rounded(fitted.transform(df))


@query(
    "impute_production",
    f"""WITH f AS (SELECT *, CASE WHEN toxic = 1 THEN NULL ELSE source END AS origin FROM ({DOCS_SQL}) q)
        SELECT doc_id, lang, coalesce(origin, 'VERIFICAR') AS origin,
          {sql_round("coalesce(quality, (SELECT avg(quality) FROM f))", 6)} AS quality
        FROM f""",
)
def _(spark, sf_dir):
    df = docs(spark, sf_dir).withColumn("origin", F.when(F.coalesce(F.col("toxic"), F.lit(0)) != 1, F.col("source")))
    fitted = impute.fit_imputer(df, numbers=["quality"])
    later = impute.production_imputer(fitted, keep_modes=False)
    return rounded(later.transform(df).select("doc_id", "lang", "origin", "quality"))


@query(
    "impute_sentinel",
    f"""WITH f AS (SELECT l_orderkey, l_linenumber, l_shipdate, nullif(l_discount, 0) AS d FROM lineitem)
        SELECT l_orderkey, l_linenumber, {sql_round("coalesce(d, (SELECT avg(d) FROM f))", 6)} AS l_discount FROM f""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    fitted = impute.fit_imputer(df, numbers=["l_discount"], texts=[], sentinels=(0.0,))
    return rounded(fitted.transform(df))


@query(
    "impute_median",
    f"""WITH f AS (SELECT doc_id, CASE WHEN toxic IS NULL THEN NULL ELSE n_chars END AS known FROM ({DOCS_SQL}) q)
        SELECT doc_id, coalesce(CAST(known AS DOUBLE), (SELECT quantile_cont(CAST(known AS DOUBLE), 0.5) FROM f)) AS known FROM f""",
)
def _(spark, sf_dir):
    df = docs(spark, sf_dir).select("doc_id", F.when(F.col("toxic").isNotNull(), F.col("n_chars")).alias("known"))
    return impute.fit_imputer(df, "median", ["known"], []).transform(df)
