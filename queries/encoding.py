"""Encoding and scaling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import LABELLED_SQL, labelled, rounded
from queries.registry import query, sql_round
from tidemark.operators import encode
from tidemark.sources.fixtures import table

_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _dummies(levels: list[str], column: str) -> str:
    return ", ".join(f"""CAST({column} = '{v}' AS TINYINT) AS "{column}_{v}" """ for v in levels)


@query(
    "one_hot",
    f"""SELECT o_orderkey, {_dummies(_PRIORITIES, "o_orderpriority")}, {_dummies(["F", "O", "P"], "o_orderstatus")} FROM orders""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return encode.fit_one_hot(df, ["o_orderpriority", "o_orderstatus"]).transform(df)


@query("one_hot_drop_first", f"SELECT o_orderkey, {_dummies(['O', 'P'], 'o_orderstatus')} FROM orders")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return encode.fit_one_hot(df, ["o_orderstatus"], drop_first=True).transform(df)


@query("one_hot_unknown", f"SELECT o_orderkey, {_dummies(['F', 'P'], 'o_orderstatus')} FROM orders")
def _(spark, sf_dir):
    """Values unseen by the fit are zero in every column."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return encode.fit_one_hot(df.where("o_orderstatus <> 'O'"), ["o_orderstatus"]).transform(df)


@query(
    "ordinal",
    "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS o_orderpriority FROM orders",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return encode.ordinal_encode(df, {"o_orderpriority": _PRIORITIES})


def _blend_sql(groups: str, keys: str) -> str:
    """Empirical-Bayes blend from columns n, s, q (category) and m, var (overall)."""
    return f"""SELECT {keys}, CASE WHEN var * n + sp / n > 0
        THEN var * n / (var * n + sp / n) * s / n + (1 - var * n / (var * n + sp / n)) * m ELSE m END AS code
      FROM (SELECT *, greatest(q - s * s / n, 0) AS sp FROM ({groups}) g) h"""


@query(
    "target_encode",
    f"""WITH f AS ({LABELLED_SQL}), codes AS ({_blend_sql('''
          SELECT source, count(*) AS n, sum(quality)::DOUBLE AS s, sum(quality * quality)::DOUBLE AS q,
            (SELECT avg(quality) FROM f) AS m, (SELECT var_pop(quality) FROM f) AS var FROM f GROUP BY source''', "source")})
        SELECT doc_id, {sql_round("coalesce(code, (SELECT avg(quality) FROM f))", 6)} AS source
        FROM documents LEFT JOIN codes USING (source)""",
)
def _(spark, sf_dir):
    coded, mean = encode.fit_target_encoding(labelled(spark, sf_dir), "source", "quality")
    df = table(spark, sf_dir, "documents").select("doc_id", "source")
    return rounded(encode.apply_target_encoding(df, "source", coded, mean))


@query(
    "target_encode_out_of_fold",
    f"""WITH f AS (SELECT *, doc_id % 5 AS fold FROM ({LABELLED_SQL}) z),
        folds AS (SELECT DISTINCT fold AS k FROM f),
        overall AS (SELECT k, avg(quality) AS m, var_pop(quality) AS var FROM folds JOIN f ON fold <> k GROUP BY k),
        cells AS (SELECT k, source, count(*) AS n, sum(quality)::DOUBLE AS s, sum(quality * quality)::DOUBLE AS q
                  FROM folds JOIN f ON fold <> k GROUP BY k, source),
        codes AS ({_blend_sql("SELECT cells.*, m, var FROM cells JOIN overall USING (k)", "k, source")})
        SELECT doc_id, {sql_round("coalesce(code, m)", 6)} AS source_code
        FROM f JOIN overall ON overall.k = fold LEFT JOIN codes ON codes.k = fold AND codes.source = f.source""",
)
def _(spark, sf_dir):
    df = labelled(spark, sf_dir).withColumn("fold", F.pmod("doc_id", F.lit(5)))
    coded = encode.out_of_fold_encoding(df, "source", "quality", "fold", "source_code")
    return rounded(coded.select("doc_id", "source_code"))


@query(
    "standard_scale",
    f"""SELECT c_custkey, {sql_round("(c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer)", 6)} AS c_acctbal
        FROM customer""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(encode.fit_standard(df, ["c_acctbal"]).transform(df))


@query(
    "robust_scale",
    f"""WITH q AS (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS p, quantile_cont(l_quantity, [0.25, 0.5, 0.75]) AS r FROM lineitem)
        SELECT l_orderkey, l_linenumber, {sql_round("(l_extendedprice - p[2]) / (p[3] - p[1])", 6)} AS l_extendedprice,
          {sql_round("(l_quantity - r[2]) / (r[3] - r[1])", 6)} AS l_quantity FROM lineitem, q""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return rounded(encode.fit_robust(df, ["l_extendedprice", "l_quantity"]).transform(df))
