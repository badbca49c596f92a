"""Binning and grouping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import LABELLED_SQL, bin_sql, labelled, quantile_edges_sql, rounded, width_edges_sql
from queries.registry import query, sql_round
from tidemark.operators import binning, grouping, treebins
from tidemark.sources.fixtures import table


def _bin_counts_sql(edges: str, source: str, column: str) -> str:
    return f"""WITH edges AS ({edges}),
      coded AS (SELECT {bin_sql(column)} AS bin, e FROM {source}, edges)
      SELECT bin, {sql_round("e[bin + 1]", 6)} AS lo, {sql_round("e[bin + 2]", 6)} AS hi, count(*) AS n
      FROM coded GROUP BY ALL"""


def _bin_counts(df, column, bins):
    b = bins[column].bounds(F.col(column))
    return rounded(df.select(b.alias("b")).groupBy("b.bin", "b.lo", "b.hi").agg(F.count(F.lit(1)).alias("n")))


@query("quantile_bins", _bin_counts_sql(quantile_edges_sql("orders", "o_totalprice", 10), "orders", "o_totalprice"))
def _(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return _bin_counts(df, "o_totalprice", binning.quantile_bins(df, ["o_totalprice"], 10))


@query("quantile_bins_narrowed", _bin_counts_sql(quantile_edges_sql("lineitem", "l_extendedprice", 20), "lineitem", "l_extendedprice"))
def _(spark, sf_dir):
    """Same edges by narrowing brackets, the way taken for columns with many distinct values."""
    df = table(spark, sf_dir, "lineitem")
    return _bin_counts(df, "l_extendedprice", binning.quantile_bins(df, ["l_extendedprice"], 20, small_distinct=2000))


@query("quantile_bins_tied", _bin_counts_sql(quantile_edges_sql("lineitem", "l_discount", 20), "lineitem", "l_discount"))
def _(spark, sf_dir):
    """Equal edges merge."""
    df = table(spark, sf_dir, "lineitem")
    return _bin_counts(df, "l_discount", binning.quantile_bins(df, ["l_discount"], 20))


@query("width_bins", _bin_counts_sql(width_edges_sql("documents", "n_chars", 10), "documents", "n_chars"))
def _(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return _bin_counts(df, "n_chars", binning.width_bins(df, ["n_chars"], 10))


@query(
    "categorize_numeric",
    f"""WITH ea AS ({quantile_edges_sql("customer", "c_acctbal", 5)}),
        en AS ({quantile_edges_sql("customer", "c_nationkey", 5)})
        SELECT c_custkey, c_mktsegment, {bin_sql("c_acctbal", "ea.e")} AS bin_acctbal,
               {bin_sql("c_nationkey", "en.e")} AS bin_nation FROM customer, ea, en""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "customer").drop("c_name")
    cut = binning.categorize_numeric(df, 5, target="c_custkey")
    return cut.select(
        "c_custkey",
        "c_mktsegment",
        F.col("BIN_c_acctbal.bin").alias("bin_acctbal"),
        F.col("BIN_c_nationkey.bin").alias("bin_nation"),
    )


def tree_sql(source: str, column: str, target: str, leaves: int) -> str:
    """Best-first gini splits, one pair of subqueries per round."""
    steps = f"""steps AS (
      SELECT CAST({column} AS DOUBLE) AS x, count(*) AS n, sum({target}) AS e FROM ({source}) s GROUP BY 1),
    leaf1 AS (SELECT *, 0 AS leaf FROM steps)"""
    ctes = [steps]
    for k in range(1, leaves):
        ctes.append(f"""cum{k} AS (
          SELECT leaf, x, sum(n) OVER w AS cn, sum(e) OVER w AS ce,
                 sum(n) OVER (PARTITION BY leaf) AS tn, sum(e) OVER (PARTITION BY leaf) AS te,
                 max(x) OVER (PARTITION BY leaf) AS top
          FROM leaf{k} WINDOW w AS (PARTITION BY leaf ORDER BY x ROWS UNBOUNDED PRECEDING)),
        best{k} AS (
          SELECT leaf, x FROM cum{k} WHERE x < top AND te > 0 AND te < tn
          ORDER BY te * (tn - te) / tn::DOUBLE - ce * (cn - ce) / cn::DOUBLE
                   - (te - ce) * ((tn - cn) - (te - ce)) / (tn - cn)::DOUBLE DESC, x LIMIT 1),
        leaf{k + 1} AS (
          SELECT s.x, s.n, s.e, CASE WHEN s.leaf = b.leaf AND s.x > b.x THEN {k} ELSE s.leaf END AS leaf
          FROM leaf{k} s LEFT JOIN best{k} b ON TRUE)""")
    ctes.append(f"""sums AS (
      SELECT CAST(sum(e) AS DOUBLE) / sum(n) AS rate, CAST(sum(n) AS BIGINT) AS volume, min(x) AS lo, max(x) AS hi
      FROM leaf{leaves} GROUP BY leaf),
    tree AS (
      SELECT CAST(row_number() OVER (ORDER BY lo) - 1 AS INTEGER) AS Leaf, rate AS Taxa_de_Evento, volume AS Volume,
        CASE WHEN row_number() OVER (ORDER BY lo) = 1 THEN '-inf'::DOUBLE
             ELSE greatest(lo, lag(hi) OVER (ORDER BY lo)) END AS Lower_Bound,
        CASE WHEN row_number() OVER (ORDER BY lo DESC) = 1 THEN 'inf'::DOUBLE ELSE hi END AS Upper_Bound
      FROM sums)""")
    return "WITH " + ",\n".join(ctes)


_TREE = tree_sql(LABELLED_SQL, "n_chars", "toxic", 5)


@query(
    "tree_bins",
    f"{_TREE} SELECT Leaf, {sql_round('Taxa_de_Evento', 6)} AS Taxa_de_Evento, Volume, Lower_Bound, Upper_Bound FROM tree",
)
def _(spark, sf_dir):
    leaves = treebins.tree_bins(labelled(spark, sf_dir), 5, "toxic", "n_chars")
    return rounded(leaves, skip=("Lower_Bound", "Upper_Bound"))


@query(
    "tree_bins_applied",
    f"""{_TREE} SELECT doc_id, CAST((SELECT count(*) FROM tree WHERE Upper_Bound <= n_chars) AS INTEGER) AS "TFT_n_chars"
        FROM documents""",
)
def _(spark, sf_dir):
    leaves = treebins.tree_bins(labelled(spark, sf_dir), 5, "toxic", "n_chars")
    df = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return treebins.apply_tree_bins(df, leaves, "n_chars")


_PRIORITIES = {"1-URGENT": "alta", "2-HIGH": "alta", "4-NOT SPECIFIED": "baixa", "5-LOW": "baixa"}
_PRIORITY_CASE = "CASE " + " ".join(f"WHEN o_orderpriority = '{k}' THEN '{v}'" for k, v in _PRIORITIES.items()) + " END"


@query(
    "regroup",
    f"""SELECT DISTINCT coalesce({_PRIORITY_CASE}, o_orderpriority) AS "TFB_o_orderpriority", o_orderpriority FROM orders""",
)
def _(spark, sf_dir):
    return grouping.regroup(table(spark, sf_dir, "orders"), "o_orderpriority", _PRIORITIES)


@query(
    "regroup_applied",
    f"""SELECT o_orderkey, coalesce({_PRIORITY_CASE}, o_orderpriority) AS "TFB_o_orderpriority" FROM orders""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    groups = grouping.regroup(df, "o_orderpriority", _PRIORITIES)
    return grouping.apply_grouping(df, groups, "o_orderpriority")


@query(
    "regroup_unmapped",
    """SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'low' END AS "TFB_p_brand" FROM part""",
)
def _(spark, sf_dir):
    """Values outside the saved regrouping end as NULL."""
    df = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    known = df.where(F.col("p_brand").isin("Brand#1", "Brand#2"))
    groups = grouping.regroup(known, "p_brand", {"Brand#1": "low", "Brand#2": "low"})
    return grouping.apply_grouping(df, groups, "p_brand")
