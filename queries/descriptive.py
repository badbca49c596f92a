"""Stability by vintage and descriptive queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.book import ABT_DATES, _LABEL, abt_dates_cte
from queries.common import LABELLED_SQL, labelled, rounded
from queries.metrics import _METRIC_COLS, curve_sql
from queries.registry import query, sql_round
from tidemark.operators import describe, stability
from tidemark.plans.book import build_book
from tidemark.plans.label import label_inactivity
from tidemark.session import materialize
from tidemark.sources.fixtures import CUSTOMER_SPEC, book_tables, table

_VINTAGES = f"""ref AS ({abt_dates_cte()}), {_LABEL.strip()},
  place AS (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  last_sale AS (
    SELECT ref.d, o_custkey AS cust,
      CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), ref.d) AS BIGINT) AS idle
    FROM ref JOIN orders ON o_orderdate >= ref.d - INTERVAL 6 MONTH AND o_orderdate < ref.d
    WHERE o_orderstatus = 'F' GROUP BY 1, 2),
  abt AS (SELECT ld AS dt_ref, r_name, idle, flag_churn_3m AS y FROM label
          JOIN last_sale ON d = ld AND cust = le LEFT JOIN place ON c_custkey = le)"""


def _vintages(spark, sf_dir):
    """Book columns used below with the flag; the rest of the book is pruned away."""
    tables = book_tables(spark, sf_dir, "customer")
    book = build_book(tables, ABT_DATES, CUSTOMER_SPEC)
    book = book.select("dt_ref", "customer_id", "seller_city", "idade_dias_ult_venda")
    return label_inactivity(book, tables, CUSTOMER_SPEC)


@query(
    "event_rate_by_vintage",
    f"""WITH {_VINTAGES} SELECT CAST(dt_ref AS VARCHAR) AS "Safra", {sql_round("avg(y)", 6)} AS "Taxa_de_Evento", count(*) AS "Volume"
        FROM abt GROUP BY 1""",
)
def _(spark, sf_dir):
    return rounded(stability.rate_by_vintage(_vintages(spark, sf_dir), "flag_churn_3m", "dt_ref"))


@query(
    "rate_by_category",
    f"""WITH {_VINTAGES} SELECT r_name AS seller_city, {sql_round("avg(y)", 6)} AS "Taxa_de_Evento", count(*) AS "Volume"
        FROM abt WHERE r_name IS NOT NULL GROUP BY 1""",
)
def _(spark, sf_dir):
    return rounded(stability.rate_by_category(_vintages(spark, sf_dir), "seller_city", "flag_churn_3m"))


@query(
    "rate_by_rounded_number",
    f"""SELECT CAST(round_even(CAST(CAST(l_tax AS VARCHAR) AS DECIMAL(38,15)), 4)::DOUBLE AS VARCHAR) AS l_tax,
          {sql_round("avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)", 6)} AS "Taxa_de_Evento", count(*) AS "Volume"
        FROM lineitem GROUP BY 1""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(stability.rate_by_category(df, "l_tax", "y"))


@query(
    "rate_by_vintage_category",
    f"""WITH {_VINTAGES} SELECT dt_ref, r_name AS seller_city, {sql_round("avg(y)", 6)} AS "Taxa_de_Evento", count(*) AS "Volume",
          CAST(sum(count(*)) OVER (PARTITION BY dt_ref) AS BIGINT) AS "Volume_Safra"
        FROM abt WHERE r_name IS NOT NULL GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return rounded(
        stability.rate_by_vintage_category(_vintages(spark, sf_dir), "flag_churn_3m", "seller_city", "dt_ref")
    )


@query(
    "ks_gini_by_vintage",
    f"""WITH {_VINTAGES}, {curve_sql("abt", "idle", "y", "dt_ref")}
        SELECT g AS dt_ref, {sql_round("100 * (" + _METRIC_COLS["ks_signed"] + ")", 6)} AS "KS",
               {sql_round("100 * (" + _METRIC_COLS["gini"] + ")", 6)} AS "Gini" FROM curve GROUP BY g""",
)
def _(spark, sf_dir):
    # Read by two jobs, so it is written once.
    rows = materialize(_vintages(spark, sf_dir).select("dt_ref", "idade_dias_ult_venda", "flag_churn_3m"))
    return rounded(stability.ks_gini_by_vintage(rows, "flag_churn_3m", "idade_dias_ult_venda", "dt_ref"))


@query(
    "event_rates",
    f"""WITH f AS ({LABELLED_SQL}) SELECT * FROM (
          SELECT 'lang' AS variable, lang AS value, {sql_round("avg(quality)", 6)} AS "Taxa_de_Evento", count(*) AS "Volume" FROM f GROUP BY lang
          UNION ALL SELECT 'source', source, {sql_round("avg(quality)", 6)}, count(*) FROM f GROUP BY source
          UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), {sql_round("avg(quality)", 6)}, count(*) FROM f GROUP BY toxic) q""",
)
def _(spark, sf_dir):
    return rounded(describe.event_rates(labelled(spark, sf_dir), "quality", 20))


@query(
    "value_counts_total",
    f"""SELECT source, count(*) AS "Count", {sql_round("count(*) / (SELECT count(*) FROM documents WHERE source IS NOT NULL) * 100", 6)} AS "Percentage"
        FROM documents WHERE source IS NOT NULL GROUP BY source
        UNION ALL SELECT 'Total', count(*), 100.0 FROM documents WHERE source IS NOT NULL""",
)
def _(spark, sf_dir):
    return rounded(describe.value_counts(table(spark, sf_dir, "documents"), ["source"]))


@query(
    "crosstab_share",
    f"""WITH f AS ({LABELLED_SQL}),
        c AS (SELECT 'lang' AS variable, lang AS value, quality AS target, count(*) AS n FROM f GROUP BY 2, 3
              UNION ALL SELECT 'source', source, quality, count(*) FROM f GROUP BY 2, 3)
        SELECT *, {sql_round("n / sum(n) OVER (PARTITION BY variable, value)", 6)} AS share FROM c""",
)
def _(spark, sf_dir):
    return rounded(describe.crosstab_share(labelled(spark, sf_dir), ["lang", "source"], "quality"))


@query(
    "crosstab_low_cardinality",
    f"""WITH f AS ({LABELLED_SQL}),
        c AS (SELECT 'lang' AS variable, lang AS value, quality AS target, count(*) AS n FROM f GROUP BY 2, 3)
        SELECT *, {sql_round("n / sum(n) OVER (PARTITION BY variable, value)", 6)} AS share FROM c""",
)
def _(spark, sf_dir):
    return rounded(describe.crosstab_low_cardinality(labelled(spark, sf_dir), "quality", 10))


@query(
    "category_counts",
    """SELECT 'lang' AS variable, lang AS value, count(*) AS n FROM documents GROUP BY lang
       UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source""",
)
def _(spark, sf_dir):
    return describe.category_counts(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), cut=30)


def _hist_sql(source: str, column: str, bins: int, where: str = "TRUE") -> str:
    return f"""SELECT bin, lo + bin * w AS lo, CASE WHEN bin = {bins - 1} THEN hi ELSE lo + (bin + 1) * w END AS hi, count(*) AS n
      FROM (SELECT CAST(len(list_filter(range(1, {bins}), lambda i: i * ((hi - lo) / {bins}) + lo <= v)) AS INTEGER) AS bin,
              lo, hi, (hi - lo) / {bins} AS w
            FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {source} WHERE {where} AND {column} IS NOT NULL) a,
                 (SELECT min(CAST({column} AS DOUBLE)) AS lo, max(CAST({column} AS DOUBLE)) AS hi FROM {source} WHERE {where}) b) c
      GROUP BY bin, lo, hi, w"""


@query(
    "histogram",
    f"""SELECT 'value' AS variable, bin, {sql_round("lo", 6)} AS lo, {sql_round("hi", 6)} AS hi, n FROM ({_hist_sql("events", "value", 30)}) q""",
)
def _(spark, sf_dir):
    return rounded(describe.histogram(table(spark, sf_dir, "events"), ["value"], 30))


@query(
    "histogram_by_class",
    " UNION ALL ".join(
        f"""SELECT 'score' AS variable, {k} AS class, bin, {sql_round("lo", 6)} AS lo, {sql_round("hi", 6)} AS hi, n,
            {sql_round("n / (sum(n) OVER () * (hi - lo))", 4)} AS density
            FROM ({_hist_sql(f"({LABELLED_SQL}) f", "score", 50, f"quality = {k}")}) q"""
        for k in (0, 1)
    ),
)
def _(spark, sf_dir):
    """Score distribution of events and non-events."""
    h = describe.histogram(labelled(spark, sf_dir), ["score"], 50, by="quality", density=True)
    return rounded(h.withColumn("density", F.round("density", 4)))


def _box_sql(source: str, column: str, by: str) -> str:
    return f"""SELECT {by} AS class, q[1] AS q1, q[2] AS median, q[3] AS q3,
        min(v) FILTER (WHERE v BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1])) AS whisker_lo,
        max(v) FILTER (WHERE v BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1])) AS whisker_hi,
        count(*) FILTER (WHERE v < q[1] - 1.5 * (q[3] - q[1]) OR v > q[3] + 1.5 * (q[3] - q[1])) AS outliers
      FROM (SELECT {by}, CAST({column} AS DOUBLE) AS v FROM {source}) a
      JOIN (SELECT {by}, quantile_cont(CAST({column} AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM {source} GROUP BY {by}) b USING ({by})
      GROUP BY ALL"""


@query(
    "box_stats",
    f"""SELECT 'value' AS variable, class, {", ".join(f"{sql_round(c, 6)} AS {c}" for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi"))}, outliers
        FROM ({_box_sql("events", "value", "event_type")}) q""",
)
def _(spark, sf_dir):
    return rounded(describe.box_stats(table(spark, sf_dir, "events"), ["value"], "event_type"))


def _kde_sql(source: str, column: str, where: str, grid: int) -> str:
    return f"""SELECT point, lo + point * step AS x, sum(exp(-0.5 * power((lo + point * step - v) / w, 2))) / (max(n) * max(w) * sqrt(2 * pi())) AS density
      FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {source} WHERE {where}) a,
           (SELECT n, w, a - 3 * w AS lo, ((b + 3 * w) - (a - 3 * w)) / {grid - 1} AS step FROM (
              SELECT count(*) AS n, min({column})::DOUBLE AS a, max({column})::DOUBLE AS b,
                     stddev_samp({column}) * power(count(*), -0.2) AS w FROM {source} WHERE {where}) s) p,
           (SELECT CAST(unnest(range({grid})) AS INTEGER) AS point) g
      GROUP BY point, lo, step"""


@query(
    "density",
    " UNION ALL ".join(
        f"""SELECT 'value' AS variable, '{k}' AS class, point, {sql_round("x", 6)} AS x, {sql_round("density", 9)} AS density
            FROM ({_kde_sql("events", "value", f"event_type = '{k}'", 100)}) q"""
        for k in ("click", "purchase", "signup", "view", "error")
    ),
)
def _(spark, sf_dir):
    d = describe.kernel_density(table(spark, sf_dir, "events"), ["value"], "event_type", grid=100)
    return d.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})
