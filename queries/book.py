"""Feature book, label and base-table queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from queries.registry import query, sql_round
from tidemark.plans.book import build_book
from tidemark.plans.label import build_abt, label_inactivity, monthly_activity
from tidemark.plans.spec import month_starts
from tidemark.session import configure_wide, shared_path
from tidemark.sources.fixtures import BRANDS, CUSTOMER_SPEC, SUPPLIER_SPEC, book_tables, table
from tidemark.sources.loading import table_counts
from tidemark.sources.tables import latest_vintage

SUPPLIER_DATE = date(1998, 1, 1)
SUPPLIER_DATES = month_starts(date(1997, 1, 1), date(1997, 12, 1))
IRREGULAR_DATES = [date(1996, 2, 15), date(1996, 3, 31), date(1998, 7, 7)]
ABT_FIRST, ABT_LAST = date(1996, 1, 1), date(2001, 1, 1)
ABT_DATES = month_starts(ABT_FIRST, ABT_LAST)


def _dates_cte(dates: list[date]) -> str:
    values = ", ".join(f"(DATE '{d}')" for d in dates)
    return f"SELECT d FROM (VALUES {values}) v(d)"


def abt_dates_cte() -> str:
    return (
        "SELECT CAST(unnest(generate_series("
        f"DATE '{ABT_FIRST}', DATE '{ABT_LAST}', INTERVAL 1 MONTH)) AS DATE) AS d"
    )


_ROLES = """
shipped AS (SELECT l_orderkey AS oid, max(l_shipdate) AS got FROM lineitem GROUP BY l_orderkey),
ord AS (
  SELECT o_orderkey AS oid, o_custkey AS cust, o_orderdate AS bought,
         o_orderdate + INTERVAL 60 DAY AS due, got
  FROM orders LEFT JOIN shipped ON oid = o_orderkey WHERE o_orderstatus = 'F'),
itm AS (
  SELECT l_orderkey AS oid, l_suppkey AS supp, l_partkey AS prod,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight
  FROM lineitem),
rev AS (
  SELECT event_id AS rid, event_id // 2 AS oid, 1 + CAST(floor(value) AS BIGINT) % 5 AS score FROM events),
geo AS (
  SELECT {geo_key} AS k, r_name AS seller_city, n_name AS seller_state
  FROM {geo_table} LEFT JOIN nation ON {geo_nation} = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)
"""

_DAYS = "(epoch_us({a}) - epoch_us({b})) / 86400000000.0"


def book_sql(dates_cte: str, entity: str, joins: str = "") -> str:
    """The book by plain joins and distinct counts over the multiplied rows."""
    supplier = entity == "seller_id"
    ent = "supp" if supplier else "cust"
    roles = _ROLES.format(
        geo_key="s_suppkey" if supplier else "c_custkey",
        geo_table="supplier" if supplier else "customer",
        geo_nation="s_nationkey" if supplier else "c_nationkey",
    )
    r2 = lambda e: sql_round(e, 2)
    late = "(due < got)"
    counts = ",\n".join(
        f"CAST(count(*) FILTER (WHERE brand = '{b}') AS BIGINT) AS qtd_{b.lower().replace('#', '_')}"
        for b in BRANDS
    )
    named = ", ".join(f"'{b}'" for b in BRANDS)
    return f"""
WITH ref AS ({dates_cte}), {roles},
first_sale AS (
  SELECT {ent} AS e, min(bought) AS first_at FROM ord LEFT JOIN itm USING (oid) GROUP BY {ent}),
wide AS (
  SELECT ref.d, {ent} AS e, ord.bought, ord.due, ord.got, itm.oid AS item_order, prod, price, freight,
         p_brand AS brand, rid, score
  FROM ref JOIN ord ON ord.bought >= ref.d - INTERVAL 6 MONTH AND ord.bought < ref.d
  LEFT JOIN itm ON itm.oid = ord.oid
  LEFT JOIN part ON prod = p_partkey
  LEFT JOIN rev ON rev.oid = ord.oid),
raw AS (
  SELECT d, e,
    count(DISTINCT rid) AS n_rev, avg(score) AS rs, max(score) AS rmax, min(score) AS rmin,
    count(*) FILTER (WHERE score >= 4) AS good, count(*) FILTER (WHERE score < 4) AS poor, count(rid) AS nr,
    max(bought) AS last_at, count(DISTINCT month(bought)) AS active,
    count(*) FILTER (WHERE {late}) AS late,
    avg(CASE WHEN {late} THEN {_DAYS.format(a="got", b="due")} ELSE 0 END) AS days_late,
    avg({_DAYS.format(a="due", b="bought")}) AS planned,
    CAST(sum(price) AS DOUBLE) AS rev_tot, count(DISTINCT item_order) AS n_ord, count(price) AS n_price,
    CAST(sum(freight) AS DOUBLE) AS frt, count(freight) AS n_frt,
    count(prod) AS n_prod, count(DISTINCT prod) AS d_prod,
    {counts},
    CAST(count(*) FILTER (WHERE brand NOT IN ({named})) AS BIGINT) AS qtd_outros
  FROM wide GROUP BY d, e),
aged AS (
  SELECT raw.*, {r2(_DAYS.format(a="CAST(d AS TIMESTAMP)", b="first_at"))} AS idade_dias_base
  FROM raw LEFT JOIN first_sale ON first_sale.e = raw.e),
capped AS (
  SELECT *, 1 + CAST(trunc(idade_dias_base / 30) AS BIGINT) AS idade_meses_base,
    CASE WHEN idade_dias_base IS NULL THEN NULL
         ELSE least(1 + CAST(trunc(idade_dias_base / 30) AS BIGINT), 6) END AS cap
  FROM aged)
SELECT d AS dt_ref, seller_city, seller_state, e AS {entity},
  n_rev AS qtd_avaliacoes_recebidas,
  {r2("rs")} AS review_score_medio,
  CAST(rmax AS DOUBLE) AS review_score_max, CAST(rmin AS DOUBLE) AS review_score_min,
  {r2("good / nullif(nr, 0)")} AS prop_reviews_positivos,
  {r2("poor / nullif(nr, 0)")} AS prop_reviews_negativos,
  idade_dias_base, idade_meses_base,
  CAST(trunc({_DAYS.format(a="CAST(d AS TIMESTAMP)", b="last_at")}) AS BIGINT) AS idade_dias_ult_venda,
  active AS meses_ativado, {r2("active / cap")} AS perc_tempo_ativado,
  late AS qtd_atraso, late // nullif(n_ord, 0) AS prop_atraso,
  {r2("days_late")} AS media_dias_atraso, {sql_round("planned", 0)} AS med_dias_entrega_estimada,
  {r2("rev_tot")} AS receita_tot, n_ord AS qtd_vendas,
  {r2("rev_tot / nullif(n_price, 0)")} AS preco_medio_produto,
  {r2("frt / nullif(n_frt, 0)")} AS frete_medio, {r2("frt")} AS receita_frete_total,
  {r2("frt / nullif(rev_tot, 0)")} AS proporcao_frete_sobre_vendas,
  {r2("rev_tot / nullif(n_ord, 0)")} AS tkt_med_venda,
  {r2("rev_tot / cap")} AS tkt_med_venda_mes,
  {r2("rev_tot / nullif(active, 0)")} AS tkt_med_venda_mes_ativado,
  n_prod AS qtd_prod_vend, d_prod AS qtd_prod_dst_vend,
  {r2("rev_tot / nullif(n_prod, 0)")} AS tkt_med_venda_prod,
  n_prod // nullif(n_ord, 0) AS med_prod_por_vendas,
  {", ".join("qtd_" + b.lower().replace("#", "_") for b in BRANDS)}, qtd_outros{", flag_churn_3m" if joins else ""}
FROM capped LEFT JOIN geo ON k = e {joins}
"""


_LABEL = """
label AS (
  SELECT k.d AS ld, k.cust AS le,
         CASE WHEN count(m.mon) = 0 THEN 1 ELSE 0 END AS flag_churn_3m
  FROM (SELECT DISTINCT ref.d, o_custkey AS cust FROM orders, ref
        WHERE o_orderstatus = 'F' AND o_orderdate >= ref.d - INTERVAL 6 MONTH AND o_orderdate < ref.d) k
  LEFT JOIN (SELECT DISTINCT date_trunc('month', o_orderdate) AS mon, o_custkey AS cust
             FROM orders WHERE o_orderstatus = 'F') m
    ON m.cust = k.cust AND m.mon BETWEEN k.d AND k.d + INTERVAL 3 MONTH
  GROUP BY 1, 2)
"""


def abt_sql() -> str:
    base = book_sql(abt_dates_cte(), "customer_id", joins="JOIN label ON ld = d AND le = e")
    return base.replace("first_sale AS (", _LABEL.strip() + ",\nfirst_sale AS (", 1)


def supplier_book(spark, sf_dir):
    return build_book(book_tables(spark, sf_dir), [SUPPLIER_DATE], SUPPLIER_SPEC)


def customer_abt(spark, sf_dir):
    tables = book_tables(configure_wide(spark), sf_dir, "customer")
    return build_abt(tables, ABT_DATES, CUSTOMER_SPEC)


@query("book_supplier", book_sql(_dates_cte([SUPPLIER_DATE]), "seller_id"))
def _(spark, sf_dir):
    return supplier_book(spark, sf_dir)


@query("book_multi_vintage", book_sql(_dates_cte(SUPPLIER_DATES), "seller_id"))
def _(spark, sf_dir):
    return build_book(book_tables(spark, sf_dir), SUPPLIER_DATES, SUPPLIER_SPEC)


@query("book_irregular_dates", book_sql(_dates_cte(IRREGULAR_DATES), "seller_id"))
def _(spark, sf_dir):
    return build_book(book_tables(spark, sf_dir), IRREGULAR_DATES, SUPPLIER_SPEC)


_PRE_MEASURES = f"""
WITH {_ROLES.format(geo_key="s_suppkey", geo_table="supplier", geo_nation="s_nationkey")},
win AS (SELECT * FROM ord WHERE bought >= DATE '{SUPPLIER_DATE}' - INTERVAL 6 MONTH AND bought < DATE '{SUPPLIER_DATE}'),
per_review AS (
  SELECT oid, count(rid) AS n, count(score) AS ns, sum(score) AS ss FROM rev GROUP BY oid),
per_order AS (SELECT DISTINCT supp, win.oid, itm.oid AS item_order, due, got FROM win LEFT JOIN itm USING (oid)),
by_order AS (
  SELECT supp, count(item_order) AS qtd_vendas,
    CAST(coalesce(sum(n), 0) AS BIGINT) AS qtd_avaliacoes_recebidas,
    {sql_round("CAST(sum(ss) AS DOUBLE) / nullif(sum(ns), 0)", 2)} AS review_score_medio,
    CAST(count(*) FILTER (WHERE due < got) AS BIGINT) AS qtd_atraso,
    {sql_round(f"avg(CASE WHEN due < got THEN {_DAYS.format(a='got', b='due')} ELSE 0 END)", 2)} AS media_dias_atraso
  FROM per_order LEFT JOIN per_review ON per_review.oid = per_order.oid GROUP BY supp),
by_item AS (
  SELECT supp, {sql_round("CAST(sum(price) AS DOUBLE)", 2)} AS receita_tot,
    {sql_round("CAST(sum(price) AS DOUBLE) / nullif(count(price), 0)", 2)} AS preco_medio_produto,
    count(prod) AS qtd_prod_vend, count(DISTINCT prod) AS qtd_prod_dst_vend
  FROM win LEFT JOIN itm USING (oid) GROUP BY supp)
SELECT by_order.supp AS seller_id, by_order.* EXCLUDE (supp), by_item.* EXCLUDE (supp)
FROM by_order JOIN by_item ON by_order.supp IS NOT DISTINCT FROM by_item.supp
"""


def preaggregated_sql(dates_cte: str) -> str:
    """All metrics of the supplier book, with every item, order and review counted once."""
    plain = book_sql(dates_cte, "seller_id")
    start, end = plain.index("wide AS ("), plain.index("aged AS (")
    named = ", ".join(f"'{b}'" for b in BRANDS)
    brands = [b.lower().replace("#", "_") for b in BRANDS]
    counts = ", ".join(f"count(*) FILTER (WHERE p_brand = '{b}') AS qtd_{c}" for b, c in zip(BRANDS, brands))
    raw = f"""
win AS (SELECT ref.d, ord.* FROM ref JOIN ord ON ord.bought >= ref.d - INTERVAL 6 MONTH AND ord.bought < ref.d),
per_review AS (
  SELECT oid, count(rid) AS n, count(score) AS ns, sum(score) AS ss, max(score) AS smax, min(score) AS smin,
    count(*) FILTER (WHERE score >= 4) AS ngood, count(*) FILTER (WHERE score < 4) AS npoor
  FROM rev GROUP BY oid),
per_order AS (
  SELECT DISTINCT d, supp AS e, win.oid, itm.oid AS item_order, bought, due, got FROM win LEFT JOIN itm USING (oid)),
by_order AS (
  SELECT d, e, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rev, CAST(sum(ss) AS DOUBLE) / nullif(sum(ns), 0) AS rs,
    max(smax) AS rmax, min(smin) AS rmin, sum(ngood) AS good, sum(npoor) AS poor, sum(n) AS nr,
    max(bought) AS last_at, count(DISTINCT month(bought)) AS active, count(*) FILTER (WHERE due < got) AS late,
    avg(CASE WHEN due < got THEN {_DAYS.format(a="got", b="due")} ELSE 0 END) AS days_late,
    avg({_DAYS.format(a="due", b="bought")}) AS planned, count(item_order) AS n_ord
  FROM per_order LEFT JOIN per_review USING (oid) GROUP BY d, e),
by_item AS (
  SELECT d, supp AS e, CAST(sum(price) AS DOUBLE) AS rev_tot, count(price) AS n_price,
    CAST(sum(freight) AS DOUBLE) AS frt, count(freight) AS n_frt, count(prod) AS n_prod, count(DISTINCT prod) AS d_prod,
    {counts}, count(*) FILTER (WHERE p_brand NOT IN ({named})) AS qtd_outros
  FROM win LEFT JOIN itm USING (oid) LEFT JOIN part ON prod = p_partkey GROUP BY d, supp),
raw AS (
  SELECT o.*, i.* EXCLUDE (d, e) FROM by_order o JOIN by_item i ON o.d = i.d AND o.e IS NOT DISTINCT FROM i.e),
"""
    return plain[:start] + raw.lstrip() + plain[end:]


_PRE_COLUMNS = (
    "qtd_vendas qtd_avaliacoes_recebidas review_score_medio qtd_atraso media_dias_atraso receita_tot "
    "preco_medio_produto qtd_prod_vend qtd_prod_dst_vend"
).split()


# All metrics, nine of them from sums per order and per item instead.
@query(
    "book_preaggregated",
    f"""SELECT a.* REPLACE ({", ".join(f"b.{c} AS {c}" for c in _PRE_COLUMNS)})
        FROM ({preaggregated_sql(_dates_cte([SUPPLIER_DATE]))}) a JOIN ({_PRE_MEASURES}) b
          ON a.seller_id IS NOT DISTINCT FROM b.seller_id""",
)
@query("book_preaggregated_all", preaggregated_sql(_dates_cte([SUPPLIER_DATE])))
def _(spark, sf_dir):
    """Corrected variant with all metrics."""
    return build_book(book_tables(spark, sf_dir), [SUPPLIER_DATE], SUPPLIER_SPEC, fanout="preaggregate")


@query(
    "monthly_activity",
    """SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS dt_venda, l_suppkey AS seller_id
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'""",
)
def _(spark, sf_dir):
    return monthly_activity(book_tables(spark, sf_dir), SUPPLIER_SPEC)


@query(
    "label_inactive",
    f"WITH ref AS ({abt_dates_cte()}), {_LABEL} SELECT ld AS dt_ref, le AS customer_id, flag_churn_3m FROM label",
)
def _(spark, sf_dir):
    tables = book_tables(spark, sf_dir, "customer")
    book = build_book(tables, ABT_DATES, CUSTOMER_SPEC).select("dt_ref", "customer_id")
    return label_inactivity(book, tables, CUSTOMER_SPEC)


@query("abt_customer", abt_sql())
def _(spark, sf_dir):
    return customer_abt(spark, sf_dir)


_LATEST_KEY = "SELECT * FROM ({abt}) q WHERE dt_ref = (SELECT max(dt_ref) FROM ({abt}) r)"


@query("latest_vintage", _LATEST_KEY.format(abt=abt_sql()))
def _(spark, sf_dir):
    path = shared_path(spark)
    customer_abt(spark, sf_dir).write.partitionBy("dt_ref").parquet(path)
    abt = spark.read.parquet(path)
    return latest_vintage(abt)


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _TABLES),
)
def _(spark, sf_dir):
    return table_counts({t: table(spark, sf_dir, t) for t in _TABLES})


_DEDUPE_ORDER = (
    "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()
)


@query(
    "dedupe_first",
    f"""SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY {", ".join(_DEDUPE_ORDER)}) AS rn FROM lineitem) q
        WHERE rn = 1""",
)
def _(spark, sf_dir):
    from tidemark.operators.dedupe import keep_first

    return keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _DEDUPE_ORDER)


@query(
    "temporal_split",
    f"""WITH ref AS ({abt_dates_cte()}), {_LABEL},
        part_of AS (SELECT CASE WHEN ld <= DATE '1999-12-01' THEN 'train'
                                WHEN ld BETWEEN DATE '2000-01-01' AND DATE '2000-06-01' THEN 'test' END AS split,
                           flag_churn_3m FROM label)
        SELECT split, count(*) AS rows, CAST(sum(flag_churn_3m) AS BIGINT) AS events,
               {sql_round("avg(flag_churn_3m)", 6)} AS event_rate
        FROM part_of WHERE split IS NOT NULL GROUP BY split""",
)
def _(spark, sf_dir):
    from tidemark.plans.modeling import temporal_split

    tables = book_tables(spark, sf_dir, "customer")
    book = build_book(tables, ABT_DATES, CUSTOMER_SPEC).select("dt_ref", "customer_id")
    split = temporal_split(
        label_inactivity(book, tables, CUSTOMER_SPEC),
        train=(date(1996, 1, 1), date(1999, 12, 1)),
        test=(date(2000, 1, 1), date(2000, 6, 1)),
    )
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("flag_churn_3m").alias("events"),
        F.round(F.avg("flag_churn_3m"), 6).alias("event_rate"),
    )
