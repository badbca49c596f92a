"""Weight of evidence, information value and selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.book import abt_sql, customer_abt
from queries.common import LABELLED_SQL, bin_sql, labelled, quantile_edges_sql, rounded, width_edges_sql
from queries.registry import query, sql_even, sql_round
from tidemark.operators import screening, selection
from tidemark.session import materialize
from tidemark.sources.fixtures import BRANDS, table


def counts_sql(numbers: list[str], texts: list[str], target: str, q: int = 10) -> str:
    """CTEs ``e_<col>`` and ``counts`` (feature, value, lo, hi, n, n1) over a CTE ``f``."""
    edges = [f"e_{c} AS ({quantile_edges_sql('f', c, q, f'{target} IS NOT NULL')})" for c in numbers]
    parts = [
        f"""SELECT '{c}' AS feature, CAST(bin AS VARCHAR) AS value, e[bin + 1] AS lo, e[bin + 2] AS hi,
              count(*) AS n, CAST(sum(t) AS BIGINT) AS n1
            FROM (SELECT {bin_sql(c)} AS bin, {target} AS t, e FROM f, e_{c} WHERE {target} IS NOT NULL) b
            WHERE bin IS NOT NULL GROUP BY ALL"""
        for c in numbers
    ]
    parts += [
        f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi,
              count(*) AS n, CAST(sum({target}) AS BIGINT) AS n1
            FROM f WHERE {c} IS NOT NULL AND {target} IS NOT NULL GROUP BY {c}"""
        for c in texts
    ]
    return ", ".join(edges) + (", " if edges else "") + "counts AS (" + " UNION ALL ".join(parts) + ")"


_WOE_STEPS = """totals AS (SELECT feature, sum(n) AS tn, sum(n1) AS t1 FROM counts GROUP BY feature),
shares AS (
  SELECT c.*, CASE WHEN n1 = 0 THEN 1e-6 ELSE n1 / t1::DOUBLE END AS dg,
         CASE WHEN n1 = n THEN 1e-6 ELSE (n - n1) / (tn - t1)::DOUBLE END AS db
  FROM counts c JOIN totals USING (feature)),
woe AS (SELECT *, ln(dg / db) AS w, (dg - db) * ln(dg / db) AS term FROM shares)"""

_DOC_F = f"f AS (SELECT lang, source, n_chars, toxic, quality FROM ({LABELLED_SQL}) q)"
_DOC_COUNTS = counts_sql(["n_chars", "toxic"], ["lang", "source"], "quality")


def _features(spark, sf_dir):
    return labelled(spark, sf_dir).select("lang", "source", "n_chars", "toxic", "quality")


@query(
    "woe_iv",
    f"""WITH {_DOC_F}, {counts_sql(["n_chars"], [], "quality")}, {_WOE_STEPS}
        SELECT feature, value, {sql_round("lo", 6)} AS lo, {sql_round("hi", 6)} AS hi, n, n1 AS good, n - n1 AS bad,
          {sql_round("dg", 6)} AS distr_good, {sql_round("db", 6)} AS distr_bad,
          {sql_round("w", 6)} AS woe, {sql_round("term", 6)} AS iv FROM woe""",
)
def _(spark, sf_dir):
    return rounded(screening.woe_iv(_features(spark, sf_dir), "n_chars", "quality"))


def _iv_sql(ctes: str) -> str:
    return f"""WITH {ctes}, {_WOE_STEPS},
      total AS (SELECT feature, sum(term) AS iv FROM woe GROUP BY feature)
      SELECT feature AS "Variavel", {sql_round("iv", 6)} AS "IV",
        CASE WHEN iv < 0.02 THEN 'Inútil para a predição' WHEN iv < 0.1 THEN 'Preditor Fraco'
             WHEN iv < 0.3 THEN 'Preditor Moderado' ELSE 'Preditor Forte' END AS "Preditividade" FROM total"""


@query("iv_table", _iv_sql(f"{_DOC_F}, {_DOC_COUNTS}"))
def _(spark, sf_dir):
    return rounded(screening.iv_table(_features(spark, sf_dir), "quality"))


_ABT_TEXTS = ["seller_city", "seller_state"]

# All metrics of the book.
BOOK_NUMBERS = (
    "qtd_avaliacoes_recebidas review_score_medio review_score_max review_score_min prop_reviews_positivos "
    "prop_reviews_negativos idade_dias_base idade_meses_base idade_dias_ult_venda meses_ativado perc_tempo_ativado "
    "qtd_atraso prop_atraso media_dias_atraso med_dias_entrega_estimada receita_tot qtd_vendas preco_medio_produto "
    "frete_medio receita_frete_total proporcao_frete_sobre_vendas tkt_med_venda tkt_med_venda_mes "
    "tkt_med_venda_mes_ativado qtd_prod_vend qtd_prod_dst_vend tkt_med_venda_prod med_prod_por_vendas"
).split() + [*["qtd_" + b.lower().replace("#", "_") for b in BRANDS], "qtd_outros"]


_IV_ABT = f"""SELECT v AS "Variavel", coalesce("IV", 0.0::DOUBLE) AS "IV", coalesce("Preditividade", 'Inútil para a predição') AS "Preditividade"
        FROM (SELECT unnest([{", ".join(f"'{c}'" for c in _ABT_TEXTS + BOOK_NUMBERS)}]) AS v) names
        LEFT JOIN ({_iv_sql(f"f AS MATERIALIZED ({abt_sql()}), {counts_sql(BOOK_NUMBERS, _ABT_TEXTS, 'flag_churn_3m')}")}) found
        ON v = "Variavel\""""


@query("iv_table_abt", _IV_ABT)
@query("iv_table_abt_all", _IV_ABT)
def _(spark, sf_dir):
    """Information value of every variable of the base table; one with a single bin scores zero."""
    abt = materialize(customer_abt(spark, sf_dir))
    return rounded(screening.iv_table(abt.drop("customer_id", "dt_ref"), "flag_churn_3m"))


_BIV = f"""WITH {_DOC_F}, {_DOC_COUNTS},
  totals AS (SELECT feature, sum(n) AS tn, sum(n1) AS t1 FROM counts GROUP BY feature),
  a AS (SELECT c.*, tn, t1, n - n1 AS n0, {sql_even("n1 / nullif(t1, 0) * 100", 2)} AS p1,
          {sql_even("(n - n1) / nullif(tn - t1, 0) * 100", 2)} AS p0r FROM counts c JOIN totals USING (feature)),
  b AS (SELECT *, CASE WHEN p0r = 0 THEN 0.01 ELSE p0r END AS p0 FROM a),
  c2 AS (SELECT *, {sql_even("p1 / p0", 2)} AS oddsr FROM b),
  d AS (SELECT *, CASE WHEN oddsr = 0 THEN 0.01 ELSE oddsr END AS odds FROM c2),
  g AS (SELECT *, {sql_even("ln(odds)", 2)} AS lo_odds FROM d),
  biv AS (
    SELECT feature AS "Variavel", value AS "Var_Range", {sql_round("lo", 6)} AS lo, {sql_round("hi", 6)} AS hi,
      n1 AS "Target_1", n0 AS "Target_0", n AS "Total", {sql_even("n / tn * 100", 2)} AS "pct_Freq",
      p1 AS "pct_Target_1", CAST(p0 AS DOUBLE) AS "pct_Target_0", {sql_even("n1 / n * 100", 2)} AS "pct_Taxa_de_Target_1",
      CAST(odds AS DOUBLE) AS "Odds", lo_odds AS "LN_Odds",
      CASE WHEN odds = 0.01 THEN 0.0 ELSE {sql_even("(p1 / 100 - p0 / 100) * lo_odds", 2)} END AS "IV" FROM g)"""


@query("bivariate", f"{_BIV} SELECT * FROM biv")
def _(spark, sf_dir):
    return rounded(screening.bivariate_table(_features(spark, sf_dir), "quality"))


@query("bivariate_of", f"""{_BIV} SELECT * FROM biv WHERE "Variavel" = 'n_chars'""")
def _(spark, sf_dir):
    table_ = screening.bivariate_table(_features(spark, sf_dir), "quality")
    # An older table with other figures for the same ranges: the newer rows must win.
    older = table_.withColumns({"IV": F.lit(-1.0), "Total": F.col("Total") + 1})
    return rounded(screening.bivariate_of(screening.merge_bivariate(older, table_), "n_chars"))


@query("iv_ranking", f"""{_BIV} SELECT "Variavel", {sql_even('sum("IV")', 2)} AS "IV" FROM biv GROUP BY 1""")
def _(spark, sf_dir):
    return screening.iv_ranking(screening.bivariate_table(_features(spark, sf_dir), "quality"))


def _share_sql(variable: str) -> str:
    return f"""totals AS (SELECT sum(n) AS tn, sum(n1) AS t1 FROM counts),
      s AS (SELECT value, lo, hi, n1, n - n1 AS n0, {sql_even("n1 / t1 * 100", 2)} AS py,
              {sql_even("(n - n1) / (tn - t1) * 100", 2)} AS pn, {sql_even("n1 / n * 100", 2)} AS pl FROM counts, totals)
      SELECT value AS {variable}, {sql_round("lo", 6)} AS lo, {sql_round("hi", 6)} AS hi, n1 AS "Sim", n0 AS "Nao",
        py AS "pct_Sim", pn AS "pct_Nao", pl AS "pct_FreqLinha", {sql_round("py / nullif(pn, 0)", 6)} AS "WoE",
        {sql_round("(py / 100 - pn / 100) * CASE WHEN py > 0 AND pn > 0 THEN ln(py / pn) ELSE 0 END", 6)} AS "IV" FROM s"""


@query("iv_category", f"WITH {_DOC_F}, {counts_sql([], ['lang'], 'quality')}, {_share_sql('lang')}")
def _(spark, sf_dir):
    return rounded(screening.category_iv(_features(spark, sf_dir), "quality", "lang"))


@query(
    "iv_bin",
    f"""WITH {_DOC_F}, ed AS ({width_edges_sql("f", "n_chars", 6)}),
        counts AS (SELECT CAST(bin AS VARCHAR) AS value, e[bin + 1] AS lo, e[bin + 2] AS hi, count(*) AS n,
                     CAST(sum(quality) AS BIGINT) AS n1
                   FROM (SELECT {bin_sql("n_chars")} AS bin, quality, e FROM f, ed) b GROUP BY ALL),
        {_share_sql("n_chars")}""",
)
def _(spark, sf_dir):
    return rounded(screening.bin_iv(_features(spark, sf_dir), "quality", "n_chars", 6))


def logodds_sql(target: str, numbers: list[str], texts: list[str], clip: bool) -> str:
    """CTE chain ending in ``curve`` (variable, bin, x, n, event_rate, log_odds) over ``f``."""
    edges, parts = [], []
    for c in numbers:
        sizes = " UNION ALL ".join(
            f"SELECT {n} AS k, e FROM ({width_edges_sql('f', c, n)}) w{n}" for n in range(2, 11)
        )
        edges.append(f"w_{c} AS (SELECT e FROM ({sizes}) s WHERE k = (SELECT least(10, count(DISTINCT {c})) FROM f))")
        parts.append(f"""SELECT '{c}' AS variable, CAST(bin AS VARCHAR) AS bin, avg(v) AS x, count(*) AS n, avg(t) AS event_rate
          FROM (SELECT {bin_sql(c)} AS bin, CAST({c} AS DOUBLE) AS v, {target} AS t FROM f, w_{c}) b
          WHERE bin IS NOT NULL GROUP BY bin""")
    for c in texts:
        parts.append(f"""SELECT '{c}', {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS DOUBLE), count(*), avg({target})
          FROM f WHERE {c} IS NOT NULL GROUP BY {c}""")
    rate = "greatest(least(event_rate, 1 - 1e-6), 1e-6)" if clip else "event_rate"
    return f"""{", ".join(edges)}{", " if edges else ""}points AS ({" UNION ALL ".join(parts)}),
      curve AS (SELECT *, ln({rate} / (1 - {rate})) AS log_odds FROM points WHERE {rate} > 0 AND {rate} < 1)"""


def _r2_sql() -> str:
    return f"""SELECT variable AS "Variable", {sql_round("regr_r2(log_odds, x)", 6)} AS "R2",
      CASE WHEN regr_r2(log_odds, x) > 0.85 THEN 'Usar como contínua' ELSE 'Categorizar' END AS "Feat_Eng"
      FROM curve GROUP BY variable HAVING count(*) >= 2"""


_ORDER_F = (
    "f AS (SELECT o_totalprice, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done, "
    "month(o_orderdate) AS m FROM orders)"
)


def _order_features(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_totalprice",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("done"),
        F.month("o_orderdate").alias("m"),
    )


@query("logodds_r2", f"WITH {_ORDER_F}, {logodds_sql('done', ['o_totalprice', 'm'], [], False)} {_r2_sql()}")
def _(spark, sf_dir):
    return rounded(screening.logodds_r2(_order_features(spark, sf_dir), ["o_totalprice", "m"], "done"))


@query(
    "logodds_r2_clipped",
    f"WITH {_DOC_F}, {logodds_sql('quality', ['n_chars', 'toxic'], ['lang', 'source'], True)} {_r2_sql()}",
)
def _(spark, sf_dir):
    df = _features(spark, sf_dir)
    return rounded(screening.logodds_r2(df, ["n_chars", "toxic", "lang", "source"], "quality", clip=True))


@query(
    "logodds_curve",
    f"""WITH {_ORDER_F}, {logodds_sql("done", ["o_totalprice", "m"], ["o_orderpriority"], True)}
        SELECT variable, bin, {sql_round("x", 4)} AS x, n, {sql_round("event_rate", 6)} AS event_rate,
               {sql_round("log_odds", 6)} AS log_odds FROM curve""",
)
def _(spark, sf_dir):
    curve = screening.logodds_curve(
        _order_features(spark, sf_dir), ["o_totalprice", "m", "o_orderpriority"], "done", clip=True
    )
    return rounded(curve.withColumn("x", F.round("x", 4)))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    "corr_pairs",
    " UNION ALL ".join(
        f"""SELECT '{b}' AS feature, '{a}' AS earlier, {sql_round(f"abs(corr({a}, {b}))", 6)} AS abs_r,
            abs(corr({a}, {b})) > 0.5 AS above FROM lineitem"""
        for j, b in enumerate(_CORR)
        for a in _CORR[:j]
    ),
)
def _(spark, sf_dir):
    return rounded(selection.correlated_pairs(table(spark, sf_dir, "lineitem"), _CORR, 0.5))


@query(
    "corr_drop",
    """WITH p AS (SELECT l_quantity AS a, l_quantity * l_extendedprice AS b, l_discount AS c,
                         l_discount * 2 + l_tax AS d FROM lineitem)
       SELECT feature FROM (
         SELECT 'b' AS feature, abs(corr(a, b)) > 0.5 AS hit FROM p
         UNION ALL SELECT 'c', abs(corr(a, c)) > 0.5 OR abs(corr(b, c)) > 0.5 FROM p
         UNION ALL SELECT 'd', abs(corr(a, d)) > 0.5 OR abs(corr(b, d)) > 0.5 OR abs(corr(c, d)) > 0.5 FROM p) q
       WHERE hit""",
)
def _(spark, sf_dir):
    c = F.col
    df = table(spark, sf_dir, "lineitem").select(
        c("l_quantity").alias("a"),
        (c("l_quantity") * c("l_extendedprice")).alias("b"),
        c("l_discount").alias("c"),
        (c("l_discount") * 2 + c("l_tax")).alias("d"),
    )
    dropped = selection.correlated_features(df, ["a", "b", "c", "d"], 0.5)
    return spark.createDataFrame([(n,) for n in dropped], "feature string")


_VAR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "low_variance",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {sql_round(f'var_samp({c})', 4)} AS variance, var_samp({c}) < 0.1 AS low FROM lineitem"
        for c in _VAR
    ),
)
def _(spark, sf_dir):
    return rounded(selection.low_variance(table(spark, sf_dir, "lineitem"), _VAR), 4)


_EB = """SELECT {c} AS k, w * own + (1 - w) * m AS v FROM (
  SELECT {c}, own, m, CASE WHEN var * n + spread / n > 0 THEN var * n / (var * n + spread / n) END AS w FROM (
    SELECT {c}, count(*) AS n, avg(quality) AS own, sum(quality * quality) - sum(quality)::DOUBLE * sum(quality) / count(*) AS spread,
      (SELECT avg(quality) FROM f) AS m, (SELECT var_pop(quality) FROM f) AS var FROM f GROUP BY {c}) a) b"""


@query(
    "screen_features",
    f"""WITH f AS ({LABELLED_SQL}), el AS ({_EB.format(c="lang")}), es AS ({_EB.format(c="source")}),
        x AS (SELECT doc_id, quality, n_chars::DOUBLE AS n_chars, score, toxic::DOUBLE AS toxic, el.v AS lang, es.v AS source
              FROM f JOIN el ON el.k = f.lang JOIN es ON es.k = f.source)
        SELECT feature FROM (
          SELECT 'toxic' AS feature, var_samp(toxic) < 0.03 OR abs(corr(n_chars, toxic)) > 0.6 OR abs(corr(score, toxic)) > 0.6 AS gone FROM x
          UNION ALL SELECT 'n_chars', var_samp(n_chars) < 0.03 FROM x
          UNION ALL SELECT 'score', var_samp(score) < 0.03 OR abs(corr(n_chars, score)) > 0.6 FROM x
          UNION ALL SELECT 'lang', var_samp(lang) < 0.03 FROM x
          UNION ALL SELECT 'source', var_samp(source) < 0.03 FROM x) q WHERE gone""",
)
def _(spark, sf_dir):
    """Names dropped by the impute - encode - variance - correlation chain."""
    found = selection.screen_features(
        labelled(spark, sf_dir), "quality", threshold=0.6, min_variance=0.03, keep=["doc_id"]
    )
    return spark.createDataFrame([(n,) for n in found.dropped], "feature string")
