"""Score evaluation queries: target ``quality``, score a growing function of document length."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import LABELLED_SQL, bin_sql, labelled, quantile_edges_sql, rounded, width_edges_sql
from queries.registry import query, sql_round
from tidemark.operators import evaluate
from tidemark.sources.fixtures import table

_F = f"f AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'test' ELSE 'train' END AS split FROM ({LABELLED_SQL}) q)"


def _scored(spark, sf_dir):
    split = F.when(F.pmod("doc_id", F.lit(3)) == 0, "test").otherwise("train")
    return labelled(spark, sf_dir).withColumn("split", split)


def curve_sql(source: str, score: str, target: str, by: str = "0") -> str:
    """CTE ``curve``: one row per (g, score) with counts, running totals and totals."""
    return f"""curve AS (
      SELECT g, s, n1, n0, sum(n1) OVER w AS c1, sum(n0) OVER w AS c0,
             sum(n1) OVER (PARTITION BY g) AS t1, sum(n0) OVER (PARTITION BY g) AS t0
      FROM (SELECT {by} AS g, CAST({score} AS DOUBLE) AS s, sum({target}) AS n1, sum(1 - {target}) AS n0
            FROM {source} WHERE {score} IS NOT NULL AND {target} IS NOT NULL GROUP BY 1, 2) d
      WINDOW w AS (PARTITION BY g ORDER BY s DESC ROWS UNBOUNDED PRECEDING))"""


_METRIC_COLS = {
    "rows": "CAST(sum(n1 + n0) AS BIGINT)",
    "event_rate": "sum(n1) / sum(n1 + n0)",
    "accuracy": "sum(CASE WHEN s > 0.5 THEN n1 ELSE n0 END) / sum(n1 + n0)",
    "precision": "coalesce(sum(n1) FILTER (WHERE s > 0.5) / nullif(sum(n1 + n0) FILTER (WHERE s > 0.5), 0), 0)",
    "recall": "coalesce(sum(n1) FILTER (WHERE s > 0.5) / nullif(sum(n1), 0), 0)",
    "f1": "coalesce(2 * sum(n1) FILTER (WHERE s > 0.5) / (sum(n1) + sum(n1 + n0) FILTER (WHERE s > 0.5)), 0)",
    "auc": "sum(n1 * (t0 - c0 + n0 / 2) / nullif(t1 * t0, 0))",
    "gini": "2 * sum(n1 * (t0 - c0 + n0 / 2) / nullif(t1 * t0, 0)) - 1",
    "ks": "max(abs(c1 / nullif(t1, 0) - c0 / nullif(t0, 0)))",
    "ks_signed": "max(CASE WHEN t1 > 0 AND t0 > 0 THEN greatest(c1 / t1 - c0 / t0, 0) END)",
    "avg_precision": "sum(n1 / t1 * c1 / (c1 + c0))",
    "brier": "sum(n1 * (1 - s) * (1 - s) + n0 * s * s) / sum(n1 + n0)",
    "log_loss": "sum(-n1 * ln(s) - n0 * ln(1 - s)) / sum(n1 + n0)",
}


def metric(name: str) -> str:
    return _METRIC_COLS[name] if name == "rows" else sql_round(_METRIC_COLS[name], 6)


_ALL = ", ".join(f"{metric(k)} AS {k}" for k in _METRIC_COLS)


@query("auc_gini_ks", f"""WITH {_F}, {curve_sql("f", "score", "quality", "split")} SELECT g AS split, {_ALL} FROM curve GROUP BY g""")
def _(spark, sf_dir):
    return rounded(evaluate.binary_metrics(_scored(spark, sf_dir), "score", "quality", ["split"]))


_LINE_F = (
    "f AS (SELECT l_extendedprice / 200000 AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS hit FROM lineitem)"
)


@query("auc_gini_ks_ranges", f"WITH {_LINE_F}, {curve_sql('f', 'score', 'hit')} SELECT {_ALL} FROM curve")
def _(spark, sf_dir):
    """Every item as a scored row, the order cut into many ranges."""
    df = table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 200000).alias("score"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("hit"),
    )
    return rounded(evaluate.binary_metrics(df, "score", "hit", range_rows=4000))


@query(
    "model_metrics",
    f"""WITH {_F}, {curve_sql("f", "score", "quality", "split")}
        SELECT 'length' AS "Algoritmo", g AS "Conjunto", {metric("accuracy")} AS "Acuracia", {metric("precision")} AS "Precisao",
          {metric("recall")} AS "Recall", {metric("auc")} AS "AUC_ROC", {metric("gini")} AS "GINI", {metric("ks")} AS "KS"
        FROM curve GROUP BY g""",
)
def _(spark, sf_dir):
    return rounded(evaluate.model_metrics(_scored(spark, sf_dir), "score", "quality", "split", "length"))


@query(
    "compare_models",
    f"""WITH {_F}, tall AS (SELECT quality, 'score' AS m, score AS v FROM f UNION ALL
                            SELECT quality, 'inverse', 1 - score FROM f UNION ALL
                            SELECT quality, 'toxicity', toxic * 0.9 + 0.05 FROM f),
        {curve_sql("tall", "v", "quality", "m")}
        SELECT g AS "Model", {metric("auc")} AS "AUC_ROC", {metric("accuracy")} AS "Accuracy", {metric("precision")} AS "Precision",
          {metric("recall")} AS "Recall", {metric("f1")} AS "F1_Score", {metric("gini")} AS "Gini", {metric("ks")} AS "KS"
        FROM curve GROUP BY g""",
)
def _(spark, sf_dir):
    df = _scored(spark, sf_dir)
    df = df.withColumn("inverse", 1 - F.col("score")).withColumn("toxicity", F.col("toxic") * 0.9 + 0.05)
    return rounded(evaluate.compare_models(df, ["score", "inverse", "toxicity"], "quality"))


@query(
    "avg_precision",
    f"WITH {_F}, {curve_sql('f', 'score', 'quality')} SELECT {metric('avg_precision')} AS avg_precision FROM curve",
)
def _(spark, sf_dir):
    return rounded(evaluate.binary_metrics(_scored(spark, sf_dir), "score", "quality").select("avg_precision"))


@query(
    "brier_logloss",
    f"""WITH {_F} SELECT {sql_round("avg((score - quality) * (score - quality))", 6)} AS brier,
        {sql_round("avg(CASE WHEN quality = 1 THEN -ln(score) ELSE -ln(1 - score) END)", 6)} AS log_loss FROM f""",
)
def _(spark, sf_dir):
    return rounded(evaluate.binary_metrics(_scored(spark, sf_dir), "score", "quality").select("brier", "log_loss"))


@query(
    "ks_percent",
    f"""WITH {_F}, {curve_sql("f", "score", "quality")}
        SELECT {sql_round("100 * (" + _METRIC_COLS["ks_signed"] + ")", 6)} AS "KS",
               {sql_round("100 * (" + _METRIC_COLS["gini"] + ")", 6)} AS "Gini" FROM curve""",
)
def _(spark, sf_dir):
    return rounded(evaluate.ks_percent(_scored(spark, sf_dir), "score", "quality"))


@query(
    "gini_norm",
    f"""WITH {_F},
        p AS (SELECT score, count(*) AS n, sum(quality)::DOUBLE AS v FROM f GROUP BY score),
        c AS (SELECT n, v, sum(v) OVER (ORDER BY score DESC) AS cv, sum(v) OVER () AS tv, sum(n) OVER () AS tn FROM p),
        g AS (SELECT (max(tn) + 1) / 2 - sum((n * (cv - v) + v * (n + 1) / 2) / tv) AS a FROM c),
        t AS (SELECT quality, row_number() OVER (ORDER BY quality DESC) AS i, count(*) OVER () AS tn,
                sum(quality) OVER (ORDER BY quality DESC ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(quality) OVER () AS l FROM f),
        h AS (SELECT sum(i / tn - l) AS a FROM t)
        SELECT {sql_round("g.a / h.a", 6)} AS gini_normalizado FROM g, h""",
)
def _(spark, sf_dir):
    return rounded(evaluate.normalized_gini(_scored(spark, sf_dir), "quality", "score"))


@query(
    "confusion",
    f"""WITH {_F} SELECT quality AS label, CAST(score > 0.5 AS INTEGER) AS prediction, count(*) AS n FROM f GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    df = _scored(spark, sf_dir).withColumn("pred", (F.col("score") > 0.5).cast("int"))
    return evaluate.confusion_matrix(df, "quality", "pred")


@query(
    "roc_points",
    f"""WITH {_F}, {curve_sql("f", "score", "quality")}
        SELECT {sql_round("s", 9)} AS threshold, {sql_round("c0 / t0", 6)} AS fpr, {sql_round("c1 / t1", 6)} AS tpr FROM curve
        UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0""",
)
def _(spark, sf_dir):
    points = evaluate.roc_points(_scored(spark, sf_dir), "score", "quality")
    finite = F.when(F.col("threshold") < float("inf"), F.round("threshold", 9)).otherwise(F.col("threshold"))
    return rounded(points, skip=("threshold",)).withColumn("threshold", finite)


@query(
    "pr_points",
    f"""WITH {_F}, {curve_sql("f", "score", "quality")}
        SELECT {sql_round("s", 9)} AS threshold, {sql_round("c1 / (c1 + c0)", 6)} AS precision, {sql_round("c1 / t1", 6)} AS recall FROM curve
        UNION ALL SELECT NULL, 1.0, 0.0""",
)
def _(spark, sf_dir):
    points = evaluate.precision_recall_points(_scored(spark, sf_dir), "score", "quality")
    return rounded(points, skip=("threshold",)).withColumn("threshold", F.round("threshold", 9))


@query(
    "calibration",
    f"""WITH {_F} SELECT CAST(greatest(ceil(score * 10) - 1, 0) AS INTEGER) AS bin, count(*) AS n,
          {sql_round("avg(score)", 6)} AS mean_predicted, {sql_round("avg(quality)", 6)} AS event_share FROM f GROUP BY 1""",
)
def _(spark, sf_dir):
    return rounded(evaluate.calibration_table(_scored(spark, sf_dir), "score", "quality"))


def _bands_sql(source: str, edges: str, score: str, target: str, scale: str = "1") -> str:
    """CTEs ending in ``bands``."""
    return f"""ed AS ({edges}),
      b AS (SELECT {bin_sql(score)} AS decile, {score} AS sc, {target} AS t FROM {source}, ed),
      bands AS (SELECT decile, min(sc * {scale}) AS min_score, max(sc * {scale}) AS max_score, avg(t) AS event_rate,
                  count(*) AS volume, CAST(sum(t) AS BIGINT) AS qt_bads,
                  sum(t) / sum(sum(t)) OVER () AS perc_total_bads FROM b GROUP BY decile)"""


_BAND_COLS = f"""decile, {sql_round("min_score", 6)} AS min_score, {sql_round("max_score", 6)} AS max_score,
  {sql_round("event_rate", 6)} AS event_rate, volume, qt_bads, {sql_round("perc_total_bads", 6)} AS perc_total_bads"""


@query(
    "decile_table",
    f"""WITH {_F}, inv AS (SELECT *, 1 - score AS p0 FROM f),
        {_bands_sql("inv", quantile_edges_sql("inv", "p0", 10), "p0", "quality", "1000.0")} SELECT {_BAND_COLS} FROM bands""",
)
def _(spark, sf_dir):
    return rounded(evaluate.decile_table(_scored(spark, sf_dir), "score", "quality", duplicates="drop"))


def _side(split: str) -> str:
    return f"""{split}_f AS (SELECT *, 1 - score AS p0 FROM f WHERE split = '{split}'),
      {split}_e AS ({quantile_edges_sql(f"{split}_f", "p0", 10)}),
      {split}_b AS (SELECT {bin_sql("p0")} AS decile, quality AS t FROM {split}_f, {split}_e),
      {split}_t AS (SELECT decile, avg(t) AS r, sum(t) / sum(sum(t)) OVER () AS p, count(*) AS v FROM {split}_b GROUP BY decile)"""


@query(
    "decile_train_test",
    f"""WITH {_F}, {_side("train")}, {_side("test")}
        SELECT decile, {sql_round("a.r", 6)} AS event_rate_train, {sql_round("a.p", 6)} AS perc_total_bads_train, a.v AS volume_train,
          {sql_round("b.r", 6)} AS event_rate_test, {sql_round("b.p", 6)} AS perc_total_bads_test, b.v AS volume_test
        FROM train_t a JOIN test_t b USING (decile)""",
)
def _(spark, sf_dir):
    df = _scored(spark, sf_dir)
    train, test = (df.where(F.col("split") == s) for s in ("train", "test"))
    return rounded(evaluate.decile_comparison(train, test, "score", "quality", duplicates="drop"))


_SPLIT_TABLE = f"""SELECT 'KS' AS "Metric", {sql_round("max(ks) FILTER (WHERE g = 'train')", 6)} AS "Train_Value", {sql_round("max(ks) FILTER (WHERE g = 'test')", 6)} AS "Test_Value" FROM m
  UNION ALL SELECT 'AUC', {sql_round("max(auc) FILTER (WHERE g = 'train')", 6)}, {sql_round("max(auc) FILTER (WHERE g = 'test')", 6)} FROM m
  UNION ALL SELECT 'Gini', {sql_round("max(2 * auc - 1) FILTER (WHERE g = 'train')", 6)}, {sql_round("max(2 * auc - 1) FILTER (WHERE g = 'test')", 6)} FROM m"""


def _train_test(spark, sf_dir):
    df = _scored(spark, sf_dir)
    return [df.where(F.col("split") == s) for s in ("train", "test")]


@query(
    "split_metrics",
    f"""WITH {_F}, {curve_sql("f", "score", "quality", "split")},
        m AS (SELECT g, {_METRIC_COLS["ks"]} AS ks, {_METRIC_COLS["auc"]} AS auc FROM curve GROUP BY g) {_SPLIT_TABLE}""",
)
def _(spark, sf_dir):
    return rounded(evaluate.split_metrics(*_train_test(spark, sf_dir), "score", "quality")[0])


_BAND_SHORT = f"""decile, {sql_round("min_score", 6)} AS min_score, {sql_round("max_score", 6)} AS max_score,
  {sql_round("event_rate", 6)} AS event_rate, volume"""


def _both_bands_sql(edges, score: str, prefix: str) -> str:
    """Bands of either split, each cut on its own values."""
    ctes, parts = [], []
    for split in ("train", "test"):
        source = f"{prefix}_{split}"
        ctes.append(f"{source} AS (SELECT *, 1 - score AS score_0 FROM f WHERE split = '{split}')")
        ctes.append(f"{source}_e AS ({edges(source)})")
        parts.append(f"""SELECT '{split}' AS split, {_BAND_SHORT} FROM (
          SELECT decile, min(sc) AS min_score, max(sc) AS max_score, avg(t) AS event_rate, count(*) AS volume
          FROM (SELECT {bin_sql(score)} AS decile, {score} AS sc, quality AS t FROM {source}, {source}_e) b GROUP BY decile) q""")
    return f"WITH {_F}, {', '.join(ctes)} " + " UNION ALL ".join(parts)


def _labelled_bands(tables):
    return rounded(
        tables[1].withColumn("split", F.lit("train")).unionByName(tables[2].withColumn("split", F.lit("test")))
    )


@query("width_bands", _both_bands_sql(lambda s: width_edges_sql(s, "score", 10), "score", "w"))
def _(spark, sf_dir):
    return _labelled_bands(evaluate.split_metrics(*_train_test(spark, sf_dir), "score", "quality"))


@query("quantile_bands", _both_bands_sql(lambda s: quantile_edges_sql(s, "score_0", 5), "score_0", "q"))
def _(spark, sf_dir):
    """Bands at the quantiles of a second score column."""
    train, test = (d.withColumn("score_0", 1 - F.col("score")) for d in _train_test(spark, sf_dir))
    return _labelled_bands(
        evaluate.split_metrics(
            train, test, "score", "quality", bins=5, binning="quantile", bin_on="score_0", duplicates="drop"
        )
    )


_ZERO = "SELECT CAST(o_orderkey % 5 AS DOUBLE) AS y, o_orderkey % 5 + CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS p, o_orderstatus AS g FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderkey % 5 <> 0 OR o_orderstatus = 'O'"


@query(
    "regression_zero_truth",
    f"""SELECT g AS "Conjunto", CASE WHEN bool_or(y = 0 AND p = 0) THEN CAST('nan' AS DOUBLE) WHEN bool_or(y = 0) THEN CAST('inf' AS DOUBLE)
          ELSE avg(abs((y - p) / y)) * 100 END AS "MAPE" FROM ({_ZERO}) f GROUP BY g""",
)
def _(spark, sf_dir):
    """Truths of zero, predicted right and wrong."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("_orders_zero")
    df = spark.sql(_ZERO.replace("FROM orders", "FROM _orders_zero"))
    return evaluate.regression_metrics(df, "y", "p", "g", "shifted").select("Conjunto", "MAPE")


@query("event_rate_by_band")
def _(spark, sf_dir):
    """Ties are spread by a hash that has no counterpart in other engines."""
    return evaluate.event_rate_by_band(_scored(spark, sf_dir), "score", "quality", ["doc_id"])


@query(
    "target_balance",
    f"""WITH {_F} SELECT {sql_round("avg(quality)", 6)} AS event_rate, {sql_round("1 - avg(quality)", 6)} AS non_event_rate FROM f""",
)
def _(spark, sf_dir):
    return rounded(evaluate.target_balance(_scored(spark, sf_dir), "quality"))


@query(
    "regression_metrics",
    f"""WITH f AS (SELECT l_extendedprice AS y, l_quantity * 2000 AS p, CASE WHEN l_linestatus = 'F' THEN 'train' ELSE 'test' END AS g FROM lineitem)
        SELECT g AS "Conjunto", 'linear' AS "Algoritmo",
          {sql_round("1 - avg((y - p) * (y - p)) / var_pop(y)", 6)} AS "R2", {sql_round("avg(abs(y - p))", 3)} AS "MAE",
          {sql_round("avg((y - p) * (y - p))", 0)} AS "MSE", {sql_round("sqrt(avg((y - p) * (y - p)))", 3)} AS "RMSE",
          {sql_round("avg(abs((y - p) / y)) * 100", 6)} AS "MAPE" FROM f GROUP BY g""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 2000).alias("p"),
        F.when(F.col("l_linestatus") == "F", "train").otherwise("test").alias("split"),
    )
    m = evaluate.regression_metrics(df, "y", "p", "split", "linear")
    m = m.withColumns({"MAE": F.round("MAE", 3), "MSE": F.round("MSE", 0), "RMSE": F.round("RMSE", 3)})
    return rounded(m)
