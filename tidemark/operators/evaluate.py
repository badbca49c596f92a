"""Score evaluation: every rank metric comes from one table of distinct scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalars import ratio
from tidemark.operators.binning import Bins, linspace, quantile_bins, width_bins
from tidemark.operators.ordered import running_totals


def rank_curve(
    df: DataFrame, score: str, target: str, by: list[str] | None = None, range_rows: int | None = None
) -> DataFrame:
    """One row per (by, distinct score), highest score first.

    ``n1``/``n0`` count events and non-events at the score, ``cum_*`` at or above it, ``tot_*``
    overall.  Equal scores are one row, so nothing below depends on the order of ties.
    """
    rows = df.where(F.col(target).isNotNull())
    y = F.col(target).cast("bigint")
    measures = {"n1": F.sum(y), "n0": F.sum(1 - y)}
    return running_totals(rows, score, measures, by, descending=True, range_rows=range_rows)


def _auc_term() -> Column:
    """Share of (event, non-event) pairs won by the events at this score."""
    lower = F.col("tot_n0") - F.col("cum_n0") + F.col("n0") / 2
    return (F.col("n1") / F.col("tot_n1")) * (lower / F.col("tot_n0"))


def _gap() -> Column:
    return F.col("cum_n1") / F.col("tot_n1") - F.col("cum_n0") / F.col("tot_n0")


def binary_metrics(
    df: DataFrame,
    score: str,
    target: str,
    by: list[str] | None = None,
    threshold: float = 0.5,
    range_rows: int | None = None,
) -> DataFrame:
    """One row per group: accuracy, precision, recall, f1, auc, gini, ks, ks_signed,
    avg_precision, brier, log_loss, event_rate and the number of rows.

    A row is predicted positive when its score exceeds the threshold.  Ratios without a
    denominator are zero for precision, recall and f1, and NULL otherwise.
    """
    by = by or []
    curve = rank_curve(df, score, target, by, range_rows)
    s, n1, n0 = F.col(score).cast("double"), F.col("n1"), F.col("n0")
    hit = s > threshold
    p = F.greatest(F.least(s, F.lit(1 - 2.0**-52)), F.lit(2.0**-52))
    precision_here = F.col("cum_n1") / (F.col("cum_n1") + F.col("cum_n0"))
    both = (F.col("tot_n1") > 0) & (F.col("tot_n0") > 0)
    sums = curve.groupBy(*by).agg(
        F.sum(n1 + n0).alias("rows"),
        F.sum(n1).alias("events"),
        F.coalesce(F.sum(F.when(hit, n1)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, n0)), F.lit(0)).alias("fp"),
        F.sum(F.when(both, _auc_term())).alias("auc"),
        F.max(F.when(both, F.abs(_gap()))).alias("ks"),
        F.max(F.when(both, F.greatest(_gap(), F.lit(0.0)))).alias("ks_signed"),
        F.sum(F.when(F.col("tot_n1") > 0, n1 / F.col("tot_n1") * precision_here)).alias("avg_precision"),
        F.sum(n1 * (1 - s) * (1 - s) + n0 * s * s).alias("sq"),
        F.sum(-n1 * F.ln(p) - n0 * F.ln(1 - p)).alias("ll"),
    )
    rows, tp, fp = F.col("rows"), F.col("tp"), F.col("fp")
    fn = F.col("events") - tp
    tn = rows - F.col("events") - fp
    zero = F.lit(0.0)
    return sums.select(
        *by,
        "rows",
        (F.col("events") / rows).alias("event_rate"),
        ((tp + tn) / rows).alias("accuracy"),
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        "auc",
        (2 * F.col("auc") - 1).alias("gini"),
        "ks",
        "ks_signed",
        "avg_precision",
        (F.col("sq") / rows).alias("brier"),
        (F.col("ll") / rows).alias("log_loss"),
    )


def model_metrics(df: DataFrame, score: str, target: str, split: str, algorithm: str) -> DataFrame:
    """(Algoritmo, Conjunto, Acuracia, Precisao, Recall, AUC_ROC, GINI, KS), one row per split."""
    c = F.col
    return binary_metrics(df, score, target, [split]).select(
        F.lit(algorithm).alias("Algoritmo"),
        c(split).alias("Conjunto"),
        c("accuracy").alias("Acuracia"),
        c("precision").alias("Precisao"),
        c("recall").alias("Recall"),
        c("auc").alias("AUC_ROC"),
        c("gini").alias("GINI"),
        c("ks").alias("KS"),
    )


def compare_models(scored: DataFrame, scores: list[str], target: str) -> DataFrame:
    """Metric row per score column, best AUC first."""
    cells = [F.struct(F.lit(s).alias("Model"), F.col(s).cast("double").alias("score")) for s in scores]
    tall = scored.select(F.col(target), F.explode(F.array(*cells)).alias("m")).select(target, "m.*")
    c = F.col
    return (
        binary_metrics(tall, "score", target, ["Model"])
        .select(
            "Model",
            c("auc").alias("AUC_ROC"),
            c("accuracy").alias("Accuracy"),
            c("precision").alias("Precision"),
            c("recall").alias("Recall"),
            c("f1").alias("F1_Score"),
            c("gini").alias("Gini"),
            c("ks").alias("KS"),
        )
        .orderBy(c("AUC_ROC").desc(), "Model")
    )


def ks_percent(df: DataFrame, score: str, target: str, by: list[str] | None = None) -> DataFrame:
    """(by, KS, Gini) in percent, KS being the largest signed gap of the ROC curve."""
    c = F.col
    return binary_metrics(df, score, target, by).select(
        *(by or []), (100 * c("ks_signed")).alias("KS"), (100 * c("gini")).alias("Gini")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def roc_points(df: DataFrame, score: str, target: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the start of the curve at infinity."""
    c = F.col
    curve = rank_curve(df, score, target).select(
        c(score).cast("double").alias("threshold"),
        (c("cum_n0") / c("tot_n0")).alias("fpr"),
        (c("cum_n1") / c("tot_n1")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(start)


def precision_recall_points(df: DataFrame, score: str, target: str) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the end point (NULL, 1, 0)."""
    c = F.col
    curve = rank_curve(df, score, target).select(
        c(score).cast("double").alias("threshold"),
        (c("cum_n1") / (c("cum_n1") + c("cum_n0"))).alias("precision"),
        (c("cum_n1") / c("tot_n1")).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(end)


def normalized_gini(df: DataFrame, truth: str, pred: str, range_rows: int | None = None) -> DataFrame:
    """Area between the diagonal and the Lorenz curve, prediction order over perfect order.

    Rows of equal prediction contribute their average over all orders of the tie, which needs
    no tiebreak column and does not change under row shuffling.
    """
    rows = df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull()).select(
        F.col(truth).cast("double").alias("truth"), F.col(pred).cast("double").alias("pred")
    )
    areas = [_lorenz_area(rows, k, range_rows).withColumn("order", F.lit(k)) for k in ("pred", "truth")]
    p, t = (F.max(F.when(F.col("order") == k, F.col("area"))) for k in ("pred", "truth"))
    return areas[0].unionByName(areas[1]).agg((p / F.nullif(t, F.lit(0.0))).alias("gini_normalizado"))


def _lorenz_area(rows: DataFrame, order: str, range_rows: int | None) -> DataFrame:
    """Sum over rows of (row share - truth share) along the descending order: one row."""
    measures = {"n": F.count(F.lit(1)), "v": F.sum("truth")}
    steps = running_totals(rows.withColumn("key", F.col(order)), "key", measures, range_rows=range_rows)
    c = F.col
    # n rows of a tie climb evenly from the total before it to the total after it.
    before = c("cum_v") - c("v")
    climbed = c("n") * before + c("v") * (c("n") + 1) / 2
    return steps.agg(
        ((F.max("tot_n") + 1) / 2 - F.sum(climbed / c("tot_v"))).alias("area")
    )


def calibration_table(df: DataFrame, prob: str, target: str, bins: int = 10) -> DataFrame:
    """(bin, n, mean_predicted, event_share) over equal bins of [0, 1]."""
    cut = Bins(tuple(linspace(0.0, 1.0, bins)))
    rows = df.where(F.col(prob).isNotNull() & F.col(target).isNotNull())
    return (
        rows.groupBy(cut.index(F.col(prob)).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col(prob).cast("double")).alias("mean_predicted"),
            F.avg(F.col(target).cast("double")).alias("event_share"),
        )
    )


def band_table(
    df: DataFrame,
    score: str,
    target: str,
    bins: int = 10,
    binning: str = "quantile",
    duplicates: str = "drop",
    scale: float = 1.0,
) -> DataFrame:
    """Score bands: decile, min_score, max_score, event_rate, volume, qt_bads, perc_total_bads."""
    rows = df.where(F.col(score).isNotNull())
    if binning == "quantile":
        cut = quantile_bins(rows, [score], bins, duplicates)[score]
    elif binning == "width":
        cut = width_bins(rows, [score], bins)[score]
    else:
        raise ValueError(f"unknown binning {binning!r}")
    c = F.col
    y = c(target).cast("bigint")
    bands = rows.groupBy(cut.index(c(score)).alias("decile")).agg(
        F.min(c(score) * F.lit(scale)).alias("min_score"),
        F.max(c(score) * F.lit(scale)).alias("max_score"),
        F.avg(y.cast("double")).alias("event_rate"),
        F.count(F.lit(1)).alias("volume"),
        F.count_if(y == 1).alias("qt_bads"),
    )
    # One row per band: the window sees at most ``bins`` rows.
    everything = Window.partitionBy(F.lit(1))
    return bands.withColumn("perc_total_bads", ratio(c("qt_bads"), F.sum("qt_bads").over(everything)))


def decile_table(
    df: DataFrame, prob_event: str, target: str, bins: int = 10, score_of: str = "non_event", duplicates: str = "raise"
) -> DataFrame:
    """Decile table on the probability of the non-event (decile 0 riskiest) or of the event,
    scores in thousandths."""
    if score_of not in ("non_event", "event"):
        raise ValueError(f"unknown score_of {score_of!r}")
    p = F.col(prob_event).cast("double")
    scored = df.withColumn("_score", 1 - p if score_of == "non_event" else p)
    return band_table(scored, "_score", target, bins, duplicates=duplicates, scale=1000.0)


def decile_comparison(
    train: DataFrame, test: DataFrame, prob_event: str, target: str, bins: int = 10, **kw
) -> DataFrame:
    """Train and test deciles side by side, each split cut at its own quantiles."""

    def side(df: DataFrame, name: str) -> DataFrame:
        t = decile_table(df, prob_event, target, bins, **kw)
        return t.select("decile", *[F.col(c).alias(f"{c}_{name}") for c in ("event_rate", "perc_total_bads", "volume")])

    return side(train, "train").join(side(test, "test"), "decile")


def split_metrics(
    train: DataFrame,
    test: DataFrame,
    score: str,
    target: str,
    bins: int = 10,
    binning: str = "width",
    bin_on: str | None = None,
    duplicates: str = "raise",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((Metric, Train_Value, Test_Value), train bands, test bands).

    Bands are cut on ``bin_on`` (the score itself by default), equal-width or at quantiles.
    """
    on = bin_on or score
    cols = list(dict.fromkeys([score, target]))
    both = train.select(*cols, F.lit("train").alias("split")).unionByName(
        test.select(*cols, F.lit("test").alias("split"))
    )
    wide = binary_metrics(both, score, target, ["split"]).select(
        "split", F.col("ks").alias("KS"), F.col("auc").alias("AUC"), F.col("gini").alias("Gini")
    )
    tall = wide.unpivot(["split"], ["KS", "AUC", "Gini"], "Metric", "value")
    table = tall.groupBy("Metric").agg(
        F.max(F.when(F.col("split") == "train", F.col("value"))).alias("Train_Value"),
        F.max(F.when(F.col("split") == "test", F.col("value"))).alias("Test_Value"),
    )
    bands = [
        band_table(d, on, target, bins, binning, duplicates).select(
            "decile", "min_score", "max_score", "event_rate", "volume"
        )
        for d in (train, test)
    ]
    return table, bands[0], bands[1]


def event_rate_by_band(df: DataFrame, score: str, target: str, key: list[str], bins: int = 10) -> DataFrame:
    """Event rate by score decile after spreading ties by up to 0.0001.

    The spread is a hash of the row key, so the table is the same on every run.
    """
    unit = F.pmod(F.xxhash64(*key), F.lit(1_000_000)) / F.lit(1_000_000.0)
    noisy = df.withColumn("_noisy", F.col(score).cast("double") + unit * F.lit(0.0001))
    return band_table(noisy, "_noisy", target, bins).select("decile", "event_rate", "volume")


def target_balance(df: DataFrame, target: str) -> DataFrame:
    """(event_rate, non_event_rate)."""
    rate = F.avg(F.col(target).cast("double"))
    return df.agg(rate.alias("event_rate"), (1 - rate).alias("non_event_rate"))


def regression_metrics(df: DataFrame, truth: str, pred: str, split: str, algorithm: str) -> DataFrame:
    """(Algoritmo, Conjunto, R2, MAE, MSE, RMSE, MAPE) per split in one aggregation.

    A wrong prediction of a zero makes MAPE infinite, a right one makes it NaN.
    """
    y, e = F.col(truth).cast("double"), F.col(truth).cast("double") - F.col(pred).cast("double")
    mse = F.avg(e * e)
    of_zero = F.when(e == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    return df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull()).groupBy(F.col(split).alias("Conjunto")).agg(
        F.lit(algorithm).alias("Algoritmo"),
        (1 - mse / F.nullif(F.var_pop(y), F.lit(0.0))).alias("R2"),
        F.avg(F.abs(e)).alias("MAE"),
        mse.alias("MSE"),
        F.sqrt(mse).alias("RMSE"),
        (F.avg(F.coalesce(F.abs(F.try_divide(e, y)), of_zero)) * 100).alias("MAPE"),
    )

