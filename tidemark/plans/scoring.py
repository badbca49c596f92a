"""Train-to-score hand-off and the batch scoring job."""

from __future__ import annotations

from datetime import date

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.evaluate import binary_metrics
from tidemark.plans.modeling import (
    Preprocessor,
    assemble,
    fit_boosting,
    fit_preprocessor,
    forest_importance,
    probability,
    temporal_split,
    transform_training,
)
from tidemark.sources.tables import (
    append_scores,
    claim_version,
    latest_version,
    latest_vintage,
    log_metrics,
    register_version,
)
from tidemark.session import materialize


def train_and_register(
    abt: DataFrame,
    root: str,
    key: list[str],
    target: str,
    train: tuple[date, date],
    test: tuple[date, date],
    params: dict | None = None,
    importance_params: dict | None = None,
) -> tuple[int, DataFrame]:
    """Fit on the train period, measure on both, save everything under a new version.

    Returns the version and the metric table (one row per split).
    """
    spark = abt.sparkSession
    parts = temporal_split(abt, train, test)
    rows, held = (parts.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    # Read by the encoders, the forest, the booster and the metrics.
    rows, held = materialize(rows), materialize(held)
    prep = fit_preprocessor(rows, target, key)
    ready = materialize(transform_training(prep, rows, target, key))
    chosen = forest_importance(ready, prep.names(), target, **(importance_params or {})).where("Selected").collect()
    selected = [r["Feature"] for r in chosen]
    model = fit_boosting(ready, selected, target, params)
    version = claim_version(spark, f"{root}/models")
    path = f"{root}/model_v{version}"
    prep.save(spark, f"{path}/prep")
    spark.createDataFrame(list(enumerate(selected)), "position int, feature string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/selected")
    model.write().overwrite().save(f"{path}/classifier")
    both = prep.transform(rows, [*key, target]).withColumn("split", F.lit("train")).unionByName(
        prep.transform(held, [*key, target]).withColumn("split", F.lit("test"))
    )
    scored = probability(assemble(both, selected).select(target, "split", "features"), model)
    # The metrics read the scores several times, and each row is scored once.
    scored = materialize(scored.select(target, "split", "SCORE"))
    metrics = binary_metrics(scored, "SCORE", target, ["split"])
    log_metrics(metrics, f"{root}/metrics", run_id=f"v{version}")
    register_version(spark, f"{root}/models", version, path)
    return version, metrics


def load_scorer(spark: SparkSession, root: str, version: int | None = None):
    """(preprocessor, selected features, classifier) of a version, the newest by default."""
    version = version or latest_version(spark, f"{root}/models")
    if version is None:
        raise ValueError(f"no model registered under {root}")
    path = f"{root}/model_v{version}"
    chosen = spark.read.parquet(f"{path}/selected").orderBy("position").collect()
    return (
        Preprocessor.load(spark, f"{path}/prep"),
        [r["feature"] for r in chosen],
        GBTClassificationModel.load(f"{path}/classifier"),
    )


def score_latest(
    abt: DataFrame,
    scorer,
    key: list[str],
    scored_on: date | None = None,
) -> DataFrame:
    """(key..., SCORE, DATA_SCORE) of the newest vintage, highest score first."""
    return latest_scores(abt, scorer, key, scored_on).orderBy(F.col("SCORE").desc(), *key)


def latest_scores(abt: DataFrame, scorer, key: list[str], scored_on: date | None = None) -> DataFrame:
    """(key..., SCORE, DATA_SCORE) of the newest vintage, in no order."""
    prep, selected, model = scorer
    rows = prep.transform(latest_vintage(abt), key)
    day = F.lit(scored_on) if scored_on else F.current_date()
    scored = probability(assemble(rows, selected), model)
    return scored.select(*key, "SCORE", day.alias("DATA_SCORE"))


def score_job(
    abt: DataFrame, root: str, key: list[str], scored_on: date | None = None, run: str | None = None
) -> DataFrame:
    """Score the newest vintage with the newest model and append to the score table.

    Under a ``run`` name the job may be repeated without adding rows.
    """
    spark = abt.sparkSession
    scores = latest_scores(abt, load_scorer(spark, root), key, scored_on)
    append_scores(scores, f"{root}/tb_scoring", run=run)
    return spark.read.parquet(f"{root}/tb_scoring")
