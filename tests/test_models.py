"""Training, scoring and loading jobs."""

from datetime import date
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from queries import models
from queries.registry import QUERIES
from tidemark.operators.encode import fit_robust
from tidemark.plans import modeling, scoring
from tidemark.session import shared_path
from tidemark.sources import loading, tables

TARGET, KEY = "flag_churn_3m", ["seller_id", "dt_ref"]
TRAIN, TEST = (date(2018, 1, 1), date(2018, 4, 1)), (date(2018, 5, 1), date(2018, 6, 1))


@pytest.fixture(scope="module")
def abt(spark):
    """A thousand rows whose flag depends on ``idle``; text columns of both cardinalities."""
    rng = np.random.default_rng(1)
    rows = []
    for m in range(1, 7):
        for s in range(170):
            idle = float(rng.integers(0, 100))
            y = int(rng.random() < 1 / (1 + np.exp(-(idle - 50) / 10)))
            sold = None if s % 17 == 0 else float(rng.normal())
            rows.append((f"s{s}", date(2018, m, 1), f"city{s % 40}", f"st{s % 4}", idle, sold, float(rng.normal()), y))
    schema = f"seller_id string, dt_ref date, city string, state string, idle double, sold double, noise double, {TARGET} int"
    return spark.createDataFrame(rows, schema).repartition(4).persist()


def test_split_bounds(abt):
    sizes = {r.split: r["count"] for r in modeling.temporal_split(abt, TRAIN, TEST).groupBy("split").count().collect()}
    assert sizes == {"train": 680, "test": 340}


def test_folds_are_balanced_in_each_class(abt):
    folded = modeling.stratified_folds(abt, TARGET, KEY, 5)
    assert folded.count() == abt.count()
    for cls in (0, 1):
        sizes = [r["count"] for r in folded.where(F.col(TARGET) == cls).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_logit_satisfies_its_score_equations(abt):
    features = ["idle", "noise"]
    model, table = modeling.logit_scorecard(abt, TARGET, features)
    p = model.transform(modeling.assemble(abt, features)).select(*features, TARGET, "prediction").toPandas()
    residual = p[TARGET] - p["prediction"]
    assert abs(residual.sum()) < 1e-4
    assert all(abs((residual * p[f]).sum()) < 1e-2 for f in features)
    rows = table.collect()
    assert rows[0].Feature == "idle" and rows[0].P_Value < 1e-6
    assert [r.Wald_Statistic for r in rows] == sorted((r.Wald_Statistic for r in rows), reverse=True)
    with pytest.raises(ValueError):
        modeling.logit_scorecard(abt, TARGET, ["absent"])


def test_selection_and_permutation_find_the_signal(abt):
    features = ["idle", "noise"]
    chosen = modeling.forest_importance(abt, features, TARGET, numTrees=10).collect()
    assert chosen[0].Feature == "idle" and chosen[0].Selected
    model = modeling.fit_boosting(abt, features, TARGET, {"maxIter": 3, "maxDepth": 3})
    ranked = modeling.permutation_importance(abt, model, features, TARGET, KEY, repeats=2).collect()
    assert [r.feature for r in ranked] == features
    assert ranked[0].importance > 0.1 > abs(ranked[1].importance)


def test_permutation_keeps_the_values(abt):
    ranks = modeling._hash_ranks(abt.select(*KEY, "idle"), KEY, 9)
    assert sorted(r._rank for r in ranks.select("_rank").collect()) == list(range(1, abt.count() + 1))


def test_search_stops_and_keeps_the_best(abt):
    space = {**modeling.SEARCH_SPACE, "maxIter": ("int", 2, 3), "maxDepth": ("int", 2, 3)}
    got = modeling.search_boosting(abt, ["idle", "noise"], TARGET, KEY, trials=4, patience=1, folds=3, space=space)
    aucs = [r.auc for r in got.trials.orderBy("trial").collect()]
    assert got.auc == max(aucs) > 0.8 and len(aucs) <= 4


def test_search_in_flight_gives_what_one_by_one_gives(abt):
    space = {**modeling.SEARCH_SPACE, "maxIter": ("int", 1, 2), "maxDepth": ("int", 1, 2)}
    how = dict(trials=6, patience=2, folds=2, space=space, refit=False)
    many = modeling.search_boosting(abt, ["idle", "noise"], TARGET, KEY, parallelism=12, **how)
    one = modeling.search_boosting(abt, ["idle", "noise"], TARGET, KEY, parallelism=1, **how)
    assert many.trials.collect() == one.trials.collect() and many.params == one.params
    aucs = [r.auc for r in one.trials.collect()]
    best = aucs.index(max(aucs))
    assert len(aucs) == min(6, best + 3)


def test_search_stops_as_the_reference_does():
    scores = {t: 0.5 + t / 100 for t in range(50)}
    assert modeling._best_trial({}, 10, 50) == (None, 11)
    assert modeling._best_trial(dict(list(scores.items())[:11]), 10, 50) == (10, 21)
    assert modeling._best_trial({0: 0.7, **{t: 0.6 for t in range(1, 30)}}, 10, 50) == (0, 11)
    assert modeling._best_trial({1: 0.7, 2: 0.6}, 10, 50) == (None, 11)


def test_search_resumes_from_a_study(spark, abt, monkeypatch):
    calls = []

    def valued(estimator, df, judge, folds, parallelism):
        calls.append(estimator.getMaxIter())
        if len(calls) == 4:
            raise RuntimeError("lost")
        return 0.5 + estimator.getStepSize() / 10

    monkeypatch.setattr(modeling, "_cross_validated", valued)
    study = shared_path(spark)
    how = dict(trials=9, patience=20, folds=2, parallelism=1, refit=False, study=study)
    with pytest.raises(RuntimeError):
        modeling.search_boosting(abt, ["idle", "noise"], TARGET, KEY, **how)
    kept = spark.read.parquet(study).count()
    assert 3 <= kept == len(calls) - 1 < 9
    calls.extend([0] * 10)
    before = len(calls)
    got = modeling.search_boosting(abt, ["idle", "noise"], TARGET, KEY, **how)
    rows = got.trials.orderBy("trial").collect()
    assert [r.trial for r in rows] == list(range(9)) and len(calls) - before == 9 - kept
    assert got.auc == max(r.auc for r in rows)
    # Another setting does not take over the trials.
    modeling.search_boosting(abt, ["idle"], TARGET, KEY, **how)
    assert len(calls) - before == 9 - kept + 9


def test_permutation_equals_scoring_every_row_anew(spark, abt):
    features = ["idle", "noise", "flat", "sold"]
    rows = abt.withColumn("flat", F.lit(3.0)).fillna(0.0, ["sold"])
    rows = rows.unionByName(rows.limit(5))  # keys that repeat
    model = modeling.fit_boosting(rows, features, TARGET, {"maxIter": 6, "maxDepth": 4})
    trees = modeling.boosted_trees(model)
    used = trees.used()
    got = {r.feature: r.importance for r in modeling.permutation_importance(rows, model, features, TARGET, KEY, repeats=3).collect()}
    assert got["flat"] == 0.0 and 2 not in used and set(got) == set(features)
    # Margins of the stored trees are those of the model.
    x = F.array(*[F.col(features[f]) for f in used]).alias("x")
    plain = rows.select("seller_id", "dt_ref", F.col(TARGET).cast("double").alias("target"), x)
    base = modeling.materialize(modeling._hash_ranks(plain, KEY, 42)).select("_rank", "target", "x")
    pairs = modeling.permutation_pairs(base, 3, 42).toPandas()
    assert sorted(pairs["_rank"]) == list(range(1, rows.count() + 1))

    def precision(x):
        wide = np.full((len(x), 4), 3.0)
        wide[:, used] = x
        frame = spark.createDataFrame(
            [(int(t), *map(float, v)) for t, v in zip(pairs["target"], wide)], f"{TARGET} int, " + ", ".join(f"{f} double" for f in features)
        )
        scored = modeling.probability(modeling.assemble(frame, features), model, "_s").select(TARGET, "_s").toPandas()
        total, value = scored[TARGET].sum(), 0.0
        above = hits = 0
        for _, tied in sorted(scored.groupby("_s"), reverse=True):
            above, hits = above + len(tied), hits + tied[TARGET].sum()
            value += tied[TARGET].sum() / total * hits / above
        return value

    x = np.stack(pairs["x"])
    others = np.stack(pairs["others"]).reshape(len(x), 3, len(used))
    start = precision(x)
    for i, f in enumerate(used):
        losses = []
        for r in range(3):
            changed = x.copy()
            changed[:, i] = others[:, r, i]
            assert sorted(changed[:, i]) == sorted(x[:, i])
            losses.append(start - precision(changed))
        assert got[features[f]] == pytest.approx(np.mean(losses), abs=1e-9)


def test_permutation_of_other_models_agrees(abt, monkeypatch):
    """The general way, on boosted trees too, gives what the stored margins give."""
    features = ["idle", "noise"]
    model = modeling.fit_boosting(abt, features, TARGET, {"maxIter": 3, "maxDepth": 3})
    fast = {r.feature: r.importance for r in modeling.permutation_importance(abt, model, features, TARGET, KEY, repeats=2).collect()}
    monkeypatch.setattr(modeling, "boosted_trees", lambda model: None)
    slow = {r.feature: r.importance for r in modeling.permutation_importance(abt, model, features, TARGET, KEY, repeats=2).collect()}
    assert fast["idle"] == pytest.approx(slow["idle"], abs=1e-9)
    forest = modeling.candidates(TARGET)["DecisionTreeClassifier"].fit(modeling.assemble(abt, features))
    assert modeling.permutation_importance(abt, forest, features, TARGET, KEY, repeats=1).first().feature == "idle"


def test_registered_search_does_not_watch_the_clock(spark, abt, monkeypatch):
    """With a clock that leaps an hour at each look, all trials up to the patience still run."""
    aucs = iter([0.6, 0.7] + [0.5] * 60)
    looks = iter(range(0, 10**9, 3600))
    monkeypatch.setattr(models, "_train", lambda spark, sf_dir: (abt, ["idle", "noise"]))
    monkeypatch.setattr(modeling, "_cross_validated", lambda *a: next(aucs))
    monkeypatch.setattr(modeling, "time", SimpleNamespace(monotonic=lambda: float(next(looks))))
    monkeypatch.setattr(models, "TARGET", TARGET)
    monkeypatch.setattr(models, "KEY", KEY)
    # The final model counts for nothing here.
    monkeypatch.setattr(modeling, "draw_params", lambda rng, space=None: {"maxIter": 1, "maxDepth": 1})
    assert QUERIES["gbt_search"](spark, "").count() == 2 + 10


def test_train_register_score(spark, abt):
    root = shared_path(spark)
    with pytest.raises(ValueError):
        scoring.load_scorer(spark, root)
    quick = {"maxIter": 3, "maxDepth": 3}
    for want in (1, 2):
        version, metrics = scoring.train_and_register(abt, root, KEY, TARGET, TRAIN, TEST, quick, {"numTrees": 10})
        assert version == want == tables.latest_version(spark, f"{root}/models")
    got = {r.split: r.auc for r in metrics.collect()}
    assert got["train"] > 0.8 and got["test"] > 0.75
    logged = spark.read.parquet(f"{root}/metrics")
    assert logged.where("run_id = 'v2' AND metric = 'auc' AND split = 'test'").count() == 1
    first = scoring.score_job(abt, root, KEY, date(2018, 7, 1))
    assert first.count() == 170 and {r.dt_ref for r in first.collect()} == {date(2018, 6, 1)}
    assert first.where("SCORE BETWEEN 0 AND 1").count() == 170
    assert scoring.score_job(abt, root, KEY, date(2018, 7, 1)).count() == 340
    # A later vintage with fewer categories is treated by the lists of the fit.
    small = abt.where("city IN ('city1', 'city2')").withColumn("state", F.lit("new"))
    assert scoring.score_latest(small, scoring.load_scorer(spark, root), KEY).count() > 0


def test_versions_are_given_out_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    registry = shared_path(spark)
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: tables.claim_version(spark, registry), range(8)))
    assert sorted(got) == list(range(1, 9))
    tables.register_version(spark, registry, 8, "m")
    assert tables.claim_version(spark, registry) == 9 and spark.read.parquet(registry).count() == 1


def test_scoring_run_may_be_repeated(spark):
    path = shared_path(spark)
    scores = spark.createDataFrame([("a", date(2018, 6, 1), 0.5), ("b", date(2018, 6, 1), 0.25)], "k string, dt_ref date, SCORE double")
    for _ in range(2):
        tables.append_scores(scores, path, run="july")
    assert spark.read.parquet(path).count() == 2
    tables.append_scores(scores, path, run="august")
    tables.append_scores(scores, path)
    assert spark.read.parquet(path).count() == 6


def test_raw_files_load_first_of_each_key(spark, tmp_path):
    text = (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines, ""quoted""",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
        "r2,o2,1,,,2018-01-01 00:00:00,\n"
        "r1,o3,2,,,2018-01-01 00:00:00,\n"
    )
    raw = tmp_path / "reviews.csv"
    raw.write_text(text, encoding="utf-8")
    landed = loading.load_all(spark, {"tb_reviews": str(raw)}, str(tmp_path / "db"))
    rows = {r.review_id: r for r in landed["tb_reviews"].collect()}
    assert set(rows) == {"r1", "r2"} and rows["r1"].order_id == "o1" and rows["r1"].review_score == 5
    assert rows["r1"].review_comment_message == 'two\nlines, "quoted"'
    counts = loading.table_counts(landed).collect()
    assert [(r.table_name, r.rows) for r in counts] == [("tb_reviews", 2)]
    with pytest.raises(ValueError):
        loading.conform(landed["tb_reviews"].drop("order_id"), "tb_reviews")


def test_packed_precision_equals_metrics_of_all_scores(spark, abt, monkeypatch):
    """F2, F6: ranges of few rows and short packs give what a metric over every scored row gives; none is stored."""
    features = ["idle", "noise", "sold"]
    rows = abt.fillna(0.0, ["sold"])
    model = modeling.fit_boosting(rows, features, TARGET, {"maxIter": 8, "maxDepth": 5})
    trees = modeling.boosted_trees(model)
    x = F.array(*features).alias("x")
    base = modeling.materialize(
        modeling._hash_ranks(rows.select(*KEY, F.col(TARGET).cast("double").alias("target"), x), KEY, 42).select("_rank", "target", "x")
    )
    scored = modeling.permuted_scores(modeling.permutation_pairs(modeling.with_margins(base, trees), 3), trees, 3)
    want = {
        (r.repeat, r.feature): r.avg_precision
        for r in modeling.binary_metrics(scored, "score", "target", ["repeat", "feature"]).collect()
    }
    for name, rows_each in (("_WALKED", 100), ("_PACKED", 250), ("_RANGE_ROWS", 150)):
        monkeypatch.setattr(f"tidemark.plans.trees.{name}", rows_each)
    got = modeling.permuted_precision(modeling.permutation_pairs(base, 3), base, trees, 3).collect()
    assert len(want) == len(got) == 1 + 3 * 3
    assert all(r.avg_precision == pytest.approx(want[r.repeat, r.feature], abs=1e-12) for r in got)
    # The default metric takes this way.
    monkeypatch.setattr(modeling, "permuted_scores", None)
    assert modeling.permutation_importance(rows, model, features, TARGET, KEY, repeats=1).count() == 3


def test_search_of_few_rows_starts_few_tasks(abt, monkeypatch):
    """a fit reads its rows in as many partitions as their size asks for, however many files hold them."""
    seen = []
    stored = modeling.materialize
    monkeypatch.setattr(modeling, "materialize", lambda df: stored(df.repartition(6)))
    monkeypatch.setattr(modeling, "_cross_validated", lambda gbt, df, *a: seen.append((df.rdd.getNumPartitions(), df.count())) or 0.5)
    how = dict(trials=1, folds=2, refit=False)
    modeling.search_boosting(abt, ["idle", "noise"], TARGET, KEY, **how)
    monkeypatch.setattr(modeling, "_TASK_VALUES", abt.count() // 2)
    modeling.search_boosting(abt, ["idle", "noise"], TARGET, KEY, **how)
    assert seen == [(1, abt.count()), (4, abt.count())]


@pytest.mark.parametrize("fit", ["boosting", "candidates"])
def test_fits_read_equal_shares(abt, monkeypatch, fit):
    """however unequal the stored parts are, a fit reads all rows in equal shares, some for each core."""
    seen = []

    class Estimator:
        def __init__(self, **params):
            pass

        def fit(self, df):
            seen.append(df.groupBy(F.spark_partition_id()).count().collect())
            raise InterruptedError

    monkeypatch.setattr(modeling, "GBTClassifier", Estimator)
    monkeypatch.setattr(modeling, "_TASK_VALUES", 200)
    features = ["idle", "noise"]
    uneven = abt.repartitionByRange(3, F.least("idle", F.lit(10))).withColumn("split", F.lit("train"))
    with pytest.raises(InterruptedError):
        if fit == "boosting":
            modeling.fit_boosting(uneven, features, TARGET)
        else:
            modeling.compare_candidates(uneven, features, TARGET, models={"tree": Estimator()})
    (sizes,) = seen
    assert len(sizes) == 16 and sum(r["count"] for r in sizes) == abt.count()
    assert max(r["count"] for r in sizes) - min(r["count"] for r in sizes) <= 8


def test_preprocessor_counts_the_values_of_texts_only(abt, monkeypatch):
    """numbers are not counted value by value, and their fit is that of imputing and scaling in turn."""
    asked = []
    counted = modeling.feature_stats
    monkeypatch.setattr(modeling, "feature_stats", lambda df, columns: asked.extend(columns) or counted(df, columns))
    train = abt.withColumn("empty", F.lit(None).cast("double")).withColumn("blank", F.lit(None).cast("string"))
    train = train.withColumn("spoilt", F.when(F.col("idle") < 30, float("nan")).otherwise(F.col("idle")))
    prep = modeling.fit_preprocessor(train, TARGET, KEY)
    assert sorted(asked) == ["blank", "city", "state"]
    numbers = ["idle", "sold", "noise", "spoilt"]
    imputer = modeling.fit_imputer(train, "median", numbers, ["city", "state"])
    scaler = fit_robust(imputer.transform(train), numbers)
    assert prep.numbers == numbers and prep.imputer == imputer and prep.scaler == scaler
    assert prep.low == ["state"] and prep.high == ["city"]


def _reads_stored_scores(monkeypatch, module):
    """Record whether the rows that the metrics of a module read still hold a model or a vector."""
    plans = []
    metrics = module.binary_metrics

    def recorded(df, *a, **k):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return metrics(df, *a, **k)

    monkeypatch.setattr(module, "binary_metrics", recorded)
    return plans


def test_candidates_score_each_row_once(abt, monkeypatch):
    """the metrics read stored scores; their values are those of scoring anew."""
    plans = _reads_stored_scores(monkeypatch, modeling)
    rows = modeling.temporal_split(abt, TRAIN, TEST).select("idle", "noise", TARGET, "split")
    models = {"tree": modeling.DecisionTreeClassifier(labelCol=TARGET, featuresCol="features", maxDepth=3, seed=0)}
    got = {r.Conjunto: r for r in modeling.compare_candidates(rows, ["idle", "noise"], TARGET, models=models).collect()}
    assert len(plans) == 1 and "UDF" not in plans[0] and "features" not in plans[0]
    vectors = modeling.assemble(rows, ["idle", "noise"])
    tree = models["tree"].fit(vectors.where("split = 'train'"))
    want = modeling.binary_metrics(modeling.probability(vectors, tree, "s").select(TARGET, "split", "s"), "s", TARGET, ["split"])
    for r in want.collect():
        assert got[r.split].auc == pytest.approx(r.auc) and got[r.split].rows == r.rows


def test_training_job_scores_each_row_once(spark, abt, monkeypatch):
    """the metrics of the training job read stored scores."""
    plans = _reads_stored_scores(monkeypatch, scoring)
    quick = ({"maxIter": 2, "maxDepth": 2}, {"numTrees": 5})
    _, metrics = scoring.train_and_register(abt, shared_path(spark), KEY, TARGET, TRAIN, TEST, *quick)
    assert len(plans) == 1 and "UDF" not in plans[0] and "features" not in plans[0]
    assert {r.split: r.rows for r in metrics.collect()} == {"train": 680, "test": 340}
