"""Operators against brute force, pandas and stated properties on small inputs."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import (
    binning,
    describe,
    encode,
    evaluate,
    grouping,
    impute,
    ordered,
    profile,
    screening,
    selection,
    treebins,
)
from tidemark.operators.dedupe import keep_first, keep_last
from tidemark.operators.quantiles import exact_quantiles, filled_quantiles, group_quantiles
from tidemark.plans.modeling import assemble
from tidemark.session import shared_path


@pytest.fixture(scope="module")
def skewed(spark):
    """Values of which a third are equal, some missing, some NaN."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        x = 5.0 if i % 3 == 0 else rng.gauss(0, 50)
        if i % 50 == 1:
            x = None
        if i % 50 == 2:
            x = float("nan")
        rows.append((i, x, f"g{i % 2}", int(rng.random() < (0.6 if (x or 0) > 0 else 0.3))))
    return spark.createDataFrame(rows, "id int, x double, g string, y int").repartition(5).persist()


@pytest.fixture(scope="module")
def pdf(skewed):
    return skewed.toPandas()


PROBS = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.77, 0.999, 1.0]


@pytest.mark.parametrize("bound", [100_000, 100, 3])
def test_quantiles_match_numpy(skewed, pdf, bound):
    got = exact_quantiles(skewed, ["x"], PROBS, small_distinct=bound)["x"]
    assert np.allclose(got, np.nanquantile(pdf["x"].astype(float), PROBS), rtol=0, atol=1e-9)


def test_quantiles_by_group_and_of_nothing(skewed, pdf):
    got = group_quantiles(skewed, "x", "g", ["g0", "g1"], [0.5], small_distinct=50)
    for g in ("g0", "g1"):
        assert got[g][0] == pytest.approx(np.nanquantile(pdf[pdf.g == g]["x"].astype(float), 0.5))
    assert exact_quantiles(skewed.where("id < 0"), ["x"], [0.5]) == {"x": None}


@pytest.mark.parametrize("bound", [100_000, 100, 3])
def test_quantiles_of_filled_columns_match_filling(skewed, bound):
    """the quantiles that a second look at the filled rows would give, for any share of missing values."""
    columns = {
        "x": F.col("x"),
        "full": F.col("id") * 1.5,
        "half": F.expr("CASE WHEN id % 2 = 0 THEN id END"),
        "rare": F.expr("CASE WHEN id % 9 = 0 THEN -id END"),
        "high": F.expr("CASE WHEN id % 4 = 0 THEN x + 1000 END"),
        "one": F.expr("CASE WHEN id = 7 THEN 3 END"),
        "none": F.lit(None).cast("double"),
    }
    got = filled_quantiles(skewed, columns, 0.5, PROBS, small_distinct=bound)
    middles = exact_quantiles(skewed, columns, [0.5])
    assert got["none"] is None and middles["none"] is None
    for n in columns:
        if n != "none":
            assert got[n][0] == middles[n][0]
            x = columns[n].cast("double")
            filled = F.when(x.isNull() | F.isnan(x), middles[n][0]).otherwise(x)
            assert got[n][1] == exact_quantiles(skewed, {n: filled}, PROBS)[n]


@pytest.mark.parametrize("rows", [None, 50, 700])
def test_running_totals_match_a_plain_window(skewed, pdf, rows):
    got = ordered.running_totals(
        skewed.where("NOT isnan(x)"), "x", {"n": F.count(F.lit(1)), "s": F.sum("y")}, by=["g"], range_rows=rows
    ).toPandas()
    clean = pdf.dropna(subset=["x"])
    want = clean.groupby(["g", "x"]).agg(n=("y", "size"), s=("y", "sum")).reset_index()
    want = want.sort_values(["g", "x"], ascending=[True, False])
    want["cum_n"], want["cum_s"] = want.groupby("g")["n"].cumsum(), want.groupby("g")["s"].cumsum()
    got = got.sort_values(["g", "x"], ascending=[True, False])
    for c in ("x", "n", "s", "cum_n", "cum_s"):
        assert got[c].tolist() == want[c].tolist()
    assert set(got["tot_n"]) == set(clean.groupby("g").size())


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("kind", ["double", "long", "string"])
def test_running_totals_in_more_ranges_than_one_level_holds(spark, descending, kind):
    n = 5000
    df = spark.range(n).selectExpr("id", "id % 3 AS g").unionByName(spark.range(900).selectExpr("17L AS id", "0L AS g"))
    value = {"double": F.exp(F.col("id") / 300), "long": F.col("id") - 2500, "string": F.format_string("w%05d", "id")}[kind]
    df = df.withColumn("v", value)
    edges, ranges, distinct = ordered.range_edges(df, "v", 2)
    assert ranges > ordered.MAX_RANGES and len(edges) < ordered.MAX_RANGES <= distinct
    inner = ordered._inner_edges(df, "v", edges, ranges, distinct).collect()
    assert len(edges) + 1 + sum(len(r["inner"]) for r in inner) > ordered.MAX_RANGES * 1.2
    got = ordered.running_totals(df, "v", {"n": F.count(F.lit(1))}, ["g"], descending, range_rows=2)
    rows = df.toPandas().groupby(["g", "v"]).size().rename("n").reset_index()
    rows = rows.sort_values("v", ascending=not descending)
    rows["cum"] = rows.groupby("g")["n"].cumsum()
    want = {(r.g, r.v): (r.n, r.cum) for r in rows.itertuples()}
    assert {(r["g"], r["v"]): (r["n"], r["cum_n"]) for r in got.collect()} == want
    totals = {r["g"]: r["tot_n"] for r in got.collect()}
    assert totals == rows.groupby("g")["n"].sum().to_dict()


def test_running_totals_over_texts(spark):
    words = [f"w{i:04d}" for i in range(500)] + ["w0001"] * 200
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = ordered.running_totals(df, "w", {"one": F.max(F.lit(1))}, descending=False, range_rows=60).orderBy("w").collect()
    assert [r["cum_one"] for r in got] == list(range(1, 501))


@pytest.mark.parametrize("n", [0, 1, 24, 25, 29, 36, 37, 100])
@pytest.mark.parametrize("inclusive", [True, False])
def test_count_below(spark, n, inclusive):
    edges = [float(i) for i in range(n)]
    df = spark.createDataFrame([(v / 2,) for v in range(-3, 2 * n + 4)] + [(None,)], "v double")
    for r in df.select("v", scalars.count_below(F.col("v"), edges, inclusive).alias("k")).collect():
        want = None if r.v is None else sum((e <= r.v) if inclusive else (e < r.v) for e in edges)
        assert r.k == want


@pytest.mark.parametrize("q", [4, 10])
def test_bins_match_pandas(skewed, pdf, q):
    clean = pdf.set_index("id")["x"].astype(float)
    fitted = {
        "q": (binning.quantile_bins(skewed, ["x"], q)["x"], pd.qcut(clean, q, labels=False, duplicates="drop")),
        "w": (binning.width_bins(skewed, ["x"], q)["x"], pd.cut(clean, q, labels=False)),
    }
    for bins, want in fitted.values():
        got = {r.id: r.b for r in skewed.select("id", bins.index(F.col("x")).alias("b")).collect()}
        for i, w in want.items():
            assert got[i] == (None if math.isnan(w) else int(w))


def test_constant_columns(spark):
    df = spark.createDataFrame([(5.0, 1), (5.0, 0)], "x double, y int")
    assert binning.quantile_bins(df, ["x"])["x"].count == 0
    assert binning.width_bins(df, ["x"], 4)["x"].edges == pytest.approx((4.995, 4.9975, 5.0, 5.0025, 5.005))
    assert screening.iv_table(df, "y").collect()[0].IV == 0.0
    with pytest.raises(ValueError):
        binning.quantile_bins(df, ["x"], 4, duplicates="raise")


def test_keep_first_and_last(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 1, None), ("a", 3, "z")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert {(r.k, r.v) for r in keep_first(df, ["k"], ["o"]).collect()} == {("a", "y"), ("b", None)}
    assert {(r.k, r.v) for r in keep_last(df, ["k"], ["o"]).collect()} == {("a", "z"), ("b", None)}


def test_auc_equals_pair_count_and_ignores_monotone_maps(skewed, pdf):
    df = skewed.where("NOT isnan(x)")
    clean = pdf.dropna(subset=["x"])
    pos, neg = clean[clean.y == 1]["x"].to_numpy(), clean[clean.y == 0]["x"].to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    base = evaluate.binary_metrics(df, "x", "y").first()
    assert base.auc == pytest.approx(wins / (len(pos) * len(neg)))
    grid = np.unique(clean["x"])
    gap = [abs((pos >= t).mean() - (neg >= t).mean()) for t in grid]
    assert base.ks == pytest.approx(max(gap))
    mapped = evaluate.binary_metrics(
        df.repartition(3).withColumn("z", F.exp(F.col("x") / 100)), "z", "y", range_rows=100
    ).first()
    for k in ("auc", "ks", "ks_signed", "avg_precision", "gini"):
        assert mapped[k] == pytest.approx(base[k], abs=1e-12)


def test_metrics_of_one_class_are_null(spark):
    df = spark.createDataFrame([(0.2, 1), (0.7, 1)], "s double, y int")
    m = evaluate.binary_metrics(df, "s", "y").first()
    assert m.auc is None and m.ks is None and m.recall == 0.5 and m.precision == 1.0


def test_normalized_gini_matches_rows_without_ties(spark):
    rng = random.Random(3)
    rows = [(rng.random(), float(rng.randint(0, 4))) for _ in range(400)]
    df = spark.createDataFrame(rows, "p double, t double")
    arr = np.array(sorted(rows, reverse=True))

    def area(values):
        n = len(values)
        return np.sum(np.linspace(1 / n, 1, n) - np.cumsum(values) / np.sum(values))

    want = area(arr[:, 1]) / area(np.sort(arr[:, 1])[::-1])
    assert evaluate.normalized_gini(df, "t", "p", range_rows=30).first()[0] == pytest.approx(want)


def test_band_tables(skewed, pdf):
    df = skewed.where("NOT isnan(x)")
    bands = evaluate.band_table(df, "x", "y", 5)
    rows = bands.collect()
    assert sum(r.volume for r in rows) == pdf["x"].count()
    assert sum(r.perc_total_bads for r in rows) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        evaluate.band_table(df, "x", "y", 5, binning="other")


def test_tree_bins_of_counts_whose_product_passes_an_int(spark):
    df = spark.range(100_000).select(F.col("id").alias("x"), (F.col("id") >= 60_000).cast("int").alias("y"))
    got = sorted(treebins.tree_bins(df, 2, "y", "x").collect())
    assert [tuple(r) for r in got] == [(0, 0.0, 60_000, -math.inf, 59_999.0), (1, 1.0, 40_000, 60_000.0, math.inf)]


def test_tree_bins_match_brute_force(spark):
    rng = random.Random(11)
    data = [(float(x), int(rng.random() < (0.2 if x < 8 else 0.8 if x < 15 else 0.4))) for x in [rng.randint(0, 20) for _ in range(500)]]
    df = spark.createDataFrame(data, "x double, y int")

    def imp(part):
        n, e = len(part), sum(y for _, y in part)
        return e * (n - e) / n

    leaves = [sorted(data)]
    while len(leaves) < 4:
        best = None
        for k, part in enumerate(leaves):
            for cut in sorted({x for x, _ in part})[:-1]:
                left, right = [p for p in part if p[0] <= cut], [p for p in part if p[0] > cut]
                gain = imp(part) - imp(left) - imp(right)
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, k, left, right)
        leaves[best[1] : best[1] + 1] = [best[2], best[3]]
    want = [(len(p), sum(y for _, y in p) / len(p)) for p in leaves]
    for rows in (None, 40):
        got = treebins.tree_bins(df, 4, "y", "x", range_rows=rows)
        assert [(r.Volume, r.Taxa_de_Evento) for r in got.orderBy("Leaf").collect()] == want
        assert got.orderBy("Leaf").collect()[0].Lower_Bound == -math.inf
    coded = treebins.apply_tree_bins(df, got, "x").groupBy("TFT_x").count().collect()
    assert sum(r["count"] for r in coded) == 500


def test_iv_is_not_negative_and_matches_a_direct_count(skewed, pdf):
    assert all(r.iv >= 0 for r in screening.woe_table(skewed.drop("id"), "y").collect())
    table = screening.iv_table(skewed.drop("id"), "y").collect()
    got = {r.Variavel: r.IV for r in table}
    g = pdf.groupby("g")["y"].agg(["sum", "count"])
    dg, db = g["sum"] / g["sum"].sum(), (g["count"] - g["sum"]) / (g["count"] - g["sum"]).sum()
    assert got["g"] == pytest.approx(float(((dg - db) * np.log(dg / db)).sum()))


def test_logodds_of_perfect_line(spark):
    rows = []
    for b in range(10):
        p = 1 / (1 + math.exp(-(b - 4.5) / 2))
        ones = round(p * 2000)
        rows += [(float(b), 1)] * ones + [(float(b), 0)] * (2000 - ones)
    df = spark.createDataFrame(rows, "x double, y int")
    r = screening.logodds_r2(df, ["x"], "y").first()
    assert r.R2 > 0.999 and r.Feat_Eng == screening.KEEP_CONTINUOUS


def test_encoders(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), (None, 1), ("a", 0)], "c string, y int")
    hot = encode.fit_one_hot(df, ["c"])
    rows = hot.transform(df).collect()
    assert hot.names() == ["c_a", "c_b"] and all(r.c_a + r.c_b in (0, 1) for r in rows)
    with pytest.raises(ValueError):
        hot.transform(df.drop("c"))
    assert [r.c for r in encode.ordinal_encode(df, {"c": ["b", "a"]}).collect()] == [1, 0, None, 1]
    with pytest.raises(Exception, match="unknown category"):
        encode.ordinal_encode(df, {"c": ["a"]}).collect()


def test_saved_one_hot(spark, tmp_path):
    df = spark.createDataFrame([("a", "u", 1, 2.0), ("b", "v", 0, 3.0)], "c string, d string, y int, n double")
    path = str(tmp_path / "hot")
    first = encode.one_hot_and_save(df, "y", path)
    again = encode.apply_saved_one_hot(df.where("c = 'b'"), path, "y")
    assert first.columns == again.columns == ["y", "n", "c_a", "c_b", "d_u", "d_v"]
    with pytest.raises(ValueError):
        encode.apply_saved_one_hot(df.drop("d"), path)


def test_one_hot_of_1001_levels(spark, tmp_path):
    rows = [(f"l{i % 1001:04d}", None, i % 2) for i in range(1002)] + [(None, None, 0)]
    df = spark.createDataFrame(rows, "c string, empty string, y int")
    path = str(tmp_path / "hot")
    wide = encode.one_hot_and_save(df.drop("empty"), "y", path)
    assert wide.columns == ["y"] + [f"c_l{i:04d}" for i in range(1001)]
    assert encode.apply_saved_one_hot(df.limit(1), path, "y").columns == wide.columns
    levels = encode.level_table(df, ["c", "empty"])
    assert sorted(map(tuple, levels.collect())) == sorted(map(tuple, spark.read.parquet(path).collect()))
    other = spark.createDataFrame([("new", None, 1)], df.schema)
    got = encode.one_hot_vectors(df.unionByName(other), ["c", "empty"], levels).collect()
    assert all(r.c.size == 1001 and r.empty.size == 0 for r in got)
    assert sorted(int(i) for r in got for i in r.c.indices) == sorted([*range(1001), 0])
    assert sum(len(r.c.indices) == 0 for r in got) == 2


def test_target_encoding_blend(spark):
    rows = [("a", 1)] * 3 + [("a", 0)] + [("b", 0)] * 5 + [("c", 1)]
    df = spark.createDataFrame(rows, "c string, y int")
    table, mean = encode.fit_target_encoding(df, "c", "y")
    got = {r.category: r.encoding for r in table.collect()}
    ys = np.array([y for _, y in rows], float)
    for k in "abc":
        own = np.array([y for c, y in rows if c == k], float)
        n, ssd, var = len(own), ((own - own.mean()) ** 2).sum(), ys.var()
        lam = var * n / (var * n + ssd / n)
        assert got[k] == pytest.approx(lam * own.mean() + (1 - lam) * ys.mean())
    new = spark.createDataFrame([("zzz",)], "c string")
    assert encode.apply_target_encoding(new, "c", table, mean).first().c == pytest.approx(ys.mean())


def test_imputer_modes_and_sentinels(spark):
    rows = [(1, "b", -1.0, None), (2, "a", 3.0, None), (3, "a", None, None), (4, "b", 5.0, None)]
    df = spark.createDataFrame(rows, "id int, c string, x double, e string")
    fitted = impute.fit_imputer(df, numbers=["x"], sentinels=(-1.0,))
    assert fitted.texts == {"c": "a", "e": impute.NO_MODE} and fitted.numbers["x"] == 4.0
    out = fitted.transform(df).orderBy("id").collect()
    assert [r.x for r in out] == [4.0, 3.0, 4.0, 5.0] and out[0].e == impute.NO_MODE
    assert impute.imputer_table(df, fitted).count() == 3


def test_profile_counts_nan_as_missing(skewed, pdf):
    row = profile.metadata(skewed, ids=["id"], targets=["y"]).where("FEATURE = 'x'").first()
    assert row.QT_NULOS == int(pdf["x"].isna().sum()) and row.CARDINALIDADE == pdf["x"].nunique()
    assert profile.drop_columns(skewed, ["g", "none"]).columns == ["id", "x", "y"]


def test_narrow_types_are_strict(spark):
    df = spark.createDataFrame([(127, 126, 40000, 1.5, "t")], "a int, b int, c bigint, d double, e string")
    kinds = dict(profile.narrow_types(df)[0].dtypes)
    assert kinds == {"a": "smallint", "b": "tinyint", "c": "int", "d": "float", "e": "string"}


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    a = {r.id for r in profile.sample_rows(df, ["id"], 100).collect()}
    b = {r.id for r in profile.sample_rows(df.repartition(7), ["id"], 100).collect()}
    assert a == b and len(a) == 100


def test_grouping_keep_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    groups = grouping.regroup(df.where("v <> 'c'"), "v", {"a": "A"})
    null = {r.TFB_v for r in grouping.apply_grouping(df, groups, "v").collect()}
    keep = {r.TFB_v for r in grouping.apply_grouping(df, groups, "v", unmapped="keep").collect()}
    assert null == {"A", "b", None} and keep == {"A", "b", "c"}


def test_screening_drops_flat_and_repeated(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        a = rng.gauss(0, 3)
        rows.append((i, i % 2, a, 2 * a + 1, 0.001 * rng.random(), None if i % 5 else 1.0, f"k{i % 3}"))
    df = spark.createDataFrame(rows, "id int, y int, a double, b double, flat double, holes double, c string")
    got = selection.screen_features(df, "y", threshold=0.9, min_variance=0.01, keep=["id"])
    assert set(got.dropped) == {"b", "flat", "c"} and got.frame.columns == ["id", "y", "a"]
    assert got.frame.count() == 300


def test_correlation_uses_complete_pairs(spark):
    rng = random.Random(8)
    rows = [(x := rng.gauss(0, 1), x + rng.gauss(0, 1) if rng.random() < 0.5 else None, float("nan") if i % 3 else x * x, 4.0) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = np.array(selection.correlations(df, ["a", "b", "c", "d"]))
    want = df.toPandas().corr().to_numpy()
    assert np.allclose(got[:3, :3], want[:3, :3]) and np.isnan(got[3, :3]).all()


def test_boolean_without_values_is_filled(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "flag boolean, x double")
    filled = impute.fit_imputer(df, "mean", ["x"], ["flag"]).transform(df).collect()
    assert {r.flag for r in filled} == {impute.NO_MODE}


def test_levels_with_dots_can_be_assembled(spark):
    df = spark.createDataFrame([("St. Louis", 1), ("a`b", 0)], "city string, y int")
    encoder = encode.fit_one_hot(df, ["city"])
    got = assemble(encoder.transform(df), encoder.names()).collect()
    assert {tuple(r["features"].toArray()) for r in got} == {(1.0, 0.0), (0.0, 1.0)}


def test_constant_column_gets_equal_width_bins(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    got = {r["BIN_x"]["bin"] for r in binning.categorize_numeric(df, 4).collect()}
    assert None in got and len(got) == 2


def test_histogram_box_and_density(skewed, pdf):
    clean = pdf["x"].astype(float).dropna().to_numpy()
    counts, edges = np.histogram(clean, 30)
    got = {r.bin: r.n for r in describe.histogram(skewed, ["x"], 30).collect()}
    assert [got.get(i, 0) for i in range(30)] == counts.tolist()
    box = describe.box_stats(skewed, ["x"], small_distinct=40).first()
    q1, q3 = np.quantile(clean, [0.25, 0.75])
    assert (box.q1, box.q3) == pytest.approx((q1, q3))
    inside = clean[(clean >= q1 - 1.5 * (q3 - q1)) & (clean <= q3 + 1.5 * (q3 - q1))]
    assert (box.whisker_lo, box.whisker_hi, box.outliers) == (inside.min(), inside.max(), len(clean) - len(inside))
    d = describe.kernel_density(skewed, ["x"], grid=50).orderBy("point").toPandas()
    assert np.trapezoid(d["density"], d["x"]) == pytest.approx(1.0, abs=0.01)


def test_strict_least_and_rounding(spark):
    df = spark.createDataFrame([(None, 3), (2, 3)], "a int, b int")
    assert [r[0] for r in df.select(scalars.strict_least(F.col("a"), F.col("b"))).collect()] == [None, 2]
    r = spark.range(1).select(
        F.round(F.lit(0.125), 2), F.bround(F.lit(0.125), 2), scalars.ratio(F.lit(1), F.lit(0)), scalars.whole_ratio(F.lit(7), F.lit(2))
    ).first()
    assert tuple(r) == (0.13, 0.12, None, 3)


@pytest.mark.parametrize("tile, parts", [(1024, 7), (3, 2), (1024, 1)])
def test_correlations_in_one_pass_equal_pairwise_ones(spark, monkeypatch, tile, parts):
    from tidemark.operators import comoments

    monkeypatch.setattr(comoments, "TILE", tile)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3000, 3))
    values = np.column_stack(
        [base[:, 0], base[:, 0] + base[:, 1], 1e9 + base[:, 1], np.full(3000, 0.1), base[:, 2] * 1e-6, base @ [1.0, 2.0, 3.0], np.full(3000, np.nan)]
    )
    values[rng.random(values.shape) < 0.3] = np.nan
    # Varies only where the first column is missing.
    values[:, 4] = np.where(np.isnan(values[:, 0]), values[:, 4], 0.7)
    names = [f"c{i}" for i in range(values.shape[1])]
    rows = [[None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)] for r in values]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts)
    got = np.array(selection.correlations(df, names))
    want = pd.DataFrame(values, columns=names).corr().to_numpy().copy()
    np.fill_diagonal(want, 1.0)
    want[0, 4] = want[4, 0] = np.nan
    want[3] = want[:, 3] = np.where(np.arange(7) == 3, 1.0, np.nan)
    assert np.allclose(got, want, rtol=0, atol=1e-7, equal_nan=True)
    assert selection.correlations(df.limit(0), names[:2])[0][0] == 1.0


def test_correlations_scan_once(spark, monkeypatch):
    from tidemark.operators import comoments

    plans = []
    frame = type(spark.range(1))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (plans.append(self), collect(self))[1])
    df = spark.range(40).select(*[(F.col("id") * (i + 1) % 7).alias(f"c{i}") for i in range(60)])
    assert len(comoments.correlation_matrix(df, [F.col(c) for c in df.columns])) == 60
    assert len(plans) == 1


def test_box_stats_of_many_classes(spark):
    df = spark.range(60_000).select((F.col("id") % 10_000).alias("k"), ((F.col("id") * 7919) % 601).cast("double").alias("v"))
    hot = spark.range(30_000).select(F.lit(3).cast("long").alias("k"), (F.col("id") % 5000).cast("double").alias("v"))
    got = describe.box_stats(df.unionByName(hot).repartition(6), ["v"], "k", small_distinct=500).toPandas().set_index("class")
    plain = df.unionByName(hot).toPandas()
    assert len(got) == 10_000
    for k in (0, 3, 9_999, 4_711):
        v = plain[plain.k == k]["v"].to_numpy()
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        row = got.loc[k]
        assert (row.q1, row["median"], row.q3) == pytest.approx((q1, q2, q3))
        assert (row.whisker_lo, row.whisker_hi, row.outliers) == (inside.min(), inside.max(), len(v) - len(inside))


@pytest.mark.parametrize("n", [0, 1, 70, 3000, 3080, 5000])
def test_sample_has_the_smallest_hashes(spark, monkeypatch, n):
    import hashlib

    monkeypatch.setattr(profile, "_FEW", 1)
    rows = [(i, f"p{i}") for i in range(3000)] + [(7, f"twin{i}") for i in range(40)] + [(None, f"none{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, payload string").repartition(5)
    got = [tuple(r) for r in profile.sample_rows(df, ["id"], n).collect()]
    order = sorted(rows, key=lambda r: (hashlib.md5(f"42|{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    assert sorted(got, key=str) == sorted(order[:n], key=str)


def test_levels_by_the_hundred_thousand(spark):
    df = spark.range(100_000).select("id", F.format_string("k%d", "id").alias("k"), F.when(F.col("id") % 2 == 0, "even").alias("half"))
    path = shared_path(spark)
    encode.save_levels(df, ["k", "half"], path)
    new = spark.createDataFrame([(1, "k99999", None), (2, "unseen", "even"), (3, None, "odd"), (4, "k0", "even")], "id int, k string, half string")
    got = {r["id"]: (r["k"], r["half"]) for r in encode.apply_saved_levels(new, ["k", "half"], path).collect()}
    order = sorted(f"k{i}" for i in range(100_000))
    assert {i: (v.size, v.indices.tolist()) for i, (v, _) in got.items()} == {
        1: (100_000, [order.index("k99999")]), 2: (100_000, []), 3: (100_000, []), 4: (100_000, [0])
    }
    assert {i: h.toArray().tolist() for i, (_, h) in got.items()} == {1: [0.0], 2: [1.0], 3: [0.0], 4: [1.0]}


def test_target_counts_of_numbers_multiply_no_rows(spark, capsys):
    rng = random.Random(3)
    values = [None, math.nan, -0.0, 0.0, 1.0, 2.5, math.inf, -math.inf, 7.0]
    rows = [(rng.choice(values), rng.randint(0, 3), rng.choice("uv"), rng.choice([0, 1, 1, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, b int, c string, y int").repartition(3).cache()
    fitted = {"a": binning.Bins((-math.inf, 0.0, 2.0, math.inf)), "b": binning.Bins((0.0, 1.0, 3.0)), "flat": binning.Bins(())}
    df = df.withColumn("flat", F.lit(1))
    got = screening.target_counts(df, "y", fitted, ["c"])
    want = {}
    for a, b, c, y in rows:
        if y is None:
            continue
        cells = [("b", str(sum(e < b for e in (1.0,)))), ("c", c)]
        if a is not None and not math.isnan(a):
            cells.append(("a", str(sum(e < a for e in (0.0, 2.0)))))
        for cell in cells:
            n, n1 = want.get(cell, (0, 0))
            want[cell] = n + 1, n1 + y
    assert {(r.feature, r.value): (r.n, r.n1) for r in got.collect()} == want
    assert not screening.target_counts(df, "y", {"flat": fitted["flat"]}, []).collect()
    # The rows of the numbers are not expanded to one per column.
    screening.target_counts(df, "y", fitted, []).explain()
    assert "Expand" not in capsys.readouterr().out


def test_levels_are_not_named_in_the_schema(spark):
    df = spark.range(50_000).select(F.format_string("k%d", "id").alias("k"))
    coded = encode.one_hot_vectors(df, ["k"], encode.level_table(df, ["k"]))
    assert len(coded.schema.json()) < 10_000
    assert coded.schema["k"].metadata["ml_attr"]["num_attrs"] == 50_000


def test_encodings_of_many_columns_take_no_more_jobs(spark):
    df = spark.range(300).select(
        (F.col("id") % 2).alias("y"), (F.col("id") % 5).alias("fold"), *[(F.col("id") % (i + 3)).cast("string").alias(f"c{i}") for i in range(9)]
    )

    def jobs(columns):
        spark.sparkContext.setJobGroup(f"g{len(columns)}", "")
        try:
            found = encode.fit_target_encodings(df, columns, "y")
            encode.out_of_fold_encodings(df, {c: f"o_{c}" for c in columns}, "y", "fold")
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"g{len(columns)}"))

    names = [f"c{i}" for i in range(9)]
    (two, few), (nine, many) = jobs(names[:2]), jobs(names)
    assert few == many
    for c in names[:2]:
        one = {r[0]: r[1] for r in encode.fit_target_encoding(df, c, "y")[0].collect()}
        assert {r[0]: r[1] for r in nine[c][0].collect()} == pytest.approx(one) and two[c][1] == nine[c][1]
