"""Weight of evidence, information value and bivariate tables for all variables at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import ratio
from tidemark.operators.binning import Bins, numeric_columns, quantile_bins, text_columns, width_bins
from tidemark.operators.dedupe import keep_last
from tidemark.operators.ordered import running_totals
from tidemark.operators.profile import feature_stats
from tidemark.operators.tally import bin_tallies
from tidemark.session import materialize

# Strength classes by upper bound of the information value.
STRENGTH = (
    (0.02, "Inútil para a predição"),
    (0.1, "Preditor Fraco"),
    (0.3, "Preditor Moderado"),
)
STRONGEST = "Preditor Forte"
# Fixed value: stands in for a zero share of goods or bads.
ZERO_SHARE = 1e-6


def value_ranges(df: DataFrame, target: str, bins: int = 10) -> tuple[dict[str, Bins], list[str]]:
    """Fitted quantile bins of the numeric columns and the names of the text columns."""
    numbers = numeric_columns(df, (target,))
    # Edges come from the rows that take part: value and target both present.
    columns = {c: F.when(F.col(target).isNotNull(), F.col(c)) for c in numbers}
    return quantile_bins(df, columns, bins), text_columns(df, (target,))


def target_counts(df: DataFrame, target: str, fitted: dict[str, Bins], texts: list[str]) -> DataFrame:
    """(feature, value, lo, hi, n, n1) over all variables: numbers in one scan, texts in one aggregation.

    ``value`` is the text value, or the bin number of a numeric column.  Missing values and
    rows without a target are left out.
    """
    known = df.where(F.col(target).isNotNull())
    filled = [c for c, b in fitted.items() if b.count]
    parts = []
    if filled:
        edges = [list(fitted[c].edges[1:-1]) for c in filled]
        tallies = bin_tallies(known, F.col(target), [F.col(c) for c in filled], edges)
        name = F.get(F.array(*map(F.lit, filled)), F.col("place")).alias("feature")
        parts.append(tallies.select(name, F.col("bin").cast("string").alias("value"), "n", "n1"))
    if texts or not filled:
        y = F.col(target).cast("bigint").alias("y")
        # A column with one value only has no bin.
        none = [F.lit(None).cast("string").alias(c) for c in fitted] if not filled else []
        coded = none + [F.col(c).cast("string").alias(c) for c in texts]
        names = ([] if filled else list(fitted)) + list(texts)
        tall = known.select(y, *coded).unpivot(["y"], names, "feature", "value")
        parts.append(
            tall.where(F.col("value").isNotNull())
            .groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1"))
        )
    counted = reduce(DataFrame.unionByName, parts)
    return counted.select(
        "feature", "value", _edge(fitted, 0).alias("lo"), _edge(fitted, 1).alias("hi"), "n", "n1"
    )


def _edge(fitted: dict[str, Bins], shift: int) -> Column:
    """Lower (0) or upper (1) bound of a numeric bin."""
    filled = {c: b for c, b in fitted.items() if b.count}
    if not filled:
        return F.lit(None).cast("double")
    pairs = []
    for name, b in filled.items():
        pairs.append(F.lit(name))
        pairs.append(F.expr("array(" + ", ".join(f"CAST('{e!r}' AS DOUBLE)" for e in b.edges) + ")"))
    edges = F.try_element_at(F.create_map(*pairs), F.col("feature"))
    return F.when(edges.isNotNull(), F.get(edges, F.expr("try_cast(value AS int)") + shift))


def _with_totals(counts: DataFrame) -> DataFrame:
    # Read twice, and far smaller than the rows it was counted from.
    counts = materialize(counts)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("t_n"), F.sum("n1").alias("t_1"))
    # One row per column of the input.
    return counts.join(F.broadcast(totals), "feature")


def woe_table(df: DataFrame, target: str, bins: int = 10) -> DataFrame:
    """Per variable and value: counts, shares of goods (target 1) and bads, WoE and IV term."""
    fitted, texts = value_ranges(df, target, bins)
    c = F.col
    rows = _with_totals(target_counts(df, target, fitted, texts))
    good = F.when(c("n1") == 0, ZERO_SHARE).otherwise(c("n1") / c("t_1").cast("double"))
    bad = F.when(c("n1") == c("n"), ZERO_SHARE).otherwise((c("n") - c("n1")) / (c("t_n") - c("t_1")).cast("double"))
    return (
        rows.select(
            "feature", "value", "lo", "hi", "n", c("n1").alias("good"), (c("n") - c("n1")).alias("bad"),
            good.alias("distr_good"), bad.alias("distr_bad"),
        )
        .withColumn("woe", F.ln(c("distr_good") / c("distr_bad")))
        .withColumn("iv", (c("distr_good") - c("distr_bad")) * c("woe"))
    )


def woe_iv(df: DataFrame, feature: str, target: str, bins: int = 10) -> DataFrame:
    """WoE table of one variable."""
    return woe_table(df.select(feature, target), target, bins)


def strength(iv: Column) -> Column:
    """Strength class of an information value."""
    grade = F.when(iv < STRENGTH[0][0], STRENGTH[0][1])
    for bound, name in STRENGTH[1:]:
        grade = grade.when(iv < bound, name)
    return grade.otherwise(STRONGEST)


def iv_table(df: DataFrame, target: str, bins: int = 10) -> DataFrame:
    """(Variavel, IV, Preditividade) of every variable, strongest first."""
    total = woe_table(df, target, bins).groupBy("feature").agg(F.sum("iv").alias("iv"))
    names = df.sparkSession.createDataFrame(
        [(c,) for c in numeric_columns(df, (target,)) + text_columns(df, (target,))], "feature string"
    )
    # A variable without usable bins scores zero.
    full = F.broadcast(names).join(total, "feature", "left").fillna(0.0, subset=["iv"])
    return full.select(
        F.col("feature").alias("Variavel"), F.col("iv").alias("IV"), strength(F.col("iv")).alias("Preditividade")
    ).orderBy(F.col("IV").desc(), "Variavel")


def category_iv(df: DataFrame, target: str, variable: str) -> DataFrame:
    """One text variable against a target: counts, rounded shares, ratio of shares and IV.

    An infinite logarithm counts as zero.
    """
    return _share_table(target_counts(df, target, {}, [variable]), variable)


def bin_iv(df: DataFrame, target: str, variable: str, bins: int) -> DataFrame:
    """``category_iv`` on equal-width bins of a numeric variable."""
    fitted = width_bins(df, [variable], bins)
    return _share_table(target_counts(df, target, fitted, []), variable)


def _share_table(counts: DataFrame, variable: str) -> DataFrame:
    c = F.col
    n0, t0 = c("n") - c("n1"), c("t_n") - c("t_1")
    yes = F.bround(ratio(c("n1"), c("t_1")) * 100, 2)
    no = F.bround(ratio(n0, t0) * 100, 2)
    shares = _with_totals(counts).select(
        c("value").alias(variable),
        "lo",
        "hi",
        c("n1").alias("Sim"),
        n0.alias("Nao"),
        yes.alias("pct_Sim"),
        no.alias("pct_Nao"),
        F.bround(c("n1") / c("n") * 100, 2).alias("pct_FreqLinha"),
    )
    woe = F.when(c("pct_Nao") != 0, c("pct_Sim") / F.nullif(c("pct_Nao"), F.lit(0.0)))
    # ln(0) and ln of a missing ratio are NULL here and infinite elsewhere; both end as zero.
    term = (c("pct_Sim") / 100 - c("pct_Nao") / 100) * F.coalesce(F.ln(woe), F.lit(0.0))
    return shares.select("*", woe.alias("WoE"), term.alias("IV"))


def bivariate_table(df: DataFrame, target: str, bins: int = 10) -> DataFrame:
    """All variables against the target, every step rounded half-even to two places in turn.

    Columns: Variavel, Var_Range, lo, hi, Target_1, Target_0, Total, pct_Freq, pct_Target_1,
    pct_Target_0, pct_Taxa_de_Target_1, Odds, LN_Odds, IV.
    """
    fitted, texts = value_ranges(df, target, bins)
    c = F.col

    def pct(part: Column, whole: Column) -> Column:
        return F.bround(ratio(part, whole) * 100, 2)

    def floor_zero(x: Column) -> Column:
        return F.when(x == 0, 0.01).otherwise(x)

    rows = _with_totals(target_counts(df, target, fitted, texts)).withColumn("n0", c("n") - c("n1"))
    return (
        rows.withColumn("p1", pct(c("n1"), c("t_1")))
        .withColumn("p0", floor_zero(pct(c("n0"), c("t_n") - c("t_1"))))
        .withColumn("odds", floor_zero(F.bround(c("p1") / c("p0"), 2)))
        .withColumn("ln_odds", F.bround(F.ln("odds"), 2))
        .select(
            c("feature").alias("Variavel"),
            c("value").alias("Var_Range"),
            "lo",
            "hi",
            c("n1").alias("Target_1"),
            c("n0").alias("Target_0"),
            c("n").alias("Total"),
            pct(c("n"), c("t_n")).alias("pct_Freq"),
            c("p1").alias("pct_Target_1"),
            c("p0").alias("pct_Target_0"),
            pct(c("n1"), c("n")).alias("pct_Taxa_de_Target_1"),
            c("odds").alias("Odds"),
            c("ln_odds").alias("LN_Odds"),
            F.when(c("odds") == 0.01, 0.0)
            .otherwise(F.bround((c("p1") / 100 - c("p0") / 100) * c("ln_odds"), 2))
            .alias("IV"),
        )
    )


def merge_bivariate(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append newer bivariate rows; of two rows of a (Variavel, Var_Range) the newer stays."""
    both = old.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)))
    return keep_last(both, ["Variavel", "Var_Range"], ["_gen"]).drop("_gen")


def bivariate_of(table: DataFrame, variable: str) -> DataFrame:
    """Rows of one variable."""
    return table.where(F.col("Variavel") == variable)


def iv_ranking(table: DataFrame) -> DataFrame:
    """(Variavel, IV) from a bivariate table, highest first."""
    return (
        table.groupBy("Variavel").agg(F.bround(F.sum("IV"), 2).alias("IV")).orderBy(F.col("IV").desc(), "Variavel")
    )


# What the fit of the log-odds suggests for a variable.
KEEP_CONTINUOUS, CATEGORISE = "Usar como contínua", "Categorizar"
_EPS = 1e-6


def logodds_curve(
    df: DataFrame,
    variables: list[str],
    target: str,
    clip: bool = False,
    max_bins: int = 10,
    range_rows: int | None = None,
) -> DataFrame:
    """(variable, bin, x, n, event_rate, log_odds): mean value and log-odds per bin.

    Numeric variables are cut into min(max_bins, distinct values) equal-width bins; text
    variables keep their values in alphabetical order as 0, 1, 2, ...  With ``clip`` event
    rates are held inside (0, 1); without it bins whose log-odds are infinite are left out.
    Variables with a single value are left out.
    """
    stats = {r["feature"]: r["cardinality"] for r in feature_stats(df, variables).collect()}
    used = [v for v in variables if stats.get(v, 0) > 1]
    numbers = [v for v in used if v in numeric_columns(df)]
    texts = [v for v in used if v not in numbers]
    y = F.col(target).cast("double")
    fitted = width_bins(df, numbers, {v: min(max_bins, stats[v]) for v in numbers})
    parts = []
    if numbers:
        cells = [
            F.struct(
                F.lit(v).alias("variable"),
                fitted[v].index(F.col(v)).cast("string").alias("bin"),
                F.col(v).cast("double").alias("x"),
            )
            for v in numbers
        ]
        parts.append(df.select(y.alias("y"), F.explode(F.array(*cells)).alias("v")).select("y", "v.*"))
    if texts:
        tall = df.select(y.alias("y"), *[F.col(v).cast("string").alias(v) for v in texts])
        parts.append(
            tall.unpivot(["y"], texts, "variable", "bin").withColumn("x", F.lit(None).cast("double"))
        )
    if not parts:
        empty = "variable string, bin string, x double, n bigint, event_rate double, log_odds double"
        return df.sparkSession.createDataFrame([], empty)
    rows = reduce(DataFrame.unionByName, parts).where(F.col("bin").isNotNull())
    points = rows.groupBy("variable", "bin").agg(
        F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"), F.avg("y").alias("event_rate")
    )
    if texts:
        # Position of each text value in alphabetical order.
        named = points.where(F.col("x").isNull())
        order = running_totals(named, "bin", {"one": F.max(F.lit(1))}, ["variable"], False, range_rows)
        place = order.select(
            F.col("variable").alias("_v"), F.col("bin").alias("_b"), (F.col("cum_one") - 1).cast("double").alias("_x")
        )
        ranked = named.join(place, (F.col("variable") == F.col("_v")) & (F.col("bin") == F.col("_b"))).select(
            "variable", "bin", F.col("_x").alias("x"), "n", "event_rate"
        )
        points = points.where(F.col("x").isNotNull()).unionByName(ranked)
    rate = F.greatest(F.least(F.col("event_rate"), F.lit(1 - _EPS)), F.lit(_EPS)) if clip else F.col("event_rate")
    odds = rate / F.nullif(1 - rate, F.lit(0.0))
    return points.withColumn("log_odds", F.when(odds > 0, F.ln(odds))).where(F.col("log_odds").isNotNull())


def logodds_r2(
    df: DataFrame, variables: list[str], target: str, threshold: float = 0.85, clip: bool = False
) -> DataFrame:
    """(Variable, R2, Feat_Eng): how straight the log-odds run along each variable."""
    curve = logodds_curve(df, variables, target, clip)
    fit = curve.groupBy("variable").agg(F.regr_r2("log_odds", "x").alias("r2"), F.count(F.lit(1)).alias("points"))
    kept = fit.where(F.col("points") >= 2)
    return kept.select(
        F.col("variable").alias("Variable"),
        F.col("r2").alias("R2"),
        F.when(F.col("r2") > threshold, KEEP_CONTINUOUS).otherwise(CATEGORISE).alias("Feat_Eng"),
    )
