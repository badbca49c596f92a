"""Tables behind the usual descriptive charts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.binning import numeric_columns
from tidemark.operators.ordered import running_totals
from tidemark.operators.profile import low_cardinality_features
from tidemark.session import materialize

# Bandwidths beyond which a Gaussian kernel is zero in double precision.
REACH = 39.0


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columns..., Count, Percentage) of the complete rows, most frequent first, then a Total row."""
    counts = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("Count"))
    total = counts.agg(F.sum("Count").alias("_t"))
    share = counts.select(
        *[F.col(c).cast("string").alias(c) for c in columns],
        "Count",
        (F.col("Count") / total.scalar() * 100).alias("Percentage"),
        F.lit(0).alias("_last"),
    )
    last = total.select(
        F.lit("Total").alias(columns[0]),
        *[F.lit(None).cast("string").alias(c) for c in columns[1:]],
        F.col("_t").alias("Count"),
        F.lit(100.0).alias("Percentage"),
        F.lit(1).alias("_last"),
    )
    return share.unionByName(last).orderBy("_last", F.col("Count").desc(), *columns).drop("_last")


def crosstab_share(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(variable, value, target, n, share): target mix inside every value."""
    rows = df.where(F.col(target).isNotNull()).select(
        F.col(target).alias("target"), *[F.col(c).cast("string").alias(c) for c in columns]
    )
    tall = rows.unpivot(["target"], columns, "variable", "value").where(F.col("value").isNotNull())
    cells = tall.groupBy("variable", "value", "target").agg(F.count(F.lit(1)).alias("n"))
    # A value has as many rows here as the target has classes.
    row = Window.partitionBy("variable", "value")
    return cells.withColumn("share", F.col("n") / F.sum("n").over(row))


def crosstab_low_cardinality(df: DataFrame, target: str, cut: int = 10) -> DataFrame:
    """``crosstab_share`` of the text columns with at most ``cut`` values."""
    names = [c for c in low_cardinality_features(df, cut) if c != target]
    return crosstab_share(df, names, target)


def category_counts(df: DataFrame, columns: list[str] | None = None, cut: int = 30) -> DataFrame:
    """(variable, value, n) of the given text columns, or of all with at most ``cut`` values."""
    names = columns if columns is not None else low_cardinality_features(df, cut)
    tall = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "variable", "value")
    return tall.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def event_rates(df: DataFrame, target: str, max_unique: int = 20) -> DataFrame:
    """(variable, value, Taxa_de_Evento, Volume) of text columns and of numbers with few values."""
    text = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name != target]
    numbers = [c for c in numeric_columns(df, (target,))]
    few = low_cardinality_features(df.select(*numbers), max_unique, numeric_too=True) if numbers else []
    names = [c for c in df.columns if c in text or c in few]
    rows = df.where(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("y"), *[F.col(c).cast("string").alias(c) for c in names]
    )
    tall = rows.unpivot(["y"], names, "variable", "value").where(F.col("value").isNotNull())
    return tall.groupBy("variable", "value").agg(
        F.avg("y").alias("Taxa_de_Evento"), F.count(F.lit(1)).alias("Volume")
    )


def histogram(df: DataFrame, columns: list[str], bins: int = 30, by: str | None = None, density: bool = False) -> DataFrame:
    """(variable, [class], bin, lo, hi, n[, density]) over equal bins [a, b), the last one closed.

    With ``by`` every class is binned over its own value range.
    """
    # One row per distinct value, so that the edges are joined to far fewer rows than there are.
    values = _tall(df, columns, by).groupBy("variable", "class", "v").agg(F.count(F.lit(1)).alias("m"))
    low, high = F.min("v"), F.max("v")
    ranges = values.groupBy("variable", "class").agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("a"), F.when(low == high, high + 0.5).otherwise(high).alias("b")
    )
    step = (F.col("b") - F.col("a")) / F.lit(float(bins))
    edges = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: i * step + F.col("a"))
    ranges = ranges.select("variable", "class", F.array_append(edges, F.col("b")).alias("edges"))
    placed = _matched(values, ranges).withColumn(
        "bin", F.size(F.filter(F.slice("edges", 2, bins - 1), lambda e: e <= F.col("v")))
    )
    out = (
        placed.groupBy("variable", "class", "bin")
        .agg(F.first("edges").alias("edges"), F.sum("m").alias("n"))
        .select("variable", "class", "bin", F.get("edges", F.col("bin")).alias("lo"), F.get("edges", F.col("bin") + 1).alias("hi"), "n")
    )
    if density:
        whole = Window.partitionBy("variable", "class")
        out = out.withColumn("density", F.col("n") / (F.sum("n").over(whole) * (F.col("hi") - F.col("lo"))))
    return out if by is not None else out.drop("class")


def box_stats(df: DataFrame, columns: list[str], by: str | None = None, small_distinct: int | None = None) -> DataFrame:
    """(variable, [class], q1, median, q3, whisker_lo, whisker_hi, outliers).

    Whiskers reach the outermost values within 1.5 interquartile ranges of the box.  Values are
    counted first; quartiles are the values at their ranks in running counts per variable and class,
    cut into ranges of about ``small_distinct`` values, so the classes are data in any number.
    """
    counted = running_totals(
        _tall(df, columns, by), "v", {"m": F.count(F.lit(1))}, ["variable", "class"], False, small_distinct
    )
    counted = materialize(counted.select("variable", "class", "v", "m", "cum_m", "tot_m"))
    groups = counted.groupBy("variable", "class").agg(
        *[_at_rank(share, up).alias(f"{name}_{up}") for name, share in _QUARTILES.items() for up in (0, 1)],
        F.max("tot_m").alias("n"),
    )
    quartiles = {
        name: F.col(f"{name}_0") + (F.col(f"{name}_1") - F.col(f"{name}_0")) * _rest(F.col("n"), share)
        for name, share in _QUARTILES.items()
    }
    boxes = materialize(groups.select("variable", "class", *[q.alias(name) for name, q in quartiles.items()]))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("v") >= F.col("q1") - reach) & (F.col("v") <= F.col("q3") + reach)
    out = (
        _matched(counted, boxes)
        .groupBy("variable", "class", *_QUARTILES)
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("m"))).alias("outliers"),
        )
    )
    return out if by is not None else out.drop("class")


_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _rest(n: Column, share: float) -> Column:
    """How far the quantile lies between the values of the two ranks around it."""
    return share * (n - 1) - F.floor(share * (n - 1))


def _at_rank(share: float, up: int) -> Column:
    """The value that holds the rank below (0) or above (1) a quantile, ranks counted from 0."""
    at = F.least(F.floor(share * (F.col("tot_m") - 1)) + up, F.col("tot_m") - 1)
    return F.max(F.when((at >= F.col("cum_m") - F.col("m")) & (at < F.col("cum_m")), F.col("v")))


def kernel_density(
    df: DataFrame, columns: list[str], by: str | None = None, grid: int = 200, cut: float = 3.0
) -> DataFrame:
    """(variable, [class], point, x, density): Gaussian kernel, Scott bandwidth, on an even grid.

    Each distinct value adds its kernel to the grid points within ``REACH`` bandwidths; the sums are
    taken on the map side, so the shuffle carries at most grid points per task and class.
    """
    rows = _tall(df, columns, by)
    width = F.col("s") * F.pow(F.col("n").cast("double"), F.lit(-1 / 5))
    setup = (
        rows.groupBy("variable", "class")
        .agg(F.count("v").alias("n"), F.stddev_samp("v").alias("s"), F.min("v").alias("a"), F.max("v").alias("b"))
        .where("n >= 2 AND s > 0")
        .withColumn("width", width)
        .withColumn("low", F.col("a") - cut * F.col("width"))
        .withColumn("step", (F.col("b") + cut * F.col("width") - F.col("low")) / (grid - 1))
        .select("variable", "class", "n", "width", "low", "step")
    )
    counted = rows.groupBy("variable", "class", "v").agg(F.count(F.lit(1)).alias("m"))
    values = _matched(counted, setup)

    def _point(widths: float, last: int) -> Column:
        """Grid point that many bandwidths from the value, inside the grid."""
        at = (F.col("v") + widths * F.col("width") - F.col("low")) / F.col("step")
        return F.greatest(at, F.lit(0.0)).cast("int") if widths < 0 else F.least(F.ceil(at), F.lit(last)).cast("int")

    x = F.col("low") + F.col("point") * F.col("step")
    z = (x - F.col("v")) / F.col("width")
    kernel = F.col("m") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("width") * F.lit(math.sqrt(2 * math.pi)))
    every = setup.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    empty = every.select("variable", "class", "point", x.alias("x"), F.lit(0.0).alias("k"))
    out = (
        values.select("*", F.explode(F.sequence(_point(-REACH, 0), _point(REACH, grid - 1))).alias("point"))
        .select("variable", "class", "point", x.alias("x"), kernel.alias("k"))
        .unionByName(empty)
        .groupBy("variable", "class", "point", "x")
        .agg(F.sum("k").alias("density"))
    )
    return out if by is not None else out.drop("class")


def _tall(df: DataFrame, columns: list[str], by: str | None) -> DataFrame:
    """(variable, class, v): every value of the columns, without missing values and classes."""
    kind = df.schema[by].dataType.simpleString() if by else "string"
    group = F.col(by) if by else F.lit(None).cast(kind)
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), _clean(F.col(c)).alias("v")) for c in columns])
    rows = df.where(F.col(by).isNotNull()) if by else df
    out = rows.select(group.alias("class"), F.inline(cells)).where("v IS NOT NULL")
    return out.select("variable", "class", "v")


def _matched(values: DataFrame, setup: DataFrame) -> DataFrame:
    """Join on variable and class, where the class may be NULL."""
    right = setup.withColumnsRenamed({"variable": "_variable", "class": "_class"})
    on = (F.col("variable") == F.col("_variable")) & F.col("class").eqNullSafe(F.col("_class"))
    return values.join(right, on).drop("_variable", "_class")


def _clean(col: Column) -> Column:
    x = col.cast("double")
    return F.when(~F.isnan(x), x)

