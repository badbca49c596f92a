"""Category encoders and scalers: fitted state is literals, or a table where it can be large."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.binning import numeric_columns, text_columns
from tidemark.operators.quantiles import exact_quantiles
from tidemark.session import materialize


def _pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct (feature, value) of the columns, without missing values."""
    tall = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "feature", "value")
    return tall.where(F.col("value").isNotNull()).distinct()


def category_levels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted distinct values of each column; ``level_table`` is the form without a list on the driver."""
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in _pairs(df, columns).collect() if columns else []:
        levels[r["feature"]].append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def level_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Table (feature, position, level) of the sorted distinct values, as ``OneHot.save`` writes it."""
    lanes = materialize(
        _pairs(df, columns).repartitionByRange("feature", "value").withColumn("lane", F.spark_partition_id())
    )
    earlier = Window.partitionBy("feature").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    before = lanes.groupBy("feature", "lane").agg(F.count(F.lit(1)).alias("n")).select(
        "feature", "lane", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    rank = F.row_number().over(Window.partitionBy("feature", "lane").orderBy("value")) - 1
    return lanes.withColumn("rank", rank).join(before, ["feature", "lane"]).select(
        "feature", (F.col("before") + F.col("rank")).cast("int").alias("position"), F.col("value").alias("level")
    )


def one_hot_vectors(df: DataFrame, columns: list[str], levels: DataFrame) -> DataFrame:
    """Each column as a sparse vector with one place per level; unknown and missing values are all zero."""
    counts = {r["feature"]: r["count"] for r in levels.groupBy("feature").count().collect()}
    sizes = [counts.get(c, 0) for c in columns]
    index = [f"_i{i}" for i in range(len(columns))]
    out = df
    for c, i in zip(columns, index):
        lookup = levels.where(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("position").alias(i))
        joined = out.join(lookup, F.col(c).cast("string") == F.col("_level"), "left")
        out = joined.select(*out.columns, i)
    vectors = {c: _one_place(F.col(i), n) for c, i, n in zip(columns, index, sizes)}
    # Only the number of levels is noted in the schema, not a name for each of them.
    return out.select(
        *[vectors[c].alias(c, metadata={"ml_attr": {"num_attrs": counts.get(c, 0)}}) if c in vectors else F.col(c) for c in df.columns]
    )


def _one_place(place: Column, size: int) -> Column:
    """Sparse vector with a one at ``place``; all zero where that is NULL.

    ``OneHotEncoder`` would name every place in the schema, which the driver holds.
    """
    index = F.coalesce(place.cast("string"), F.lit(""))
    value = F.when(place.isNull(), "").otherwise("1.0")
    text = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size},"indices":['), index, F.lit('],"values":['), value, F.lit("]}}"))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]), {"mode": "FAILFAST"})["v"]


def save_levels(df: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Write the level table of the columns, in any number of levels, and read it back."""
    level_table(df, columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def apply_saved_levels(df: DataFrame, columns: list[str], path: str) -> DataFrame:
    """``one_hot_vectors`` with a saved level table; a column it needs and the frame lacks is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns to encode are absent: {missing}")
    return one_hot_vectors(df, columns, df.sparkSession.read.parquet(path))


@dataclass(frozen=True)
class OneHot:
    """0/1 column per known level, named ``column_level``; unknown values are all zero."""

    levels: dict[str, list[str]]

    def names(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.levels.items() for v in vs]

    def columns(self) -> list[Column]:
        return [
            F.coalesce(F.col(c).cast("string") == v, F.lit(False)).cast("tinyint").alias(f"{c}_{v}")
            for c, vs in self.levels.items()
            for v in vs
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.levels if c not in df.columns]
        if missing:
            raise ValueError(f"columns to encode are absent: {missing}")
        rest = [c for c in df.columns if c not in self.levels]
        return df.select(*rest, *self.columns())

    def save(self, df: DataFrame, path: str) -> None:
        rows = [(c, i, v) for c, vs in self.levels.items() for i, v in enumerate(vs)]
        table = df.sparkSession.createDataFrame(rows, "feature string, position int, level string")
        table.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "OneHot":
        levels: dict[str, list[str]] = {}
        for r in spark.read.parquet(path).orderBy("feature", "position").collect():
            levels.setdefault(r["feature"], []).append(r["level"])
        return cls(levels)


def fit_one_hot(df: DataFrame, columns: list[str], drop_first: bool = False) -> OneHot:
    levels = category_levels(df, columns)
    return OneHot({c: v[1:] if drop_first else v for c, v in levels.items()})


def one_hot_and_save(df: DataFrame, target: str, path: str) -> DataFrame:
    """One-hot encode every text column, save the encoder, and return numbers, target and levels."""
    texts = text_columns(df, (target,))
    encoder = fit_one_hot(df, texts)
    encoder.save(df, path)
    return encoder.transform(df.select(target, *numeric_columns(df, (target,)), *texts))


def apply_saved_one_hot(df: DataFrame, path: str, target: str | None = None) -> DataFrame:
    """Apply a saved encoder; a column it needs and the frame lacks is an error."""
    encoder = OneHot.load(df.sparkSession, path)
    missing = [c for c in encoder.levels if c not in df.columns]
    if missing:
        raise ValueError(f"columns to encode are absent: {missing}")
    kept = [target] if target and target in df.columns else []
    return encoder.transform(df.select(*kept, *numeric_columns(df, tuple(kept)), *encoder.levels))


def ordinal_encode(df: DataFrame, orders: dict[str, list[str]]) -> DataFrame:
    """Position of each value in the given order; an unlisted value is an error."""
    out = []
    for name in df.columns:
        col = F.col(name)
        if name in orders:
            pairs = [F.lit(x) for i, v in enumerate(orders[name]) for x in (v, i)]
            code = F.try_element_at(F.create_map(*pairs), col.cast("string"))
            fail = F.raise_error(F.concat(F.lit(f"{name}: unknown category "), col.cast("string")))
            # A missing value stays missing.
            col = F.when(col.isNull(), F.lit(None)).when(code.isNotNull(), code).otherwise(fail.cast("int"))
        out.append(col.alias(name))
    return df.select(*out)


def _blend(n: Column, total: Column, squares: Column, mean: Column, variance: Column) -> Column:
    """Empirical-Bayes mean of a category: w * own mean + (1 - w) * overall mean with
    w = variance * n / (variance * n + spread / n)."""
    own = total / n
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    den = variance * n + spread / n
    weight = F.when(den > 0, variance * n / F.nullif(den, F.lit(0.0)))
    return F.coalesce(weight * own + (1 - weight) * mean, mean)


def _sums(y: Column) -> list[Column]:
    d = y.cast("double")
    return [F.count(y).alias("n"), F.sum(d).alias("s"), F.sum(d * d).alias("q")]


def fit_target_encoding(df: DataFrame, column: str, target: str) -> tuple[DataFrame, float]:
    """Table (category, encoding) and the overall mean that unknown categories get."""
    return fit_target_encodings(df, [column], target)[column]


def fit_target_encodings(df: DataFrame, columns: list[str], target: str) -> dict[str, tuple[DataFrame, float]]:
    """Table (category, encoding) and overall mean of each column.

    All columns are summed in one aggregation on (feature, category), which is stored; the tables
    are slices of it.
    """
    if not columns:
        return {}
    cells = materialize(_tall_sums(df, columns, target, []))
    first = cells.where(F.col("feature") == columns[0])
    whole = first.agg(*[F.sum(k).alias(k) for k in "nsq"]).first()
    if not whole["n"]:
        # No target, no encoding.
        return {c: (cells.where("false").select("category", F.lit(None).cast("double").alias("encoding")), None) for c in columns}
    mean = whole["s"] / whole["n"]
    variance = whole["q"] / whole["n"] - mean * mean
    n, s, q = (F.col(k) for k in ("n", "s", "q"))
    blended = cells.select("feature", "category", _blend(n, s, q, F.lit(mean), F.lit(variance)).alias("encoding"))
    return {c: (blended.where(F.col("feature") == c).select("category", "encoding"), mean) for c in columns}


def _tall_sums(df: DataFrame, columns: list[str], target: str, by: list[str]) -> DataFrame:
    """Sums of the target per (feature, category as text, by...) of all columns in one aggregation."""
    y = F.col("_y")
    rows = df.where(F.col(target).isNotNull()).select(
        F.col(target).alias("_y"), *by, *[F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_c{i}").alias("category")) for i, c in enumerate(columns)])
    return rows.select("_y", *by, F.inline(cells)).groupBy("feature", "category", *by).agg(*_sums(y))


def apply_target_encoding(df: DataFrame, column: str, table: DataFrame, mean: float, out: str | None = None) -> DataFrame:
    """Join the encodings; unknown categories get the overall mean."""
    out = out or column
    lookup = table.select(F.col("category").alias("_category"), F.col("encoding").alias("_encoding"))
    joined = df.join(lookup, F.col(column).cast(lookup.schema["_category"].dataType).eqNullSafe(F.col("_category")), "left")
    coded = F.coalesce("_encoding", F.lit(mean))
    if out == column:
        return joined.select(*[coded.alias(c) if c == column else F.col(c) for c in df.columns])
    return joined.select(*df.columns, coded.alias(out))


def out_of_fold_encoding(df: DataFrame, column: str, target: str, fold: str, out: str) -> DataFrame:
    """Encode training rows by the statistics of the other folds only."""
    return out_of_fold_encodings(df, {column: out}, target, fold)


def out_of_fold_encodings(df: DataFrame, columns: dict[str, str], target: str, fold: str) -> DataFrame:
    """Add for each column the encoding (named by the value) by the statistics of the other folds only.

    Sums per (feature, category, fold) and per fold are taken once for all columns; "the other folds"
    is the difference to the total, so the training rows are scanned once whatever the number of
    folds and columns.
    """
    if not columns:
        return df
    cells = materialize(
        _tall_sums(df.withColumn("_f", F.col(fold)), list(columns), target, ["_f"]).withColumnsRenamed(
            {"feature": "_of", "category": "_c"}
        )
    )
    per_category = cells.groupBy("_of", "_c").agg(*[F.sum(k).alias(f"c_{k}") for k in "nsq"])
    per_fold = cells.where(F.col("_of") == next(iter(columns))).groupBy("_f").agg(*[F.sum(k).alias(f"f_{k}") for k in "nsq"])
    sums = per_fold.collect()  # one row per fold
    whole = {k: sum(r[f"f_{k}"] for r in sums) for k in "nsq"}
    # Every category in every fold, also where the fold holds none of its rows.
    grid = per_category.select("*", F.explode(F.array(*[F.lit(r["_f"]) for r in sums])).alias("_f"))
    mine = grid.join(
        cells.select(F.col("_of").alias("_of2"), F.col("_c").alias("_c2"), F.col("_f").alias("_f2"), "n", "s", "q"),
        (F.col("_of") == F.col("_of2")) & F.col("_c").eqNullSafe(F.col("_c2")) & (F.col("_f") == F.col("_f2")),
        "left",
    ).join(F.broadcast(per_fold), "_f")  # one row per fold
    rest = {k: F.col(f"c_{k}") - F.coalesce(F.col(k), F.lit(0)) for k in "nsq"}
    other = {k: F.lit(whole[k]) - F.col(f"f_{k}") for k in "nsq"}
    mean = other["s"] / other["n"]
    variance = other["q"] / other["n"] - mean * mean
    n = F.nullif(rest["n"], F.lit(0).cast("bigint"))
    code = F.coalesce(_blend(n, rest["s"], rest["q"], mean, variance), mean)
    table = materialize(mine.select("_of", "_c", "_f", code.alias("_of_code"))) if len(columns) > 1 else mine.select(
        "_of", "_c", "_f", code.alias("_of_code")
    )
    encoded = df
    for column, out in columns.items():
        own = table.where(F.col("_of") == column).select(
            F.col("_c").alias("_of_category"), F.col("_f").alias("_of_fold"), "_of_code"
        )
        on = F.col(column).cast("string").eqNullSafe(F.col("_of_category")) & (F.col(fold) == F.col("_of_fold"))
        encoded = encoded.join(own, on, "left").select(*encoded.columns, F.col("_of_code").alias(out))
    return encoded


@dataclass(frozen=True)
class Scaler:
    """(x - center) / scale per column; a zero scale counts as one."""

    center: dict[str, float]
    scale: dict[str, float]

    def expr(self, name: str) -> Column:
        scale = self.scale[name] or 1.0
        return (F.col(name).cast("double") - F.lit(self.center[name])) / F.lit(scale)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self.expr(c).alias(c) if c in self.center else F.col(c) for c in df.columns])


def fit_standard(df: DataFrame, columns: list[str]) -> Scaler:
    """Mean and population standard deviation."""
    row = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("m", F.avg), ("s", F.stddev_pop))]
    ).first()
    return Scaler(
        {c: row[f"m{i}"] for i, c in enumerate(columns)}, {c: row[f"s{i}"] for i, c in enumerate(columns)}
    )


def fit_robust(df: DataFrame, columns: list[str], **quantile_options) -> Scaler:
    """Median and interquartile range."""
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], **quantile_options)
    return Scaler({c: q[c][1] for c in columns}, {c: q[c][2] - q[c][0] for c in columns})
