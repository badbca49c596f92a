"""Column profiles, feature typing and column housekeeping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalars import nan_to_null

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)


def _family(dtype: T.DataType) -> str:
    if isinstance(dtype, _WHOLE):
        return "bigint"
    if isinstance(dtype, _REAL):
        return "double"
    return "string"


def _as_family(col: Column, dtype: T.DataType, family: str) -> Column:
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return nan_to_null(col, dtype).cast(family)


def tall_values(df: DataFrame, columns: list[str]) -> list[DataFrame]:
    """(feature, value) rows of the given columns, one frame per type family."""
    fields = [df.schema[c] for c in columns]
    out = []
    for family in ("bigint", "double", "string"):
        mine = [f for f in fields if _family(f.dataType) == family]
        if mine:
            wide = df.select(*[_as_family(F.col(f.name), f.dataType, family).alias(f.name) for f in mine])
            out.append(wide.unpivot([], [f.name for f in mine], "feature", "value"))
    return out


def feature_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, rows, nulls, cardinality) of every column.

    All columns of a type family are counted by one aggregation on (feature, value), which
    combines on the map side; a hot value is one row per task.
    """
    parts = [
        tall.groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("feature")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("cardinality"),
        )
        for tall in tall_values(df, columns or df.columns)
    ]
    return reduce(DataFrame.unionByName, parts)


def metadata(
    df: DataFrame, ids: list[str] | None = None, targets: list[str] | None = None, order_by: str = "PC_NULOS"
) -> DataFrame:
    """Profile table: FEATURE, USO_FEATURE, QT_NULOS, PC_NULOS, CARDINALIDADE, TIPO_FEATURE.

    Sorted by ``order_by`` descending, then by name.
    """
    ids, targets = ids or [], targets or []
    roles = {c: "ID" if c in ids else "Target" if c in targets else "Explicativa" for c in df.columns}
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    name = F.col("feature")
    stats = feature_stats(df)
    return stats.select(
        name.alias("FEATURE"),
        _lookup(name, roles).alias("USO_FEATURE"),
        F.col("nulls").alias("QT_NULOS"),
        F.bround(F.col("nulls") / F.col("rows") * 100, 2).alias("PC_NULOS"),
        F.col("cardinality").alias("CARDINALIDADE"),
        _lookup(name, kinds).alias("TIPO_FEATURE"),
    ).orderBy(F.col(order_by).desc(), F.col("FEATURE"))


def metadata_short(df: DataFrame) -> DataFrame:
    """Profile table without roles: nome_variavel, tipo, qt_nulos, percent_nulos, cardinalidade."""
    c = F.col
    return metadata(df).select(
        c("FEATURE").alias("nome_variavel"),
        c("TIPO_FEATURE").alias("tipo"),
        c("QT_NULOS").alias("qt_nulos"),
        c("PC_NULOS").alias("percent_nulos"),
        c("CARDINALIDADE").alias("cardinalidade"),
    )


def _lookup(col: Column, mapping: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), col)


def null_heavy_features(profile: DataFrame, cut: float = 70) -> list[str]:
    """Names whose null percentage exceeds ``cut``, from a ``metadata`` table."""
    rows = profile.where(F.col("PC_NULOS") > cut).select("FEATURE").collect()
    return [r["FEATURE"] for r in rows]


def feature_classes(profile: DataFrame, low_card: int = 20) -> DataFrame:
    """(FEATURE, CLASSE): cat_low, cat_high or num, from a ``metadata`` table."""
    text = F.col("TIPO_FEATURE").isin("string", "boolean")
    return profile.select(
        "FEATURE",
        F.when(text & (F.col("CARDINALIDADE") < low_card), "cat_low")
        .when(text, "cat_high")
        .otherwise("num")
        .alias("CLASSE"),
    )


def low_cardinality_features(df: DataFrame, cut: int, numeric_too: bool = False) -> list[str]:
    """Text columns with at most ``cut`` values (and numeric ones when asked), in column order."""
    kinds = (T.StringType, T.BooleanType) + ((T.NumericType,) if numeric_too else ())
    names = [f.name for f in df.schema if isinstance(f.dataType, kinds)]
    if not names:
        return []
    rows = feature_stats(df, names).where(F.col("cardinality") <= cut).collect()
    small = {r["feature"] for r in rows}
    return [n for n in names if n in small]


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the named columns that exist."""
    return df.drop(*[n for n in names if n in df.columns])


def rename_as_var(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Predictors renamed to VAR_1, VAR_2, ... and the table of old and new names."""
    names = {c: f"VAR_{i}" for i, c in enumerate((c for c in df.columns if c != target), 1)}
    table = df.sparkSession.createDataFrame(list(names.items()), "nome_original string, nome_novo string")
    return df.withColumnsRenamed(names), table


# Rows with the same leading digits that are few enough to be looked at one by one.
_FEW = 10_000


def sample_rows(df: DataFrame, key: list[str], n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows whose keys have the smallest seeded MD5: the same rows on every run.

    The last hash that belongs to the sample is found by counting leading digits, four at a time;
    then the rows are filtered by it.  Nothing is sorted but rows that share that one hash.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    hashes = df.select(digest.alias("h"))
    prefix, before = "", 0
    while True:
        own = hashes.where(F.col("h").startswith(prefix)) if prefix else hashes
        digits = len(prefix) + 4
        # At most 65536 rows.
        found = own.groupBy(F.substring("h", 1, digits).alias("lead")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(found, key=lambda r: r["lead"]):
            if before + r["n"] > n:
                break
            before += r["n"]
        else:
            return df if not prefix else df.where(F.substring(digest, 1, len(prefix)) <= prefix)
        prefix = r["lead"]
        if before == n:
            return df.where(F.substring(digest, 1, digits) < prefix)
        if r["n"] <= _FEW or digits == 32:
            break
    if digits < 32:
        same = [r["h"] for r in hashes.where(F.col("h").startswith(prefix)).collect()]
        last = sorted(same)[n - before - 1]
        before += sum(h < last for h in same)
        if before + same.count(last) == n:
            return df.where(digest <= last)
        prefix = last
    # Some of the rows of one key: those that come first by all their columns.
    tied = df.where(digest == prefix).orderBy(*df.columns).limit(n - before)
    return df.where(digest < prefix).unionByName(tied)


# The open value ranges a type must contain strictly.
_WHOLE_RANGES = (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63))
_FLOAT_MAX = 3.4028234663852886e38


def narrow_types(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cast every numeric column to the narrowest type that holds its values.

    All bounds come from one pass.  Returns the frame and (feature, old_type, new_type).
    """
    fields = [f for f in df.schema if isinstance(f.dataType, _WHOLE + _REAL)]
    chosen = {}
    if fields:
        row = df.agg(
            *[
                fn(nan_to_null(F.col(f.name), f.dataType)).alias(f"{k}{i}")
                for i, f in enumerate(fields)
                for k, fn in (("a", F.min), ("b", F.max))
            ]
        ).first()
        for i, f in enumerate(fields):
            low, high = row[f"a{i}"], row[f"b{i}"]
            if low is not None:
                chosen[f.name] = _narrowest(f.dataType, low, high)
    table = [(f.name, f.dataType.simpleString(), chosen.get(f.name, f.dataType.simpleString())) for f in df.schema]
    mapping = df.sparkSession.createDataFrame(table, "feature string, old_type string, new_type string")
    return df.select(*[F.col(c).cast(chosen[c]).alias(c) if c in chosen else F.col(c) for c in df.columns]), mapping


def _narrowest(dtype: T.DataType, low, high) -> str:
    if isinstance(dtype, _REAL):
        return "float" if -_FLOAT_MAX < low and high < _FLOAT_MAX else "double"
    for name, bits in _WHOLE_RANGES:
        if -(2**bits) < low and high < 2**bits - 1:
            return name
    return "bigint"


def normalize_types(df: DataFrame) -> DataFrame:
    """Small integers become int, single-precision reals stay float, everything else is kept."""
    small = (T.ByteType, T.ShortType)
    return df.select(
        *[F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, small) else F.col(f.name) for f in df.schema]
    )
