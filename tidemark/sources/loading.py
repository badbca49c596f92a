"""Read the raw delimited files and land them as typed Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.dedupe import keep_first
from tidemark.session import materialize
from tidemark.sources.schemas import PRIMARY_KEYS, SCHEMAS


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    """One raw file (or folder of files) with the declared types.

    Comment columns hold line breaks and doubled quotes, hence the multi-line reader; split
    large extracts into many files, since one such file is read by one task.
    """
    return (
        spark.read.schema(SCHEMAS[table])
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project a frame onto the declared columns and types; absent columns are an error."""
    missing = [f.name for f in SCHEMAS[table] if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])


def first_per_key(df: DataFrame, table: str) -> DataFrame:
    """Keep the first row, in file order, of every declared key."""
    key = PRIMARY_KEYS.get(table)
    if key is None:
        return df
    columns = df.columns
    numbered = df.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_line"),
    )
    # A multi-line file is one task, so the running id follows line order inside each file.
    return keep_first(numbered, [key], ["_file", "_line"]).select(*columns)


def load_table(spark: SparkSession, table: str, raw_path: str, out_path: str) -> DataFrame:
    """Raw file -> deduplicated Parquet table (drop and recreate)."""
    first_per_key(read_raw(spark, table, raw_path), table).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def append_table(spark: SparkSession, table: str, raw_path: str, out_path: str) -> DataFrame:
    """Append a raw file's rows to a landed table; rows whose key it already holds are left out."""
    new = first_per_key(read_raw(spark, table, raw_path), table)
    key = PRIMARY_KEYS.get(table)
    if key is not None:
        new = new.join(spark.read.parquet(out_path).select(key), key, "left_anti")
    # Stored first: the same table is read and written.
    materialize(new.select(*SCHEMAS[table].names)).write.mode("append").parquet(out_path)
    return spark.read.parquet(out_path)


def load_all(spark: SparkSession, raw: dict[str, str], root: str) -> dict[str, DataFrame]:
    """Load every given table and return the landed frames."""
    return {t: load_table(spark, t, path, f"{root}/{t}") for t, path in raw.items()}


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for each table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
