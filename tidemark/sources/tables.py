"""Vintage tables: Parquet folders partitioned by reference date."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_vintages(df: DataFrame, path: str, date_col: str = "dt_ref", mode: str = "replace") -> None:
    """Write the vintages held in ``df``.

    ``replace`` overwrites only the dates present in ``df``, so a re-run leaves the row count
    unchanged; ``append`` adds the rows again, whatever is already there.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    # Rebalancing splits a large date over several writers and spares small ones tiny files.
    writer = df.hint("rebalance", F.col(date_col)).write.partitionBy(date_col)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def read_vintages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_vintage(df: DataFrame, date_col: str = "dt_ref") -> DataFrame:
    """Rows of the newest reference date.

    The date is a scalar subquery, which prunes partitions when the table has them.
    """
    newest = df.select(F.max(date_col).alias("newest")).scalar()
    return df.where(F.col(date_col) == newest)


def append_scores(df: DataFrame, path: str, date_col: str = "dt_ref", run: str | None = None) -> None:
    """Add the scores of a run; a run that is repeated under the same name replaces its rows.

    The writer stages the files and moves them when all are complete, so a run that fails leaves
    nothing behind.
    """
    named = df.withColumn("run", F.lit(run or uuid.uuid4().hex))
    writer = named.write.partitionBy(date_col, "run").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def next_version(spark: SparkSession, registry: str) -> int:
    """One more than the newest version listed in the registry table."""
    return (latest_version(spark, registry) or 0) + 1


def claim_version(spark: SparkSession, registry: str) -> int:
    """A version number that no other training gets: its file is created, or exists already."""
    version = next_version(spark, registry)
    while True:
        claim = spark._jvm.org.apache.hadoop.fs.Path(f"{registry}_claims/v{version}")
        files = claim.getFileSystem(spark._jsc.hadoopConfiguration())
        try:
            files.create(claim, False).close()
            return version
        except Py4JJavaError as error:
            if not files.exists(claim):
                raise error
        version += 1


def latest_version(spark: SparkSession, registry: str, where: Column | None = None) -> int | None:
    """Newest version in the registry table, None while there is none."""
    if not path_exists(spark, registry):
        return None
    listed = spark.read.parquet(registry)
    if where is not None:
        listed = listed.where(where)
    return listed.agg(F.max("version")).first()[0]


def register_version(spark: SparkSession, registry: str, version: int, model_path: str) -> None:
    row = spark.range(1).select(
        F.lit(version).cast("int").alias("version"),
        F.lit(model_path).alias("path"),
        F.current_timestamp().alias("registered_at"),
    )
    row.write.mode("append").parquet(registry)


def log_metrics(metrics: DataFrame, path: str, run_id: str, split_col: str = "split") -> None:
    """Append a wide metric table as (run_id, split, metric, value) rows."""
    values = [
        f.name for f in metrics.schema if f.name != split_col and f.dataType.typeName() in ("double", "long", "integer")
    ]
    tall = metrics.select(
        split_col, *[F.col(v).cast("double").alias(v) for v in values]
    ).unpivot([split_col], values, "metric", "value")
    tall.select(F.lit(run_id).alias("run_id"), F.col(split_col).alias("split"), "metric", "value").write.mode(
        "append"
    ).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, sort: list[str] | None = None) -> DataFrame:
    """Write a catalog table cut into ``buckets`` by the hash of ``key``, one file each, and read it back.

    Tables cut in the same way are joined and grouped on the key without a shuffle.  ``sort`` orders
    the rows of a file, so that its row groups can be skipped by the first of these columns.
    """
    order = sort or [key]
    placed = df.repartition(buckets, key).sortWithinPartitions(*order)
    writer = placed.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key)
    writer.sortBy(*order).saveAsTable(name)
    return df.sparkSession.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
