"""Session settings the library relies on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Stored timestamps carry no zone; one fixed zone makes day arithmetic repeatable.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash instead of sort where every partition of a join's build side has been measured small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Texts are long: small batches bound the memory of Python workers and of what feeds them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16MB",
    # Split a hot join key even when that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Rows of the book are many times larger in memory than in a shuffle, so its tasks take small shares
# of one: many partitions, of which adaptive execution joins those that are smaller than the share.
WIDE_ROWS_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
    # The JVM never compiles methods beyond this size; generated code of so many columns is split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def configure_wide(spark: SparkSession) -> SparkSession:
    """``configure`` for books and base tables: the memory of a task does not grow with the tables.

    A larger ``spark.sql.shuffle.partitions`` stays in force.
    """
    configure(spark)
    for key, value in WIDE_ROWS_CONF.items():
        if key.endswith("Num"):
            value = str(max(int(value), int(spark.conf.get("spark.sql.shuffle.partitions"))))
        spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of every job inside as soon as it has ended, so that they do not add up on disk.

    Meant for jobs that write a frame once; a frame that is computed again shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``; where that is unset, one in the
    warehouse, unless that is a folder of the driver's machine and executors run on others."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if (warehouse.startswith("file:") or "://" not in warehouse) and not sc.master.startswith("local"):
            default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
            if warehouse.startswith("file:") or default.startswith("file:"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"{warehouse}/checkpoints"
    sc.setCheckpointDir(shared)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    For frames that several jobs read: they stay columnar, can be pruned, and a lost executor
    costs a read instead of the whole lineage.
    """
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shared_path(spark: SparkSession) -> str:
    """A new path below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tidemark-{uuid.uuid4().hex}"
