"""Jobs that materialise vintages: the book, then the base table."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.book import BookTables, build_book, first_sales
from tidemark.plans.label import label_inactivity
from tidemark.plans.spec import BookSpec, shift_months
from tidemark.session import shuffles_removed
from tidemark.sources.tables import path_exists, read_vintages, write_bucketed, write_vintages


def book_job(
    tables: BookTables,
    dates: list[date],
    path: str,
    spec: BookSpec = BookSpec(),
    mode: str = "replace",
    fanout: str = "reference",
) -> DataFrame:
    """Build the book of the given dates, write their partitions and return the whole table.

    Two jobs, one up to the sums per segment and one that expands them; neither leaves its shuffles behind.
    """
    spark = tables.orders.sparkSession
    with shuffles_removed(spark):
        write_vintages(build_book(tables, dates, spec, fanout, stored=True), path, mode=mode)
    return read_vintages(spark, path)


def store_tables(
    tables: BookTables, path: str, spec: BookSpec = BookSpec(), buckets: int = 200, prefix: str = "book"
) -> BookTables:
    """Write orders, items and reviews as catalog tables in buckets of the order id, and return those.

    A book over them shuffles nothing to bring orders, items and reviews together.  Items and
    reviews get their order's approval time, and all files are sorted by it, so that a build of
    recent vintages skips the row groups of earlier orders in all three.
    """

    def written(name: str, frame: DataFrame) -> DataFrame:
        order = [spec.approved, spec.order_id]
        return write_bucketed(frame, f"{prefix}_{name}", f"{path}/{name}", spec.order_id, buckets, order)

    orders = written("orders", tables.orders)
    # From the stored orders, so that the frame they came from is computed once.
    approved = orders.select(spec.order_id, spec.approved)

    def dated(df: DataFrame) -> DataFrame:
        return df if spec.approved in df.columns else df.join(approved, spec.order_id, "left")

    stored = {
        "orders": orders,
        "items": written("items", dated(tables.items)),
        "reviews": written("reviews", dated(tables.reviews)),
    }
    return replace(tables, **stored)


def book_increment_job(
    tables: BookTables,
    dates: list[date],
    path: str,
    state: str,
    spec: BookSpec = BookSpec(),
    fanout: str = "reference",
) -> DataFrame:
    """Add vintages to a stored book without reading the orders of the whole history.

    ``state`` holds each entity's first sale before the days of earlier runs (partitions
    ``through``).  The newest of these up to the first date, and the orders since then or since the
    windows' start, make the vintages; then the first sales before the last date are stored as
    well.  Without a state all orders are read.  Runs may be repeated: they replace their vintages
    and their state.  Orders that arrive later with an approval before a stored day are not
    seen by that day's state; build those vintages with ``book_job``.
    """
    spark = tables.orders.sparkSession
    first, last = min(dates), max(dates)
    known, through = None, None
    if path_exists(spark, state):
        kept = spark.read.parquet(state).where(F.col("through") <= first)
        through = kept.agg(F.max("through")).first()[0]
    if through is not None:
        known = spark.read.parquet(f"{state}/through={through.isoformat()}")
    window = shift_months(first, -spec.window_months)
    since = None if known is None else min(through, window)
    write_vintages(build_book(tables, dates, spec, fanout, first_sales=known, since=since), path)
    sales = first_sales(tables, spec, last, through)
    if known is not None:
        sales = sales.unionByName(known).groupBy("entity").agg(F.min("first_at").alias("first_at"))
    if through != last:  # that state is the one just read
        sales.write.mode("overwrite").parquet(f"{state}/through={last.isoformat()}")
    return read_vintages(spark, path)


def abt_job(
    spark: SparkSession,
    tables: BookTables,
    book_path: str,
    path: str,
    spec: BookSpec = BookSpec(),
    dates: list[date] | None = None,
    mode: str = "replace",
    null_entity: str = "drop",
) -> DataFrame:
    """Label the stored book, all of it or some of its dates, and write the base table."""
    book = read_vintages(spark, book_path)
    if dates is not None:
        # Prunes the partitions that are read.
        book = book.where(F.col("dt_ref").isin(dates))
    with shuffles_removed(spark):
        write_vintages(label_inactivity(book, tables, spec, null_entity=null_entity), path, mode=mode)
    return read_vintages(spark, path)
