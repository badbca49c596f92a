"""Forward-looking inactivity label and the analytical base table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.book import BookTables, build_book
from tidemark.plans.spec import BookSpec


def monthly_activity(tables: BookTables, spec: BookSpec = BookSpec()) -> DataFrame:
    """Distinct (month start, entity) pairs with a delivered order."""
    rows = _active_rows(tables, spec)
    return rows.distinct().select("dt_venda", F.col("entity").alias(spec.entity))


def _active_rows(tables: BookTables, spec: BookSpec) -> DataFrame:
    c = F.col
    approved = c(spec.approved).cast("timestamp")
    orders = tables.orders.where((c(spec.status) == spec.status_value) & approved.isNotNull())
    month = F.trunc(approved, "MM").alias("dt_venda")
    if spec.entity_on == "orders":
        return orders.select(month, c(spec.entity).alias("entity")).where(c("entity").isNotNull())
    items = tables.items.where(c(spec.entity).isNotNull()).select(
        c(spec.order_id), c(spec.entity).alias("entity")
    )
    return orders.select(spec.order_id, month).join(items, spec.order_id).select("dt_venda", "entity")


def label_inactivity(
    book: DataFrame,
    tables: BookTables,
    spec: BookSpec = BookSpec(),
    horizon_months: int = 3,
    flag: str = "flag_churn_3m",
    null_entity: str = "drop",
) -> DataFrame:
    """Add ``flag``: 1 when the entity has no active month from dt_ref to dt_ref + horizon.

    Both ends of the horizon are included, so a month-start date looks at horizon + 1 months.
    The active months of an entity are one short array (never longer than the calendar), joined
    by equality, so no range join multiplies the rows of a busy entity.
    ``null_entity="drop"`` removes book rows without an entity; ``"parity"`` keeps them as
    rows that are NULL everywhere but in the flag.
    """
    if null_entity not in ("drop", "parity"):
        raise ValueError(f"unknown null_entity {null_entity!r}")
    c = F.col
    months = (
        _active_rows(tables, spec)
        .groupBy(c("entity").alias("_entity"))
        .agg(F.collect_set("dt_venda").alias("_months"))
    )
    known = c(spec.entity).isNotNull()
    rows = book.where(known) if null_entity == "drop" else book
    until = F.add_months(c("dt_ref"), horizon_months)
    active = F.exists("_months", lambda m: (m >= c("dt_ref")) & (m <= until))
    labelled = rows.join(months, c(spec.entity) == c("_entity"), "left").select(
        *book.columns, F.when(F.coalesce(active, F.lit(False)), 0).otherwise(1).alias(flag)
    )
    if null_entity == "drop":
        return labelled
    return labelled.select(*[F.when(known, c(x)).alias(x) for x in book.columns], flag)


def build_abt(
    tables: BookTables,
    dates: list[date],
    spec: BookSpec = BookSpec(),
    horizon_months: int = 3,
    null_entity: str = "drop",
) -> DataFrame:
    """Book plus inactivity flag."""
    book = build_book(tables, dates, spec, null_entity=null_entity == "parity")
    return label_inactivity(book, tables, spec, horizon_months, null_entity=null_entity)
