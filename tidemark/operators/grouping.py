"""Regroup categories and apply a saved regrouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import category_text, recode


def regroup(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Distinct (TFB_column, column) pairs under ``mapping``; unlisted values keep their name."""
    text = category_text(F.col(column), df.schema[column].dataType)
    values = df.select(text.alias(column)).where(F.col(column).isNotNull()).distinct()
    return values.select(recode(F.col(column), mapping).alias(f"TFB_{column}"), column)


def apply_grouping(df: DataFrame, groups: DataFrame, column: str, unmapped: str = "null") -> DataFrame:
    """Replace ``column`` by ``TFB_column`` from a regrouping.

    Values outside the regrouping become NULL, or keep their own name with ``unmapped="keep"``.
    """
    if unmapped not in ("null", "keep"):
        raise ValueError(f"unknown unmapped {unmapped!r}")
    name = f"TFB_{column}"
    text = category_text(F.col(column), df.schema[column].dataType)
    keyed = df.withColumn("_key", text)
    lookup = groups.select(F.col(column).alias("_lookup"), name)
    joined = keyed.join(lookup, F.col("_key") == F.col("_lookup"), "left")
    if unmapped == "keep":
        joined = joined.withColumn(name, F.coalesce(name, "_key"))
    return joined.drop(column, "_key", "_lookup")
