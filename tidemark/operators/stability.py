"""Behaviour of the target and of the score by vintage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import category_text
from tidemark.operators.evaluate import ks_percent


def rate_by_vintage(df: DataFrame, target: str, vintage: str) -> DataFrame:
    """(Safra, Taxa_de_Evento, Volume)."""
    return df.groupBy(F.col(vintage).cast("string").alias("Safra")).agg(
        F.avg(F.col(target).cast("double")).alias("Taxa_de_Evento"), F.count(F.lit(1)).alias("Volume")
    )


def rate_by_category(df: DataFrame, variable: str, target: str) -> DataFrame:
    """(variable, Taxa_de_Evento, Volume), highest rate first; numbers are rounded to four places."""
    text = category_text(F.col(variable), df.schema[variable].dataType)
    return (
        df.where(F.col(variable).isNotNull())
        .groupBy(text.alias(variable))
        .agg(F.avg(F.col(target).cast("double")).alias("Taxa_de_Evento"), F.count(F.lit(1)).alias("Volume"))
        .orderBy(F.col("Taxa_de_Evento").desc(), variable)
    )


def rate_by_vintage_category(df: DataFrame, target: str, variable: str, vintage: str) -> DataFrame:
    """(vintage, variable, Taxa_de_Evento, Volume, Volume_Safra): rate per category over time."""
    text = category_text(F.col(variable), df.schema[variable].dataType)
    cells = (
        df.where(F.col(variable).isNotNull())
        .groupBy(F.col(vintage), text.alias(variable))
        .agg(F.avg(F.col(target).cast("double")).alias("Taxa_de_Evento"), F.count(F.lit(1)).alias("Volume"))
    )
    totals = cells.groupBy(F.col(vintage).alias("_v")).agg(F.sum("Volume").alias("Volume_Safra"))
    return cells.join(totals, F.col(vintage) == F.col("_v")).drop("_v")


def ks_gini_by_vintage(df: DataFrame, target: str, score: str, vintage: str) -> DataFrame:
    """(vintage, KS, Gini) in percent, all vintages in one job."""
    return ks_percent(df, score, target, [vintage])
