"""Column expressions and helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.

    ``lower`` does just that on a text without other letters, and is several times faster than
    ``translate``.
    """
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words, 0 where the text is NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def code_point_key(value: Column) -> Column:
    """A non-NULL string that sorts like ``value`` by code point, with NULL last."""
    return F.when(value.isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), value.cast("string")))


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def rows_without(docs: DataFrame, keys: list[Column], listed: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` are no row of ``listed``; NULL equals NULL.

    Each row travels as one struct, so its columns may have any names.
    """
    left = docs.select(F.struct(*docs.columns).alias("row"), *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    right = listed.toDF(*[f"l{i}" for i in range(len(keys))])
    on = F.lit(True)
    for i in range(len(keys)):
        on = on & F.col(f"k{i}").eqNullSafe(F.col(f"l{i}"))
    kept = left.join(right, on, "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
