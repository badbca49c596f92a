"""Column expressions whose null, division and rounding rules matter to the results."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F, types as T

# Above this many thresholds a comparison chain is replaced by a two-level array search.
_CHAIN_LIMIT = 24


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0).cast("bigint"))


def whole_ratio(numerator: Column, denominator: Column) -> Column:
    """Truncating integer division that gives NULL for a zero denominator."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0).cast("bigint")))


def strict_least(*cols: Column) -> Column:
    """Smallest argument, NULL when any argument is NULL."""
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cols))


def nan_to_null(col: Column, dtype: T.DataType) -> Column:
    """Floating NaN counts as missing, as it does for the null statistics."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def sentinel_to_null(col: Column, sentinels: list[float]) -> Column:
    """Replace agreed stand-ins for "missing" by NULL."""
    return F.when(~col.isin(sentinels), col)


def category_text(col: Column, dtype: T.DataType) -> Column:
    """Category label of a value: numbers are rounded half-even to four places first."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.bround(col.cast("double"), 4).cast("string")
    return col.cast("string")


def recode(col: Column, mapping: dict) -> Column:
    """Look a value up in a mapping and keep it when it is not listed."""
    if not mapping:
        return col
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def double_array(values: list[float]) -> Column:
    """Literal array of doubles, parsed in one go."""
    return F.expr("array(" + ", ".join(f"CAST('{v!r}' AS DOUBLE)" for v in values) + ")")


def literal_array(values: list) -> Column:
    """Literal array of numbers or texts."""
    if values and isinstance(values[0], str):
        return F.array(*[F.lit(v) for v in values])
    return double_array(values)


def count_below(col: Column, thresholds: list, inclusive: bool = False) -> Column:
    """How many of the sorted ``thresholds`` lie below ``col`` (at or below when inclusive).

    Short lists become a chain of comparisons inside generated code; long ones are searched
    block by block so the cost per row grows with the square root of the list.
    """
    if not thresholds:
        return F.when(col.isNotNull(), F.lit(0))

    def chain(edges):
        hits = [(col >= F.lit(e)) if inclusive else (col > F.lit(e)) for e in edges]
        return reduce(add, [h.cast("int") for h in hits])

    def hits_in(array):
        return F.size(F.filter(array, lambda e: (e <= col) if inclusive else (e < col)))

    if len(thresholds) <= _CHAIN_LIMIT:
        return chain(thresholds)
    width = int(len(thresholds) ** 0.5) + 1
    blocks = [thresholds[i : i + width] for i in range(0, len(thresholds), width)]
    full = hits_in(literal_array([b[-1] for b in blocks]))
    nothing = F.slice(literal_array(blocks[0]), 1, 0)
    rest = F.coalesce(F.get(F.array(*[literal_array(b) for b in blocks]), full), nothing)
    # The last block may be short, so a value above everything must not count past the list.
    return F.when(col.isNotNull(), F.least(full * width + hits_in(rest), F.lit(len(thresholds))))
