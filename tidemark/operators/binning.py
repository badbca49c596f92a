"""Quantile and equal-width bins with right-closed intervals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalars import count_below, double_array
from tidemark.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Bins:
    """Fitted edges of one column: bins (e0, e1], (e1, e2], ...; the first one is closed below."""

    edges: tuple[float, ...]

    @property
    def count(self) -> int:
        return max(len(self.edges) - 1, 0)

    def index(self, col: Column) -> Column:
        """0-based bin; NULL for a missing value, or when the column had one value only."""
        if not self.count:
            return F.lit(None).cast("int")
        x = _clean(col)
        return F.when(x.isNotNull(), count_below(x, list(self.edges[1:-1])))

    def bounds(self, col: Column) -> Column:
        """Struct (bin, lo, hi)."""
        i = self.index(col)
        if not self.count:
            return F.struct(
                i.alias("bin"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi")
            )
        edges = double_array(list(self.edges))
        return F.struct(i.alias("bin"), F.get(edges, i).alias("lo"), F.get(edges, i + 1).alias("hi"))

    def label(self, col: Column) -> Column:
        """Text ``(lo, hi]``."""
        b = self.bounds(col)
        text = F.concat(F.lit("("), b["lo"].cast("string"), F.lit(", "), b["hi"].cast("string"), F.lit("]"))
        return F.when(b["bin"].isNotNull(), text)


def _clean(col: Column) -> Column:
    x = col.cast("double")
    return F.when(~F.isnan(x), x)


def quantile_bins(
    df: DataFrame,
    columns: list[str] | dict[str, Column],
    q: int = 10,
    duplicates: str = "drop",
    **quantile_options,
) -> dict[str, Bins]:
    """Edges at the q-quantiles of every column, equal edges merged or refused."""
    found = exact_quantiles(df, columns, [i / q for i in range(q + 1)], **quantile_options)
    out = {}
    for name, values in found.items():
        edges = sorted(set(values or []))
        if duplicates == "raise" and values and len(edges) < len(values):
            raise ValueError(f"{name}: quantile edges are not distinct")
        out[name] = Bins(tuple(edges) if len(edges) > 1 else ())
    return out


def width_bins(df: DataFrame, columns: list[str] | dict[str, Column], bins: int | dict[str, int] = 10) -> dict[str, Bins]:
    """Equal-width edges between the smallest and largest value of every column.

    The lowest edge is moved down by 0.1 % of the range so that the minimum is inside; a
    constant column is widened by 0.1 % of its size on both sides.
    """
    exprs = {n: F.col(n) for n in columns} if isinstance(columns, list) else dict(columns)
    if not exprs:
        return {}
    row = df.agg(
        *[f(_clean(e)).alias(f"{k}{i}") for i, e in enumerate(exprs.values()) for k, f in (("a", F.min), ("b", F.max))]
    ).first()
    out = {}
    for i, name in enumerate(exprs):
        n = bins if isinstance(bins, int) else bins[name]
        out[name] = Bins(_spaced(row[f"a{i}"], row[f"b{i}"], n))
    return out


def _spaced(low: float | None, high: float | None, n: int) -> tuple[float, ...]:
    if low is None:
        return ()
    if low == high:
        pad = 0.001 * abs(low) if low else 0.001
        return tuple(linspace(low - pad, high + pad, n))
    edges = linspace(low, high, n)
    edges[0] -= 0.001 * (high - low)
    return tuple(edges)


def linspace(low: float, high: float, n: int) -> list[float]:
    """n + 1 evenly spaced points."""
    step = (high - low) / n
    return [i * step + low for i in range(n)] + [high]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    kinds = (T.StringType, T.BooleanType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in exclude]


def categorize_numeric(
    df: DataFrame, bins: int = 10, prefix: str = "BIN_", target: str | None = None
) -> DataFrame:
    """Every numeric column but the target becomes a (bin, lo, hi) column named prefix + name.

    Columns whose quantiles give no interval (all equal) get equal-width bins.
    """
    numbers = numeric_columns(df, (target,) if target else ())
    fitted = quantile_bins(df, numbers, bins)
    flat = [c for c in numbers if len(fitted[c].edges) < 2]
    if flat:
        fitted |= width_bins(df, flat, bins)
    return df.select(
        *[fitted[c].bounds(F.col(c)).alias(prefix + c) if c in fitted else F.col(c) for c in df.columns]
    )
