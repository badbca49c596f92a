"""Running totals over a global order, without sending every row to one task.

Rows are first summed to one row per distinct order value, which absorbs ties of any size on
the map side.  The order is then cut into ranges at edges held as literals; totals run inside a
range and the totals of the earlier ranges are added.  The edges only balance the ranges: the
result is exact whatever they are, and being literals they stay the same when a lost task is
computed again.

Ranges hold about ``RANGE_ROWS`` distinct values.  Where more than ``MAX_RANGES`` of them are needed,
each is cut again at edges of its own, kept in a small stored table, and the totals of earlier
ranges are summed on both levels: first inside a range, then over the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalars import count_below, double_array
from tidemark.session import materialize

# Distinct values aimed at per range, and the most ranges cut on one level.
RANGE_ROWS = 250_000
MAX_RANGES = 1024
# Sampled values per range of the second level.
SAMPLED = 8


def range_edges(df: DataFrame, order: str, range_rows: int | None = None) -> tuple[list, int, int]:
    """Inner edges of the first level, the number of ranges aimed at, and about how many distinct
    values there are."""
    text = df.schema[order].dataType.typeName() == "string"
    value = F.col(order) if text else F.col(order).cast("double")
    counts = [F.count(value).alias("n"), F.approx_count_distinct(value).alias("d")]
    if not text:
        probs = [i / MAX_RANGES for i in range(1, MAX_RANGES)]
        counts.append(F.percentile_approx(value, double_array(probs), 4 * MAX_RANGES).alias("q"))
    row = df.agg(*counts).first()
    distinct = min(row["n"], row["d"])
    ranges = -(-distinct // (range_rows or RANGE_ROWS))
    first = min(MAX_RANGES, ranges)
    if first <= 1:
        return [], 1, distinct
    if text:
        # The distinct values with the smallest hashes are an even sample of them.
        sample = df.select(order).distinct().orderBy(F.xxhash64(order)).limit(MAX_RANGES).collect()
        values = sorted(r[0] for r in sample)
        picked = [values[i * len(values) // first] for i in range(1, first)]
    else:
        picked = [row["q"][round(i * MAX_RANGES / first) - 1] for i in range(1, first)]
    return sorted(set(picked)), ranges, distinct


def _place(order: str, edges: list) -> Column:
    """Number of the range of the first level."""
    return count_below(F.col(order) if isinstance(edges[0], str) else F.col(order).cast("double"), edges)


def _inner_edges(df: DataFrame, order: str, edges: list, ranges: int, distinct: int) -> DataFrame:
    """(place, inner): for each range of the first level the edges that cut it again.

    They come from the distinct values with small hashes, an even sample of about ``SAMPLED`` per
    range.  The table has ``MAX_RANGES`` rows of as many values at most, and is stored, so that
    tasks computed again see the same edges.
    """
    per = min(MAX_RANGES, -(-ranges // (len(edges) + 1)))
    share = min(1.0, SAMPLED * per * (len(edges) + 1) / max(1, distinct))
    chosen = F.pmod(F.xxhash64(order), F.lit(1 << 30)) < int(share * (1 << 30))
    values = df.where(chosen).select(_place(order, edges).alias("place"), F.col(order).alias("value")).distinct()
    lists = values.groupBy("place").agg(F.array_sort(F.collect_list("value")).alias("values"))
    cuts = F.transform(
        F.sequence(F.lit(1), F.lit(per - 1)), lambda i: F.get("values", F.floor(i * F.size("values") / per).cast("int"))
    )
    return materialize(lists.select("place", F.array_distinct(cuts).alias("inner")))


def running_totals(
    df: DataFrame,
    order: str,
    measures: dict[str, Column],
    by: list[str] | None = None,
    descending: bool = True,
    range_rows: int | None = None,
) -> DataFrame:
    """One row per (by, distinct order value) with each measure ``m``, its running total
    ``cum_m`` up to and including the row, and its grand total ``tot_m``.

    Rows without an order value are left out.  Columns in ``by`` hold few distinct values.
    """
    by = by or []
    kept = df.where(F.col(order).isNotNull())
    edges, ranges, distinct = range_edges(kept, order, range_rows)
    sums = kept.groupBy(*by, order).agg(*[m.alias(k) for k, m in measures.items()])
    levels = ["_range"]
    sign = -1 if descending else 1
    if not edges:
        cut = sums.withColumn("_range", F.lit(0))
    elif ranges <= MAX_RANGES:
        cut = sums.withColumn("_range", sign * _place(order, edges))
    else:
        levels.append("_inner")
        inner = F.broadcast(_inner_edges(kept, order, edges, ranges, distinct))
        below = F.coalesce(F.size(F.filter("inner", lambda e: e < F.col(order))), F.lit(0))
        cut = sums.withColumn("place", _place(order, edges)).join(inner, "place", "left")
        cut = cut.withColumns({"_range": sign * F.col("place"), "_inner": sign * below}).drop("place", "inner")
    direction = F.col(order).desc() if descending else F.col(order).asc()
    inside = (
        Window.partitionBy(*by, *levels).orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    )
    if not edges:
        whole = Window.partitionBy(*by, "_range")
        return cut.select(
            "*",
            *[F.sum(k).over(inside).alias(f"cum_{k}") for k in measures],
            *[F.sum(k).over(whole).alias(f"tot_{k}") for k in measures],
        ).drop("_range")
    offsets = _offsets(cut, by, levels, list(measures))
    ran = cut.select("*", *[F.sum(k).over(inside).alias(f"_c_{k}") for k in measures])
    on = F.lit(True)
    for c in [*by, *levels]:
        on = on & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    # One row per group and range on the right.
    return ran.join(offsets, on).select(
        *by,
        order,
        *measures,
        *[(F.col(f"_c_{k}") + F.col(f"_o_{k}")).alias(f"cum_{k}") for k in measures],
        *[f"tot_{k}" for k in measures],
    )


def _offsets(cut: DataFrame, by: list[str], levels: list[str], measures: list[str]) -> DataFrame:
    """Totals before each range, and of everything, per group.

    Each level is summed inside the range of the level above, so no task sees more than
    ``MAX_RANGES`` rows of a group at once.
    """
    names = [*by, *levels]
    totals = cut.groupBy(*names).agg(*[F.sum(k).alias(f"_s_{k}") for k in measures])
    upper = totals.groupBy(*by, "_range").agg(*[F.sum(f"_s_{k}").alias(f"_s_{k}") for k in measures])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    upper = upper.select(
        *[F.col(b).alias(f"_at_{b}") for b in by],
        F.col("_range").alias("_at__range"),
        *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in measures],
        *[F.sum(f"_s_{k}").over(group).alias(f"tot_{k}") for k in measures],
    )
    if len(levels) == 1:
        return upper
    within = Window.partitionBy(*by, "_range").orderBy("_inner").rowsBetween(Window.unboundedPreceding, -1)
    lower = totals.select(
        *[F.col(c).alias(f"_lo_{c}") for c in names],
        *[F.coalesce(F.sum(f"_s_{k}").over(within), F.lit(0)).alias(f"_l_{k}") for k in measures],
    )
    on = F.lit(True)
    for c in [*by, "_range"]:
        on = on & F.col(f"_lo_{c}").eqNullSafe(F.col(f"_at_{c}"))
    return lower.join(upper, on).select(
        *[f"_at_{c}" for c in [*by, "_range"]],
        F.col("_lo__inner").alias("_at__inner"),
        *[(F.col(f"_o_{k}") + F.col(f"_l_{k}")).alias(f"_o_{k}") for k in measures],
        *[f"tot_{k}" for k in measures],
    )
