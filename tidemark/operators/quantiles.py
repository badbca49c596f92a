"""Exact quantiles of many columns without gathering any column in one task.

``percentile`` keeps one counter per distinct value in a single aggregation buffer, so it is
used only where the number of distinct values has been checked to be small.  Any other column
is narrowed down: a mergeable KLL sketch brackets each wanted rank, one pass counts how many values
lie below and inside the bracket, and the bracket shrinks until the values left inside fit the
checked bound.  Each pass is one map-side-combined scan and nothing is shuffled by value.  The
first sketches are taken in the pass that counts the columns, unless there are very many of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalars import double_array

# Distinct values that may sit in one aggregation buffer.
SMALL_DISTINCT = 100_000
# Size of a sketch (some 80 kB) and the rank error to allow for on either side of a wanted rank.
_SKETCH = 4096
_SLACK = 0.0015
# Columns that are sketched in the first pass.
_EARLY = 64
_HLL_ERROR = 0.05
_BATCH = 16


@dataclass
class _Rank:
    """One wanted 0-based rank and the values that may hold it."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int
    value: float | None = None


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column] | list[str],
    probs: list[float],
    small_distinct: int = SMALL_DISTINCT,
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles of every column; None for a column without values."""
    exprs = {n: F.col(n) for n in columns} if isinstance(columns, list) else dict(columns)
    if not exprs:
        return {}
    names = list(exprs)
    aliases = {n: f"_q{i}" for i, n in enumerate(names)}
    values = df.select(*[_clean(exprs[n]).alias(aliases[n]) for n in names])
    measures = dict(_MEASURES)
    if len(names) <= _EARLY:
        asked = [q for p in probs for q in (max(0.0, p - _SLACK), min(1.0, p + _SLACK))]
        measures["sketched"] = lambda c: _sketched(c, asked)
    row = values.agg(*[f(F.col(a)).alias(f"{a}_{k}") for a in aliases.values() for k, f in measures.items()]).first()
    sized = {n: {k: row[f"{aliases[n]}_{k}"] for k in measures} for n in names}
    filled = [n for n in names if sized[n]["n"]]
    small = [n for n in filled if _distinct_bound(sized[n]) <= small_distinct]
    large = [n for n in filled if n not in small]
    out: dict[str, list[float] | None] = {n: None for n in names}
    for part in _batches(small):
        got = values.agg(
            *[F.percentile(aliases[n], double_array(list(probs))).alias(aliases[n]) for n in part]
        ).first()
        out.update({n: list(got[aliases[n]]) for n in part})
    for part in _batches(large):
        out.update(_narrow(values, {n: aliases[n] for n in part}, sized, probs, small_distinct))
    return out


def filled_quantiles(
    df: DataFrame, columns: dict[str, Column], fill: float, probs: list[float], small_distinct: int = SMALL_DISTINCT
) -> dict[str, tuple[float, list[float]] | None]:
    """Quantile ``fill`` of every column, and its quantiles ``probs`` once missing values are replaced by it.

    Filling only shifts ranks: below the filled value they stay, above it they move by the number of
    missing values, and between it is the value itself.  So all come from ranks of the values as they are.
    """
    if not columns:
        return {}
    aliases = {n: f"_q{i}" for i, n in enumerate(columns)}
    values = df.select(*[_clean(x).alias(aliases[n]) for n, x in columns.items()])
    row = values.agg(
        F.count(F.lit(1)).alias("rows"), *[f(F.col(a)).alias(f"{a}_{k}") for a in aliases.values() for k, f in _MEASURES.items()]
    ).first()
    rows = row["rows"]
    sized = {n: {k: row[f"{a}_{k}"] for k in _MEASURES} for n, a in aliases.items()}
    filled = [n for n in columns if sized[n]["n"]]
    wanted = {n: _ranks_of_filled(sized[n]["n"], rows, fill, probs) for n in filled}
    small = [n for n in filled if _distinct_bound(sized[n]) <= small_distinct]
    found = _counted(values, {n: aliases[n] for n in small}, wanted)
    for part in _batches([n for n in filled if n not in small]):
        found.update(_at_ranks(values, {n: aliases[n] for n in part}, sized, wanted, small_distinct))
    out: dict[str, tuple[float, list[float]] | None] = {n: None for n in columns}
    for n in filled:
        count, missing = sized[n]["n"], rows - sized[n]["n"]
        middle = _between(fill * (count - 1), lambda r: found[n, r])

        def value(r: int) -> float:
            low, high = found.get((n, r)), found.get((n, r - missing))
            if low is not None and low < middle:
                return low
            return high if high is not None and high > middle else middle

        out[n] = middle, [_between(p * (rows - 1), value) for p in probs]
    return out


def _ranks_of_filled(count: int, rows: int, fill: float, probs: list[float]) -> list[int]:
    """Ranks among ``count`` values that settle the quantiles of all ``rows`` once the missing are filled."""
    at, missing = fill * (count - 1), rows - count
    ranks = {math.floor(at), math.ceil(at)}
    for p in probs:
        for r in (math.floor(p * (rows - 1)), math.ceil(p * (rows - 1))):
            # Only values before the upper neighbour can be smaller, only those behind the lower one larger.
            ranks |= {r} if r < math.ceil(at) else set()
            ranks |= {r - missing} if r - missing > math.floor(at) else set()
    return sorted(ranks)


def _between(at: float, value) -> float:
    """Value at a fractional rank, with the weights of the built-in aggregate for the two neighbours."""
    k = math.floor(at)
    a, b = value(k), value(math.ceil(at))
    return a if a == b else (k + 1 - at) * a + (at - k) * b


def _counted(values: DataFrame, aliases: dict[str, str], wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """Values at ranks of columns with few distinct values, from the running totals of their counts."""
    if not aliases:
        return {}
    tall = values.unpivot([], list(aliases.values()), "column", "value").where(F.col("value").isNotNull())
    counts = tall.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # At most ``small_distinct`` rows of a column.
    upto = F.sum("n").over(Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranks = F.create_map(*[x for n, a in aliases.items() for x in (F.lit(a), F.expr(f"array({', '.join(f'{r}L' for r in wanted[n])})"))])
    hits = F.filter(F.element_at(ranks, F.col("column")), lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    got = counts.withColumn("upto", upto).select("column", "value", F.explode(hits).alias("rank")).collect()
    names = {a: n for n, a in aliases.items()}
    return {(names[r["column"]], r["rank"]): r["value"] for r in got}


def _batches(names: list[str]) -> list[list[str]]:
    """Few enough columns at a time that their buffers fit one task together."""
    return [names[i : i + _BATCH] for i in range(0, len(names), _BATCH)]


_MEASURES = {
    "n": F.count,
    "lo": F.min,
    "hi": F.max,
    "d": lambda c: F.approx_count_distinct(c, _HLL_ERROR),
}


def _sketched(x: Column, shares: list[float]) -> Column:
    """Values at about these shares of the column; NULL where it has none."""
    sketch = F.kll_sketch_agg_double(x, F.lit(_SKETCH))
    return F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(sketch, double_array(shares)))


def _distinct_bound(stats: dict) -> float:
    """Distinct count allowing for the estimate's error."""
    return min(stats["n"], stats["d"] * (1 + 4 * _HLL_ERROR) + 1)


def _clean(col: Column) -> Column:
    x = col.cast("double")
    return F.when(~F.isnan(x), x)


def _narrow(values, aliases, sized, probs, bound):
    wanted = {n: [k for p in probs for k in (math.floor(p * (sized[n]["n"] - 1)), math.ceil(p * (sized[n]["n"] - 1)))] for n in aliases}
    found = _at_ranks(values, aliases, sized, wanted, bound, probs)
    return {n: [_between(p * (sized[n]["n"] - 1), lambda r: found[n, r]) for p in probs] for n in aliases}


def _at_ranks(values, aliases, sized, wanted, bound, probs=None) -> dict[tuple[str, int], float]:
    """Values at the wanted ranks of each column; ``probs`` are those of the sketches, where there are any."""
    ranks: dict[tuple[str, int], _Rank] = {}
    for n in aliases:
        s = sized[n]
        for k in wanted[n]:
            ranks.setdefault((n, k), _Rank(n, k, s["lo"], s["hi"], 0, s["n"]))
    pending = list(ranks.values())
    guess = None
    if probs and all(sized[n].get("sketched") for n in aliases):
        guess = {}
        for i, r in enumerate(pending):
            near = min(range(len(probs)), key=lambda j: abs(probs[j] * (sized[r.column]["n"] - 1) - r.rank))
            guess[i] = sized[r.column]["sketched"][2 * near : 2 * near + 2]
    while pending:
        pending, guess = _shrink(values, aliases, pending, bound, guess), None
    _pick(values, aliases, [r for r in ranks.values() if r.value is None])
    return {k: r.value for k, r in ranks.items()}


def _in(x: Column, r: _Rank) -> Column:
    return (x >= F.lit(r.low)) & (x <= F.lit(r.high))


def _guesses(values, aliases, pending) -> dict[int, list[float]]:
    """A narrower bracket for each rank, from a sketch of the values in its present one."""
    brackets: dict[tuple, list[int]] = {}
    for i, r in enumerate(pending):
        brackets.setdefault((r.column, r.low, r.high), []).append(i)
    sketches = []
    for j, members in enumerate(brackets.values()):
        asked = []
        for i in members:
            r = pending[i]
            local = r.rank - r.below
            asked += [max(0.0, local / r.inside - _SLACK), min(1.0, (local + 1) / r.inside + _SLACK)]
        x = F.col(aliases[pending[members[0]].column])
        sketches.append(_sketched(F.when(_in(x, pending[members[0]]), x), asked).alias(f"s{j}"))
    row = values.agg(*sketches).first()
    return {
        i: row[f"s{j}"][2 * k : 2 * k + 2] for j, members in enumerate(brackets.values()) for k, i in enumerate(members)
    }


def _shrink(values, aliases, pending, bound, guess=None):
    """Shrink every bracket once; return those still too wide."""
    guess = guess or _guesses(values, aliases, pending)
    counts = []
    for i, r in enumerate(pending):
        x = F.col(aliases[r.column])
        lo, hi = guess[i]
        counts += [
            F.count_if(x < F.lit(lo)).alias(f"b{i}"),
            F.count_if((x >= F.lit(lo)) & (x <= F.lit(hi))).alias(f"m{i}"),
        ]
    seen = values.agg(*counts).first()
    left = []
    for i, r in enumerate(pending):
        lo, hi = guess[i]
        below, inside = seen[f"b{i}"], seen[f"m{i}"]
        shrunk = below <= r.rank < below + inside and (lo > r.low or hi < r.high)
        if shrunk:
            r.low, r.high, r.below, r.inside = lo, hi, below, inside
            held = inside
        elif below > r.rank:
            # The sketch overshot: the rank lies under its lower guess.
            r.high, r.inside = math.nextafter(lo, -math.inf), below - r.below
            held = math.inf
        elif below + inside <= r.rank:
            r.low, r.inside, r.below = math.nextafter(hi, math.inf), r.inside - (below + inside - r.below), below + inside
            held = math.inf
        else:
            held = inside
            if held > bound:
                # No progress by sketch: halve the value range, keeping the count exact later.
                r.high, r.low, held = *_halve(values, aliases, r), math.inf
        if r.low == r.high:
            r.value = r.low
        elif held > bound:
            left.append(r)
    return left


def _halve(values, aliases, r: _Rank):
    x, mid = F.col(aliases[r.column]), r.low + (r.high - r.low) / 2
    upto = values.agg(F.count_if(x <= F.lit(mid)).alias("n")).first()["n"]
    if upto > r.rank:
        r.inside = upto - r.below
        return mid, r.low
    r.inside, r.below = r.below + r.inside - upto, upto
    return r.high, math.nextafter(mid, math.inf)


def _pick(values, aliases, ranks: list[_Rank]) -> None:
    """Read the wanted rank out of each bracket, whose distinct values fit one buffer."""
    if not ranks:
        return
    picks = []
    for i, r in enumerate(ranks):
        # Half a rank of slack on both sides keeps rounding away from the neighbours.
        share, x = (r.rank - r.below + 0.5) / r.inside, aliases[r.column]
        picks.append(
            F.expr(
                f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY {x})"
                f" FILTER (WHERE {x} >= CAST('{r.low!r}' AS DOUBLE) AND {x} <= CAST('{r.high!r}' AS DOUBLE))"
            ).alias(f"v{i}")
        )
    got = values.agg(*picks).first()
    for i, r in enumerate(ranks):
        r.value = got[f"v{i}"]


def group_quantiles(
    df: DataFrame, value: str, group: str, groups: list, probs: list[float], **kw
) -> dict:
    """Exact quantiles of one column within each of a few known groups."""
    columns = {str(i): F.when(F.col(group) == F.lit(g), F.col(value)) for i, g in enumerate(groups)}
    got = exact_quantiles(df, columns, probs, **kw)
    return {g: got[str(i)] for i, g in enumerate(groups)}
