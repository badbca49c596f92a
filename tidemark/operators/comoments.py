"""Co-moments of all pairs of columns over the rows where both have a value, in one pass.

A task turns its rows into matrix products: with Z the values (0 where missing) and M their
presence, M'M counts, Z'M sums and Z'Z and (Z*Z)'M multiply, for every pair at once.  Values are taken
relative to the first one the task sees, and results of tasks are merged about their means, so
large offsets cost no digits.  Merging is dealt out by column.

Functions of this module run inside Python workers and are shipped with the job.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns on either side of a block of pairs; a task holds four matrices of this size.
TILE = 1024
# Share of the squares below which what is left about the mean is rounding.
_ROUNDING = 1e-13
# Relative rounding of a mean, with room to spare.
_MEANS = 1e-14
_PARTS = ("n", "mean_x", "mean_y", "xy", "xx", "yy")
_SCHEMA = "place bigint, row int, " + ", ".join(f"{p} array<double>" for p in _PARTS)


def correlation_matrix(df: DataFrame, columns: list[Column]) -> np.ndarray:
    """Pearson matrix of the numeric columns; NaN where a side does not vary on the common rows.

    One scan for up to ``TILE`` columns; beyond that one for each pair of blocks of ``TILE``.
    """
    out = np.full((len(columns), len(columns)), np.nan)
    for a in range(0, len(columns), TILE):
        for b in range(a, len(columns), TILE):
            left, right = columns[a : a + TILE], columns[b : b + TILE]
            block = _block(df, left, right if a != b else None)
            out[a : a + len(left), b : b + len(right)] = block
            out[b : b + len(right), a : a + len(left)] = block.T
    np.fill_diagonal(out, 1.0)
    return out


def _block(df: DataFrame, left: list[Column], right: list[Column] | None) -> np.ndarray:
    """Correlations of each column on the left with each on the right (None: the same columns)."""
    lists = [F.array(*[c.cast("double") for c in side]).alias(name) for name, side in (("x", left), ("y", right)) if side]
    width = len(left), len(right or left)
    parts = df.select(*lists).mapInArrow(_task(*width, right is not None), _SCHEMA)
    merged = parts.repartition("row").sortWithinPartitions("row", "place").mapInArrow(_merged, _SCHEMA)
    out = np.full(width, np.nan)
    # Columns x columns numbers reach the driver.
    for r in merged.collect():
        n, mx, my, xy, xx, yy = (np.array(r[p]) for p in _PARTS)
        with np.errstate(invalid="ignore", divide="ignore"):
            found = xy / (np.sqrt(xx) * np.sqrt(yy))
        # Equal values leave less than this, the rounding of their mean in every task.
        varies = (xx > n * (_MEANS * mx) ** 2) & (yy > n * (_MEANS * my) ** 2)
        out[r["row"]] = np.where(varies, found, np.nan)
    return out


def _task(width: int, height: int, two: bool):
    def matrix(batch, name, columns):
        flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(-1, columns)

    def sums(batches):
        first = [np.full(width, np.nan), np.full(height, np.nan)]
        total = np.zeros((6, width, height))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, "x", width)
            y = matrix(batch, "y", height) if two else x
            shifted = []
            for side, values in enumerate((x, y)):
                unset = np.flatnonzero(np.isnan(first[side]) & ~np.isnan(values).all(axis=0))
                first[side][unset] = [values[~np.isnan(values[:, c]), c][0] for c in unset]
                there = ~np.isnan(values)
                shifted += [np.where(there, values - np.where(np.isnan(first[side]), 0, first[side]), 0.0), there.astype(float)]
            z, m, w, k = shifted
            total += np.stack([m.T @ k, z.T @ k, m.T @ w, z.T @ w, (z * z).T @ k, m.T @ (w * w)])
        n, sx, sy, xy, xx, yy = total
        some = np.where(n > 0, n, 1)
        mx, my = sx / some, sy / some
        out = [n, mx + np.nan_to_num(first[0])[:, None], my + np.nan_to_num(first[1])[None, :]]
        out += [xy - mx * sy, _about(xx, mx * sx), _about(yy, my * sy)]
        place = TaskContext.get().partitionId()
        for row in range(width):
            yield _row(place, row, [part[row] for part in out])

    return sums


def _about(squares: np.ndarray, mean_part: np.ndarray) -> np.ndarray:
    """Squares about the mean; exactly 0 where nothing but rounding is left."""
    left = squares - mean_part
    return np.where(left > _ROUNDING * squares, left, 0.0)


def _row(place: int, row: int, parts: list[np.ndarray]) -> pa.RecordBatch:
    arrays = [pa.array([place]), pa.array([row], pa.int32()), *[pa.array([p]) for p in parts]]
    return pa.RecordBatch.from_arrays(arrays, names=["place", "row", *_PARTS])


def _merged(batches):
    """Merge the rows of one number, which follow one another."""
    at, state = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.column("row")[i].as_py()
            parts = [batch.column(p)[i].values.to_numpy() for p in _PARTS]
            if row != at:
                if at is not None:
                    yield _row(0, at, state)
                at, state = row, parts
            else:
                state = _combined(state, parts)
    if at is not None:
        yield _row(0, at, state)


def _combined(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    n = a[0] + b[0]
    some = np.where(n > 0, n, 1)
    share, weight = b[0] / some, a[0] * b[0] / some
    # A side without rows has no mean.
    dx = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    dy = np.where((a[0] > 0) & (b[0] > 0), b[2] - a[2], 0.0)
    mx = np.where(a[0] > 0, a[1] + dx * share, b[1])
    my = np.where(a[0] > 0, a[2] + dy * share, b[2])
    return [n, mx, my, a[3] + b[3] + dx * dy * weight, a[4] + b[4] + dx * dx * weight, a[5] + b[5] + dy * dy * weight]
