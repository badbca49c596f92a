"""Rows and events per bin of many numeric columns in one scan.

Functions of this module run inside Python workers and are shipped with the job.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def bin_tallies(rows: DataFrame, y: Column, columns: list[Column], edges: list[list[float]]) -> DataFrame:
    """(place, bin, n, n1): rows and sum of ``y`` per column (by its place) and bin.

    The bin is the number of ``edges`` below the value; missing values are left out.  Each task
    gives out one row per bin, so what is shuffled does not grow with the rows.
    """
    cuts = [np.array(e, float) for e in edges]

    def tally(batches):
        n = [np.zeros(len(c) + 1, np.int64) for c in cuts]
        n1 = [np.zeros(len(c) + 1, np.int64) for c in cuts]
        for batch in batches:
            events = batch.column(0).to_numpy(zero_copy_only=False)
            for i, cut in enumerate(cuts):
                # A missing value arrives as NaN.
                x = batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float, copy=False)
                known = ~np.isnan(x)
                at = np.searchsorted(cut, x[known], side="left")
                n[i] += np.bincount(at, minlength=len(cut) + 1)
                np.add.at(n1[i], at, events[known])
        place = np.repeat(np.arange(len(cuts), dtype=np.int32), [len(c) + 1 for c in cuts])
        number = np.concatenate([np.arange(len(c) + 1, dtype=np.int32) for c in cuts])
        found = [pa.array(a) for a in (place, number, np.concatenate(n), np.concatenate(n1))]
        yield pa.RecordBatch.from_arrays(found, names=["place", "bin", "n", "n1"])

    plain = rows.select(y.cast("bigint").alias("y"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    parts = plain.mapInArrow(tally, "place int, bin int, n bigint, n1 bigint")
    return parts.where("n > 0").groupBy("place", "bin").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
