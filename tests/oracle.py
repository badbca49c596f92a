"""Compare registered queries with their SQL counterparts."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.01"


def duck(sf_dir: str = SF_DIR):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    if hasattr(value, "asDict"):
        return tuple(_norm(v) for v in value)
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def compare(spark, name: str, sf_dir: str = SF_DIR, con=None) -> list[str]:
    """Differences between the two sides of a query, empty when they agree exactly."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    left = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = (con or duck(sf_dir)).execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    if sorted(names) != cols:
        return [f"columns differ: {sorted(set(cols) ^ set(names))}"]
    order = [names.index(c) for c in cols]
    right = sorted((tuple(_norm(r[i]) for i in order) for r in res.fetchall()), key=_key)
    if len(left) != len(right):
        return [f"row counts differ: {len(left)} vs {len(right)}"]
    out = []
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append("; ".join(f"{c}: {x!r} vs {y!r}" for c, x, y in zip(cols, a, b) if x != y or type(x) is not type(y)))
    return out


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidemark.session import local_session

    spark = local_session()
    con = duck()
    names = sys.argv[1:] or list(entry.queries())
    bad = []
    for n in names:
        start = time.time()
        try:
            if n in entry.oracle_sql():
                diffs = compare(spark, n, con=con)
            else:
                rows = entry.queries()[n](spark, SF_DIR).collect()
                diffs = [] if rows else ["no rows"]
        except Exception as exc:  # noqa: BLE001
            diffs = [f"{type(exc).__name__}: {str(exc)[:1500]}"]
        print(f"{'ok ' if not diffs else 'BAD'} {n} {time.time() - start:.1f}s {len(diffs) or ''}", flush=True)
        for d in diffs[:4]:
            print("    ", d[:1200], flush=True)
        bad += [n] if diffs else []
    print("failed:", bad)
