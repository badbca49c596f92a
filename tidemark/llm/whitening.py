"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become fixed-point numbers x, whose sums are exact.  With A the rows of x less their mean,
the process builds orthonormal right vectors v (as long as a vector of the table) and left vectors u
(one entry per row of the table) with ``A V = U B`` for an upper bidiagonal B: every step takes one
product ``A v`` and one product ``A' u``, both distributed over the rows, and makes the new vector
orthogonal to all earlier ones.  The singular value decomposition of the small B gives the
components ``V q`` and the deviations ``s / sqrt(n)``.

A left vector is a combination of the columns of A, so it is kept as the coefficients ``a`` of
``u = A a`` and made anew in the task that needs it.  Nothing as long as the table is ever held, and
a lost executor costs a read of the stored rows.

The process ends when as many vectors as dimensions are found, or before that when the wanted
components cannot change any more: their residuals are at rounding level, and what the other vectors
could still hold (the rest of the trace) stays below the last of them.  Where a vector adds nothing
(a constant or dependent dimension, equal rows), the process goes on from a new seeded direction,
so components of equal deviation are all found.

Defined results: rows whose vector is NULL or empty, or holds NULL or non-finite entries, are left
out, and so are rows that are not as long as most (of equally frequent lengths, the larger);
repeated rows count as often as they stand there; a NULL id stays.  A component without deviation
(fewer independent dimensions than asked for, one row, equal rows) has ``explained`` 0 and
``whitened`` NULL.  An empty table gives an empty result.  Entries whose numbers or sums pass
2^62 raise an error.  Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.session import materialize

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
#: Partial sums that the driver adds up itself; more are added by tasks first.
FAN_IN = 256
_LIMIT = 2.0**62
_EPS = np.finfo(float).eps


def fixed_point(rows: DataFrame, id: str, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """id and x, ``floor(scale * entry) + shift`` per entry, for rows with a usable vector."""

    def convert(batches):
        for batch in batches:
            lists = batch.column("vector").cast(pa.large_list(pa.float64()))
            values = lists.flatten().to_numpy(zero_copy_only=False)  # NULL entries become NaN
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            # Rows without entries have no run for reduceat, and are left out anyway.
            full = sizes > 0
            fine = full.copy()
            if full.any():
                fine[full] = np.logical_and.reduceat(np.isfinite(values), bounds[:-1][full])
            x = np.floor(scale * values[np.repeat(fine, sizes)]) + shift
            if len(x) and np.abs(x).max() >= _LIMIT:
                raise ValueError("an entry is too large for fixed-point numbers")
            ends = np.concatenate([[0], np.cumsum(sizes[fine])])
            lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int64)))
            ids = batch.column("id").filter(pa.array(fine))
            yield pa.RecordBatch.from_arrays([ids, lists.cast(pa.list_(pa.int64()))], names=["id", "x"])

    given = rows.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return given.mapInArrow(convert, f"id {given.schema['id'].dataType.simpleString()}, x array<bigint>")


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _summed(rows: DataFrame, dims: int, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``part(x)`` over all batches; one row per task, added by tasks in levels of ``FAN_IN``."""
    kind = "bigint" if part is _exact else "double"

    def local(batches):
        total = np.zeros(shape, np.int64 if kind == "bigint" else float)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch, dims))
        place = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([place]), pa.array([total.ravel()])], names=["place", "sums"])

    def merged(batches):
        kept = [b for b in batches if b.num_rows]
        if kept:
            table = pa.Table.from_batches(kept)
            for group in np.unique(table["group"].to_numpy()):
                own = table.filter(pc.equal(table["group"], group)).sort_by("place")
                total = np.sum(np.stack(own["sums"].to_numpy()), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([group]), pa.array([total])], names=["place", "sums"])

    schema = f"place bigint, sums array<{kind}>"
    partial, count = rows.select("x").mapInArrow(local, schema), rows.rdd.getNumPartitions()
    while count > FAN_IN:
        count = -(-count // FAN_IN)
        grouped = partial.withColumn("group", F.floor(F.col("place") / FAN_IN)).repartition(count, "group")
        partial = grouped.mapInArrow(merged, schema)
    sums = [r["sums"] for r in sorted(partial.collect(), key=lambda r: r["place"])]  # FAN_IN rows at most
    total = np.zeros(shape, np.int64 if kind == "bigint" else float).ravel()
    for s in sums:
        total += np.array(s, total.dtype)
    return total.reshape(shape)


def _exact(x: np.ndarray) -> np.ndarray:
    """Sums per dimension."""
    return x.sum(axis=0)


@dataclass(frozen=True)
class Whitening:
    """Fitted state: exact sums per dimension, components as rows, their eigenvalues, the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float
    steps: int

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.trace if self.trace > 0 else np.zeros(len(self.variances))


def _start(dims: int, seed: int, taken: np.ndarray) -> np.ndarray | None:
    """A seeded unit vector orthogonal to the columns of ``taken``; None if they span everything."""
    if taken.shape[1] >= dims:
        return None
    v = np.random.default_rng([seed, taken.shape[1]]).standard_normal(dims)
    for _ in range(3):
        v -= taken @ (taken.T @ v)
        v /= np.linalg.norm(v)
    return v


def fit_whitening(rows: DataFrame, n: int, dims: int, components: int = COMPONENTS, seed: int = 7) -> Whitening:
    """Components of the stored ``rows`` (column x, ``dims`` long, ``n`` rows)."""
    ends = rows.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    # Bounds n x and every sum.
    if 2.0 * n * max(map(abs, ends)) >= _LIMIT:
        raise ValueError("sums are too large for fixed-point numbers")
    sums = _summed(rows, dims, _exact, (dims,))

    def centred(x: np.ndarray) -> np.ndarray:
        # n x - S is exact, so that one division rounds.
        return (n * x - sums) / n

    trace = float(_summed(rows, dims, lambda x: np.array([(centred(x) ** 2).sum()]), (1,))[0])
    size = trace**0.5  # Frobenius norm of A, not below its largest singular value
    right, left = np.zeros((dims, 0)), np.zeros((dims, 0))
    b = np.zeros((0, 0))
    v, coupled = _start(dims, seed, right), 0.0
    wanted = min(components, dims)
    while v is not None:
        k = right.shape[1]

        # u = A v, less its parts along all earlier u = A a.
        def along(x, v=v, left=left):
            own = centred(x)
            return (own @ left).T @ (own @ v)

        overlap = _summed(rows, dims, along, (k,)) if k else np.zeros(0)
        a = v - left @ overlap

        # A' u, the square of u, and what is left along the earlier ones.
        def back(x, a=a, left=left):
            own = centred(x)
            u = own @ a
            return np.concatenate([own.T @ u, [u @ u], (own @ left).T @ u])

        out = _summed(rows, dims, back, (dims + 1 + k,))
        product, square, rest = out[:dims], out[dims], out[dims + 1 :]
        # A second round of orthogonalisation, from the same pass.
        alpha = max(0.0, square - rest @ rest) ** 0.5
        grown = np.zeros((k + 1, k + 1))
        grown[:k, :k] = b
        if k:
            grown[k - 1, k] = coupled
        right = np.column_stack([right, v])
        if alpha > dims * _EPS * size:
            # A' u for the corrected u; A' u_j is row j of B in terms of the right vectors.
            a = (a - left @ rest) / alpha
            product = (product - right[:, :k] @ (b.T @ rest)) / alpha
            if k:
                product -= v * (coupled * rest[-1] / alpha)
            grown[k, k] = alpha
            after = product.copy()
            for _ in range(2):
                after -= right @ (right.T @ after)
            coupled = float(np.linalg.norm(after))
        else:
            a, coupled = np.zeros(dims), 0.0
        b, left = grown, np.column_stack([left, a])
        if coupled > dims * _EPS * size and right.shape[1] < dims:
            v = after / coupled
            v -= right @ (right.T @ v)
            v /= np.linalg.norm(v)
        else:
            v, coupled = _start(dims, seed, right), 0.0
        if _settled(b, coupled, alpha, trace, wanted):
            break
    _, deviations, q = np.linalg.svd(b)
    order = np.argsort(-deviations, kind="stable")[:wanted]
    found = (right @ q.T[:, order]).T
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    # Either sign is right; the entry of largest size is positive.
    found *= np.sign(found[np.arange(wanted), np.abs(found).argmax(axis=1)])[:, None]
    variances = deviations[order] ** 2 / n
    variances[deviations[order] <= dims * _EPS * size] = 0.0
    return Whitening(n, sums, found, variances, trace / n, right.shape[1])


def _settled(b: np.ndarray, coupled: float, alpha: float, trace: float, wanted: int) -> bool:
    """Whether the first ``wanted`` components are final.

    Their residuals are the coupling to the next vector times their part of the last left vector.
    Whatever is not yet found has squares that add up to the rest of the trace.
    """
    if len(b) <= wanted:
        return False
    left, s, _ = np.linalg.svd(b)
    residuals = coupled * np.abs(left[-1, :wanted])
    rest = max(0.0, trace - float(np.sum(s**2)))
    others = max(s[wanted] ** 2, rest) + alpha * coupled
    return bool(residuals.max() <= 4 * _EPS * s[0] and others + trace * 1e-12 < s[wanted - 1] ** 2)


def whitened(rows: DataFrame, id: str, fit: Whitening) -> DataFrame:
    """One row per row and component: id, component, n, deviation (exact), whitened, explained."""
    dims, used = fit.components.shape[1], fit.variances > 0
    weights = np.zeros_like(fit.components)
    weights[used] = fit.components[used] / np.sqrt(fit.variances[used])[:, None]
    n, sums, explained = fit.n, fit.sums, fit.explained

    def project(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = n * _matrix(batch, dims) - sums
            values = (y / n) @ weights.T
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, values.size + 1, len(used), dtype=np.int32)),
                pa.array(values.ravel(), mask=np.tile(~used, len(values))),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(_squares(y), pa.decimal128(38, 0)), lists], names=["id", "deviation", "values"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    projected = rows.mapInArrow(project, f"id {kind}, deviation decimal(38,0), values array<double>")
    shares = F.array(*[F.lit(float(e)) for e in explained])
    each = projected.select("id", "deviation", F.posexplode("values").alias("place", "whitened"))
    return each.select(
        F.col("id").alias(id),
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("place")].alias("explained"),
    )


def _squares(y: np.ndarray) -> list[Decimal]:
    """Exact sums of squares per row."""
    if np.abs(y).max() < (2**62 / y.shape[1]) ** 0.5:
        return [Decimal(int(s)) for s in (y * y).sum(axis=1)]
    return [Decimal(sum(v * v for v in row)) for row in y.tolist()]


def identity_error(rows: DataFrame, fit: Whitening) -> float:
    """Largest entry, by size, of the whitened rows' covariance less the identity."""
    used = fit.variances > 0
    if not used.any():
        return 0.0
    dims, n, sums = fit.components.shape[1], fit.n, fit.sums
    weights = (fit.components[used] / np.sqrt(fit.variances[used])[:, None]).T
    c = weights.shape[1]
    mean = _summed(rows, dims, lambda x: (((n * x - sums) / n) @ weights).sum(axis=0), (c,)) / n

    def products(x):
        w = ((n * x - sums) / n) @ weights - mean
        return w.T @ w

    return float(np.abs(_summed(rows, dims, products, (c, c)) / n - np.eye(c)).max())


def embedding_whitening(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Fit on all usable rows and apply to them: the columns of ``whitened`` and identity_error."""
    stored = materialize(fixed_point(rows, id, vector))
    lengths = stored.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    if most is None:
        empty = rows.select(F.col(id).alias(id)).where("false")
        cells = {"component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double"}
        cells |= {"explained": "double", "identity_error": "double"}
        return empty.select(id, *[F.lit(None).cast(t).alias(c) for c, t in cells.items()])
    same = stored.where(F.size("x") == most["dims"])
    fit = fit_whitening(same, most["n"], most["dims"], components)
    return whitened(same, id, fit).withColumn("identity_error", F.lit(identity_error(same, fit)))
