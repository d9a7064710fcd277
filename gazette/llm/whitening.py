"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance of a fit list are found without forming the
covariance. A pass multiplies a thin block Q by it: each task centres its rows, forms
Xᵀ(XQ) of them, and Spark sums the tasks' blocks entry by entry, so the driver gets one
block (dimensions x columns) whatever the number of rows or tasks. A polynomial recurrence
over such passes damps the unwanted part of the spectrum, [0, smallest Ritz value], then QR
and Rayleigh-Ritz; this repeats until every wanted pair is certified by its residual.

The fit list is each distinct row of whole numbers once, with exact integer sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gazette.session import materialize

#: Columns of the block beyond the wanted ones.
GUARD = 28
#: Steps of the recurrence at most, and growth of the largest over the smallest wanted
#: direction in one filter beyond which rounding would spoil the smallest.
DEGREE, GROWTH = 10, 1e8
#: Residual, relative to the gap to the nearest other value, that certifies a pair.
TOLERANCE = 1e-11
MAX_ROUNDS = 200
#: Eigenvalues at or below this share of the trace count as zero.
ZERO = 1e-13
#: Rounds without a smaller residual after which rounding, not the spectrum, sets it.
STALLED = 4
_LONG = 2 ** 63


def whole_numbers(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """`rows` with usable vectors, plus `x`: floor(256 * entry) as longs. Vectors that are
    null, empty or hold null or non-finite entries go."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    return rows.filter(v.isNotNull() & (F.size(v) > 0) & finite).withColumn("x", F.transform(v, lambda e: F.floor(F.lit(256.0) * e.cast("double")).cast("long")))


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class FitList:
    """Distinct rows, their number n and exact sums per dimension."""

    def __init__(self, rows: DataFrame):
        sizes = rows.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
        self.dims = sizes[0]["dims"] if sizes else 0
        self.rows = materialize(rows.filter(F.size("x") == self.dims).select("x").distinct(), "whitening-fit")
        dims = self.dims

        def sums(batches):
            n, total = 0, [0] * dims
            for b in batches:
                m = _matrix(b.column(0), dims)
                n += len(m)
                # halves are summed apart, so that no sum leaves 64 bits
                high, low = m >> 32, m & 0xFFFFFFFF
                total = [t + (int(h) << 32) + int(k) for t, h, k in zip(total, high.sum(0), low.sum(0))]
            yield pa.RecordBatch.from_pydict({"dim": list(range(-1, dims)), "v": pa.array([str(t) for t in (n, *total)])})

        parts = self.rows.mapInArrow(sums, "dim long, v string").groupBy("dim").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect() if dims else []
        of = {r["dim"]: int(r["v"]) for r in parts}
        self.n, self.sums = of.get(-1, 0), [of.get(k, 0) for k in range(dims)]
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dims)

    def total(self, of_rows) -> np.ndarray:
        """Sum over the fit list of the matrix that of_rows(centred rows) gives, divided by n:
        summed in each task, then entry by entry by Spark."""
        dims, mean = self.dims, self.mean

        def part(batches):
            total = None
            for b in batches:
                m = of_rows(_matrix(b.column(0), dims) - mean)
                total = m if total is None else total + m
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int64()), pa.array(total.ravel())], names=["k", "v"])

        got = self.rows.mapInArrow(part, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(got.num_rows)
        out[got.column("k").to_numpy()] = got.column("v").to_numpy()
        return out / self.n

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times the block q, in one pass."""
        return self.total(lambda c: c.T @ (c @ q)).reshape(q.shape)

    def trace(self) -> float:
        return float(self.total(lambda c: np.array([np.einsum("ij,ij->", c, c)]))[0]) if self.n else 0.0


def chebyshev_filter(times, q: np.ndarray, edge: float, top: float, wanted: float) -> np.ndarray:
    """q with the directions of eigenvalues in [0, edge] damped: a Chebyshev polynomial of
    the operator, mapped so that [0, edge] is [-1, 1], by its three-term recurrence."""
    steep = lambda t: np.arccosh(max(2 * t / edge - 1, 1.0))
    apart = steep(top) - steep(wanted)
    degree = int(np.clip(np.log(GROWTH) / apart if apart > 0 else DEGREE, 2, DEGREE))
    half = edge / 2
    scale = half / max(top - half, half)                      # keeps the largest direction near 1
    sigma = scale
    old, new = q, (times(q) - half * q) * (sigma / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / scale - sigma)
        old, new = new, 2 * (nxt / half) * (times(new) - half * new) - sigma * nxt * old
        sigma = nxt
    return new


def leading_eigenvectors(times, dims: int, trace: float, wanted: int, guard: int = GUARD, max_rounds: int = MAX_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors by column), largest first, of a positive semi-definite operator
    given by `times` (a block to its product). Certified: the residual of each pair is within
    TOLERANCE of its gap to the other values; where the gap is at rounding level (a tie: any
    basis of its space will do), the rounds end when the residual no longer falls. Pairs whose value is zero to rounding
    are left out."""
    width = min(dims, wanted + guard)
    q = np.linalg.qr(np.random.default_rng(13).standard_normal((dims, width)))[0]
    aq = times(q)
    best, stalled = np.inf, 0
    for _ in range(max_rounds):
        values, turn = np.linalg.eigh((q.T @ aq + aq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, aq = q @ turn, aq @ turn
        residual = np.linalg.norm(aq - q * values, axis=0)
        real = int((values[:wanted] > ZERO * trace).sum())
        if width == dims or not real or _certified(values, residual, real):
            break
        worst = residual[:real].max()
        stalled = 0 if worst < best / 2 else stalled + 1
        best = min(best, worst)
        if stalled >= STALLED and worst <= 1e-12 * values[0]:
            break
        edge = max(values[-1], ZERO * trace)
        if edge >= values[0]:
            break
        q = np.linalg.qr(chebyshev_filter(times, q, edge, values[0], values[real - 1]))[0]
        aq = times(q)
    vectors = q[:, :real]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0)[0] < 0, -1.0, 1.0)
    return values[:real], vectors


def _certified(values: np.ndarray, residual: np.ndarray, wanted: int) -> bool:
    """An eigenvector's error is at most its residual over the gap to the other values."""
    gap = np.empty(wanted)
    for k in range(wanted):
        gap[k] = np.abs(np.delete(values, k) - values[k]).min()
    return bool((residual[:wanted] <= TOLERANCE * np.minimum(gap, values[0])).all())


def whiten(rows: DataFrame, vector: str = "embedding", components: int = 4) -> DataFrame:
    """The columns of `rows` but the vector, for each usable row and component: `component` (from 1), `n`
    (rows of the fit list), `deviation` (sum over dimensions of (n * x - S)², exact; null
    beyond 64 bits), `whitened`, `explained` (share of the trace), `identity_error` (largest
    absolute entry of the covariance of `whitened` over the fit list minus the identity).

    Rows whose vector is null, empty or holds null or non-finite entries go, and those of
    another length than the most frequent one (ties: the longer). Components whose eigenvalue is zero to
    rounding (equal rows, fewer distinct rows than components) are left out: nothing can be scaled
    by them. Repeated rows count once in the fit and come out each. Columns named like an
    output are replaced, all others pass. An empty table gives no rows.
    """
    spark = rows.sparkSession
    made = {"component": T.IntegerType(), "n": T.LongType(), "deviation": T.LongType(), "whitened": T.DoubleType(), "explained": T.DoubleType(), "identity_error": T.DoubleType()}
    kept = [c for c in rows.columns if c not in made and c != vector]
    usable = whole_numbers(rows.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{vector}`").alias("v")), "v").select("row", "x")
    fit = FitList(usable)
    trace = fit.trace()
    values, vectors = leading_eigenvectors(fit.times, fit.dims, trace, components) if trace > 0 else (np.empty(0), np.empty((fit.dims, 0)))
    scaled = vectors / np.sqrt(values)
    k, error = len(values), 0.0
    if k:
        error = float(np.abs(fit.total(lambda c: (w := c @ scaled).T @ w).reshape(k, k) - np.eye(k)).max())
    n, sums, dims, mean = fit.n, fit.sums, fit.dims, fit.mean
    share = values / trace if k else values
    bound = spark.sparkContext.broadcast((scaled, mean, sums))      # dimensions x components
    schema = T.StructType([T.StructField("row", usable.schema["row"].dataType), *[T.StructField(c, t) for c, t in made.items()]])

    def run(batches):
        scaled, mean, sums = bound.value
        most = max((abs(s) for s in sums), default=0)
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            top = n * max(int(np.abs(x).max(initial=0)), 1) + most
            if dims * top * top < _LONG:
                d = n * x - np.array(sums, np.int64)
                deviation = pa.array((d * d).sum(1))
            else:
                exact = [sum((n * int(e) - s) ** 2 for e, s in zip(r, sums)) for r in x]
                deviation = pa.array([e if e < _LONG else None for e in exact], pa.int64())
            w = (x - mean) @ scaled
            for c in range(k):
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(m, c + 1, np.int32)), pa.array(np.full(m, n, np.int64)), deviation, pa.array(w[:, c].copy()),
                     pa.array(np.full(m, share[c])), pa.array(np.full(m, error))], names=schema.names)

    out = usable.filter(F.size("x") == dims).mapInArrow(run, schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *made)
