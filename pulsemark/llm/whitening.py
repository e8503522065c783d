"""Embedding whitening: centred covariance, its leading eigenvectors, and every vector projected on them.

Entries become integers first (``floor(64 * c) + 1000000``), so sums and deviations are exact. Executors add up the sums,
then the products of centred vectors; partial matrices carry their task's number and are added in that order, so reruns
agree to the last digit. Only the d x d covariance reaches the driver (d: the vectors' length), where it is brought to
tridiagonal form by Householder reflections; Sturm counts and bisection give the leading eigenvalues, inverse iteration
with reorthogonalisation inside clusters their vectors. The projection, d x 32 numbers, travels with the tasks' code.

Odd rows: vectors that are null or empty, hold null or non-finite entries, or entries of 2^55 or more in size, are left
out; so are those of another length than the commonest (the shorter of two equally common ones). Rows of equal or null
ids are rows of their own. Components without variance (at most 1e-12 of the largest) do not exist, as nothing could be
divided by their scale; a table without usable rows gives no rows. A deviation that exceeds a long is null.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import fixed_binary

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 55)
FLAT = 1e-12
LONG = (1 << 63) - 1


class Whitening(NamedTuple):
    rows: int
    sums: list[int]
    values: np.ndarray  # leading eigenvalues, falling
    vectors: np.ndarray  # d x components, unit columns
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.rows)) for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


# ---- eigenvectors of a symmetric matrix ----


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflection vectors of ``a`` brought to tridiagonal form."""
    a = np.array(a, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        size = np.sqrt(v @ v)
        v[0] += np.copysign(size, v[0])
        length = np.sqrt(v @ v)
        v = v / length if length > 0 else np.zeros_like(v)
        reflections.append(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every number of ``at``: how many eigenvalues of the tridiagonal matrix are smaller."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count = np.zeros(len(at), int)
    q = np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (off[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection of Sturm counts."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low, high = np.min(diagonal - reach), np.max(diagonal + reach)
    slack = np.finfo(float).eps * max(abs(low), abs(high)) * n
    lo, hi = np.full(k, low - slack), np.full(k, high + slack)
    rank = n - np.arange(k)  # the j-th largest has n - j values at or below it
    for _ in range(1100):
        mid = lo + (hi - lo) / 2
        if np.all((mid <= lo) | (mid >= hi)):
            break
        above = sturm_count(diagonal, off, mid) >= rank
        lo, hi = np.where(above, lo, mid), np.where(above, mid, hi)
    return lo + (hi - lo) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray, least: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves (T - shift) y = b for all shifts at once, a column each: elimination with row exchanges."""
    n, k = len(diagonal), len(shifts)
    u0, u1, u2 = np.zeros((n, k)), np.zeros((n, k)), np.zeros((n, k))
    factor, swapped = np.zeros((n, k)), np.zeros((n, k), bool)
    a, b = diagonal[0] - shifts, np.full(k, off[0] if n > 1 else 0.0)
    for i in range(n - 1):
        below, centre = off[i], diagonal[i + 1] - shifts
        right = off[i + 1] if i + 2 < n else 0.0
        swap = np.abs(a) < abs(below)
        pivot = np.where(swap, below, a)
        pivot = np.where(np.abs(pivot) < least, np.copysign(least, pivot), pivot)
        m = np.where(swap, a, below) / pivot
        u0[i], u1[i], u2[i] = pivot, np.where(swap, centre, b), np.where(swap, right, 0.0)
        a, b = np.where(swap, b - m * centre, centre - m * b), np.where(swap, -m * right, right)
        factor[i], swapped[i] = m, swap
    u0[n - 1] = np.where(np.abs(a) < least, np.copysign(least, a), a)

    def solve(rhs: np.ndarray) -> np.ndarray:
        y = rhs.copy()
        for i in range(n - 1):
            top, low = np.where(swapped[i], y[i + 1], y[i]), np.where(swapped[i], y[i], y[i + 1])
            y[i], y[i + 1] = top, low - factor[i] * top
        for i in range(n - 1, -1, -1):
            rest = (u1[i] * y[i + 1] if i + 1 < n else 0) + (u2[i] * y[i + 2] if i + 2 < n else 0)
            y[i] = (y[i] - rest) / u0[i]
        return y

    return solve


def _clusters(values: np.ndarray, gap: float) -> list[slice]:
    cuts = [0, *(np.flatnonzero(values[:-1] - values[1:] > gap) + 1).tolist(), len(values)]
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix by inverse iteration; those of close values are orthogonalised."""
    size = max(np.max(np.abs(diagonal)), np.max(np.abs(off), initial=0.0), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    groups = _clusters(values, 1e-3 * size)
    shifts = values.copy()
    for j in range(1, len(shifts)):  # equal values get shifts of their own
        shifts[j] = min(shifts[j], shifts[j - 1] - 4 * eps * size)
    solve = _solver(diagonal, off, shifts, eps * size)
    y = np.random.default_rng(1).uniform(-1, 1, (len(diagonal), len(values)))
    for _ in range(5):
        y = solve(y / np.sqrt(np.sum(y * y, axis=0)))
        y /= np.max(np.abs(y), axis=0)
        for group in groups:
            part = y[:, group]
            for j in range(part.shape[1]):
                for _ in range(2):
                    part[:, j] -= part[:, :j] @ (part[:, :j].T @ part[:, j])
                part[:, j] /= np.sqrt(part[:, j] @ part[:, j])
    return y


def eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns.

    The largest entry of each vector is positive.
    """
    scale = np.max(np.abs(matrix))
    if len(matrix) == 1 or scale == 0:
        return np.diag(matrix)[:k].astype(float), np.eye(len(matrix))[:, :k]
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, min(k, len(matrix)))
    vectors = leading_vectors(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    vectors /= np.sqrt(np.sum(vectors * vectors, axis=0))
    largest = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])]
    return values * scale, vectors * np.where(largest < 0, -1.0, 1.0)


# ---- sums over the table ----


def _usable(rows: DataFrame, vec_id: str, column: str) -> DataFrame:
    fine = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(LARGEST)))
    return rows.where(F.col(column).isNotNull() & (F.size(column) > 0) & fine).select(
        F.col(vec_id).alias("id"), F.col(column).cast("array<double>").alias("v"))


def _longs(batch: pa.RecordBatch, d: int) -> np.ndarray:
    entries = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * entries).astype(np.int64) + SHIFT


def _sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of every dimension."""
    def run(batches):
        n, total = 0, [0] * d
        for batch in batches:
            x = _longs(batch, d)
            small = x.size == 0 or np.max(np.abs(x)) < 1 << 40
            part = x.sum(axis=0) if small else x.astype(object).sum(axis=0)
            n, total = n + len(x), [int(a) + int(b) for a, b in zip(total, part, strict=True)]
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()),
            "total": pa.array([str(t) for t in total], pa.string())})

    made = rows.mapInArrow(run, "dim int, n bigint, total string").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dim").collect()
    return (made[0]["n"], [int(r["total"]) for r in made]) if made else (0, [0] * d)


def _products(rows: DataFrame, d: int, width: int, centred: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """Covariance, with divisor ``n``, of the rows that ``centred`` makes of the integer vectors (``width`` columns).

    A task gives a matrix as ``width`` rows; those of one number are added up by one task in the order of the tasks.
    """
    def partial(batches):
        products, total = np.zeros((width, width)), np.zeros((width, 1))
        for batch in batches:
            made = centred(_longs(batch, d))
            products += made.T @ made
            total += made.sum(axis=0)[:, None]
        yield pa.RecordBatch.from_arrays([
            pa.array(range(width), pa.int32()), pa.array([TaskContext.get().partitionId()] * width, pa.int32()),
            fixed_binary(np.hstack([products, total]))], ["line", "part", "sums"])

    def added(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for line, raw in zip(batch.column("line").to_pylist(), batch.column("sums"), strict=True):
                own = np.frombuffer(raw.as_buffer(), float)
                sums[line] = sums[line] + own if line in sums else own
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), fixed_binary(np.stack(list(sums.values())))], ["line", "sums"])

    made = rows.mapInArrow(partial, "line int, part int, sums binary").repartition("line").sortWithinPartitions("line", "part")
    lines = sorted(made.mapInArrow(added, "line int, sums binary").collect(), key=lambda r: r["line"])
    table = np.stack([np.frombuffer(r["sums"], float) for r in lines])
    # the rows are centred already; what rounding has left of their mean goes as well
    products, mean = table[:, :width] / n, table[:, width] / n
    return (products + products.T) / 2 - np.outer(mean, mean)


def fit(rows: DataFrame, vec_id: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Mean and leading components of all usable vectors; None if there are none."""
    rows = _usable(rows, vec_id, column)
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return None
    d = length["d"]
    rows = rows.where(F.size("v") == d)
    n, sums = _sums(rows, d)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    covariance = _products(rows, d, d, lambda x: x - mean, n)
    values, vectors = eigen(covariance, components)
    real = values > max(FLAT * values[0], 0.0)
    return Whitening(n, sums, values[real], vectors[:, real], float(np.trace(covariance)))


def identity_error(rows: DataFrame, model: Whitening, vec_id: str = "vec_id", column: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    mean, projection = model.mean, model.projection
    d, width = projection.shape
    if not width:
        return 0.0
    rows = _usable(rows, vec_id, column).where(F.size("v") == d)
    made = _products(rows, d, width, lambda x: (x - mean) @ projection, model.rows)
    return float(np.max(np.abs(made - np.eye(width))))


def _deviations(x: np.ndarray, centred: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sums of (n * x - S)^2, exact; null beyond a long."""
    about = np.sum((centred * n) ** 2, axis=1)
    fits = about < 9e18
    largest = n * int(np.max(np.abs(x), initial=0)) + max(abs(s) for s in sums)
    if largest < LONG:
        apart = np.where(fits[:, None], n * x - np.array(sums, np.int64), 0)
        exact = np.sum(apart * apart, axis=1)
        if fits.all():
            return pa.array(exact)
        made = exact.astype(object)
    else:
        made, fits = np.zeros(len(x), object), np.zeros(len(x), bool)
    for i in np.flatnonzero(~fits & (about < 9.3e18)).tolist():
        made[i] = sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums, strict=True))
        fits[i] = made[i] <= LONG
    return pa.array([int(m) if ok else None for m, ok in zip(made, fits, strict=True)], pa.int64())


def whitened(rows: DataFrame, model: Whitening | None, error: float, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row per usable vector and component; see the module for the rest."""
    kind = rows.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    mean, projection, sums, n = model.mean, model.projection, model.sums, model.rows
    share = model.values / model.trace
    d, width = projection.shape

    def run(batches):
        for batch in batches:
            x = _longs(batch, d)
            centred = x - mean
            each = pa.array(np.repeat(np.arange(len(x)), width))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(each), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * width, n, np.int64)), _deviations(x, centred, n, sums).take(each),
                pa.array((centred @ projection).ravel()), pa.array(np.tile(share, len(x))),
                pa.array(np.full(len(x) * width, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return _usable(rows, vec_id, column).where(F.size("v") == d).mapInArrow(run, schema)


def whiten(rows: DataFrame, vec_id: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on all rows and project all rows."""
    model = fit(rows, vec_id, column, components)
    error = identity_error(rows, model, vec_id, column) if model else 0.0
    return whitened(rows, model, error, vec_id, column)
