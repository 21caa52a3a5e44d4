"""Whitening of vectors by their largest components, found by contour integration (FEAST) on their covariance.

Vectors are taken in whole steps of 1/``scale``: x = floor(scale * c), exact. The covariance is over each distinct x
once. Counts, sums and products of centred steps are whole numbers added up on the executors, so the covariance is right to the last digit;
what comes to the driver is one row per pair of dimensions.

Components: Householder reflections make the covariance tridiagonal; its inertia after a shift (signs of the pivots of L D L^T) counts the
eigenvalues above the shift, and bisection on that count finds an interval that holds the wanted ones. A quadrature over a circle around the
interval, each node a solve with the covariance shifted by a complex number, projects a block of vectors onto the eigenvectors
in it; Rayleigh-Ritz extracts them; both repeat until residuals are at rounding level. A count of Ritz values that differs from the count by
inertia means that some are missed: the block grows, in the end to all dimensions.

Rows take part whose vector is neither null nor empty, holds no null and no number that is not finite or reaches 2^53 steps, and has the most
frequent length (ties: the longer). Other rows give none. Components whose eigenvalue is zero to rounding cannot be whitened and give no row, so one
distinct vector gives none at all. Repeated rows all give their rows, repeated vectors count once in the fit. A sum of squares beyond a long is
null. Columns of the caller named as the new ones give way to them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.llm.common import small_batches
from tabsync.storage import materialise

NODES = 8
LIMIT = 1 << 53
RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def steps(vector: Column, scale: int) -> Column:
    """Whole steps of a vector; null where it cannot take part."""
    doubles = vector.cast("array<double>")
    good = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT / scale))
    return F.when((F.size(vector) > 0) & good, F.transform(doubles, lambda c: F.floor(scale * c)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def products(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers, exact."""
    top = int(np.abs(y).max(initial=0))
    if top * top * len(y) < LIMIT:
        whole = y.astype(float)
        return (whole.T @ whole).astype(np.int64)
    exact = y.astype(object)
    return exact.T @ exact


def _totals(fit: DataFrame, work, kind: str) -> dict[int, object]:
    """Sums by place of what ``work`` makes of all batches of a task, one array of numbers each."""
    exact = kind.startswith("decimal")

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            values = [int(v) for v in total.tolist()] if exact else total
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)),
                                              pa.array(values, pa.decimal128(38, 0) if exact else pa.float64())], names=["at", "value"])

    rows = fit.select("x").mapInArrow(run, f"at int, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).collect()
    return {r["at"]: int(r["value"]) if exact else float(r["value"]) for r in rows}


def covariance(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sums, and their covariance (divisor: their number) to the last digit."""
    first = _totals(fit, lambda c: np.concatenate([[len(c)], _matrix(c, dims).astype(object).sum(0)]), "decimal(38,0)")
    n, sums = first[0], [first[1 + j] for j in range(dims)]
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    upper = np.triu_indices(dims)

    def centred(column: pa.Array) -> np.ndarray:
        y = _matrix(column, dims) - middle
        return products(y)[upper].astype(object)

    second = _totals(fit, centred, "decimal(38,0)")
    rest = [s - n * int(m) for s, m in zip(sums, middle.tolist(), strict=True)]
    matrix = np.zeros((dims, dims))
    for at, (i, j) in enumerate(zip(*(u.tolist() for u in upper), strict=True)):
        matrix[i, j] = matrix[j, i] = (n * second[at] - rest[i] * rest[j]) / (n * n)
    return n, sums, matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of a similar tridiagonal matrix, by reflections."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k]
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(v)
        if size:
            v /= size
            a[k + 1:, k:] -= 2 * np.outer(v, v @ a[k + 1:, k:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(diagonal: np.ndarray, side: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed the shift: positive pivots of L D L^T of the shifted matrix."""
    least = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(side).max(initial=0), np.finfo(float).tiny)
    count, pivot = 0, 1.0
    squares = np.concatenate([[0.0], side ** 2]).tolist()
    for d, s in zip(diagonal.tolist(), squares, strict=True):
        pivot = d - shift - s / pivot
        if abs(pivot) < least:
            pivot = -least
        count += pivot > 0
    return count


def _interval(diagonal: np.ndarray, side: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """Bounds around the ``wanted`` largest eigenvalues, and how many lie between (more only where the next ones tie)."""
    reach = np.abs(np.concatenate([[0], side])) + np.abs(np.concatenate([side, [0]]))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    spread = max(high - low, abs(high), np.finfo(float).tiny)
    low, high = low - 0.01 * spread, high + 0.01 * spread

    def place(number: int) -> float:
        a, b = low, high
        while b - a > 1e-13 * spread:
            middle = (a + b) / 2
            if above(diagonal, side, middle) >= number:
                a = middle
            else:
                b = middle
        return (a + b) / 2

    here = place(wanted)
    while wanted < len(diagonal):
        following = place(wanted + 1)
        if here - following > 1e-10 * spread:
            return (here + following) / 2, high, wanted
        wanted, here = wanted + 1, following
    return low, high, len(diagonal)


def largest_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    dims = len(matrix)
    wanted = min(wanted, dims)
    if not matrix.any():
        return np.zeros(wanted), np.eye(dims)[:, :wanted]
    diagonal, side = tridiagonal(matrix)
    low, high, inside = _interval(diagonal, side, wanted)
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(-0.5j * np.pi * (nodes - 1))
    size, goal = min(dims, 2 * inside + 8), 8 * dims * np.finfo(float).eps * max(np.abs(matrix).sum(1).max(), np.finfo(float).tiny)
    random = np.random.default_rng(0)
    block = random.standard_normal((dims, size))
    while True:
        for _ in range(20):
            image = np.zeros_like(block)
            for turn, weight in zip(turns, weights, strict=True):
                solved = np.linalg.solve((centre + radius * turn) * np.eye(dims) - matrix, block)
                image += 0.5 * weight * (radius * turn * solved).real
            basis, kept, _ = np.linalg.svd(image, full_matrices=False)
            # Directions that the projection leaves at rounding level are noise, unless the whole space is searched.
            basis = basis if size == dims else basis[:, kept > 1e-14 * kept[0]]
            values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ turned
            found = (values > low) & (values < high)
            off = np.linalg.norm(matrix @ vectors[:, found] - vectors[:, found] * values[found], axis=0).max(initial=0)
            if found.sum() == inside and off <= goal:
                break
            block = np.concatenate([vectors, random.standard_normal((dims, size - vectors.shape[1]))], 1)
        if found.sum() == inside and off <= goal or size == dims:
            order = np.argsort(-values[found], kind="stable")[:wanted]
            values, vectors = values[found][order], vectors[:, found][:, order]
            largest = np.abs(vectors).argmax(0)
            return values, vectors * np.sign(vectors[largest, np.arange(len(order))])
        size = min(dims, 2 * size)
        block = random.standard_normal((dims, size))


def deviations(x: np.ndarray, n: int, sums: Sequence[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null beyond a long."""
    top = (n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))) ** 2 * x.shape[1]
    if top < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, components: int = 4, vector_col: str = "embedding", keep: Sequence[str] | None = None, scale: int = 256) -> DataFrame:
    """One row per row and component: the columns ``keep`` (default: all), and those of ``RESULT``.

    ``whitened`` is the vector in steps less the mean, projected on the component, over the root of its eigenvalue; ``explained``
    the eigenvalue's share of the variance; ``identity_error`` the largest entry by which the covariance of the whitened
    fit vectors differs from the identity, measured on them.
    """
    spark = df.sparkSession
    small_batches(spark)
    result = T.StructType.fromDDL(RESULT)
    kept = [f for f in df.schema.fields if f.name in (df.columns if keep is None else keep) and f.name not in result.names]
    rows = df.select(F.struct(*[F.col(f"`{f.name}`") for f in kept], F.lit(0).alias("_")).alias("row"), steps(F.col(f"`{vector_col}`"), scale).alias("x"))
    rows = rows.where(F.col("x").isNotNull())
    out = T.StructType(kept + result.fields)
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], out)
    dims = lengths[0]["dims"]
    rows = rows.where(F.size("x") == dims)
    fit = materialise(rows.select("x").distinct(), "fit-vectors")
    n, sums, matrix = covariance(fit, dims)
    values, vectors = largest_components(matrix, components)
    trace = float(np.trace(matrix))
    real = values > 64 * dims * np.finfo(float).eps * trace  # none of a covariance of zeros
    values, vectors = values[real], vectors[:, real]
    many = len(values)
    if not many:
        return spark.createDataFrame([], out)
    mean, turn = np.array([s / n for s in sums]), vectors / np.sqrt(values)

    def moments(column: pa.Array) -> np.ndarray:
        white = (_matrix(column, dims) - mean) @ turn
        return np.concatenate([white.sum(0), (white.T @ white).ravel()])

    seen = _totals(fit, moments, "double")
    middle = np.array([seen[j] for j in range(many)]) / n
    spread = np.array([seen[many + j] for j in range(many * many)]).reshape(many, many) / n
    error = float(np.abs(spread - np.outer(middle, middle) - np.eye(many)).max())
    shares = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dims)
            white, far = (x - mean) @ turn, pa.array(deviations(x, n, sums), pa.int64())
            each = pa.array(np.repeat(np.arange(len(x)), many))
            own = [c.take(each) for c in batch.column(0).flatten()[:-1]]
            yield pa.RecordBatch.from_arrays(
                own + [pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), n)), far.take(each),
                       pa.array(white.ravel()), pa.array(np.tile(shares, len(x))), pa.array(np.full(len(each), error))], names=out.names)

    return rows.mapInArrow(run, out)
