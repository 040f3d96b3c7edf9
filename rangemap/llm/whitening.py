"""Whitening of embeddings by their leading principal components, found by contour integration (FEAST).

Spark makes the fit list (distinct vectors, written to the shared folder), its exact sums and its centred covariance; only
that d by d matrix, whose size does not depend on the number of rows, reaches the driver. There:

* the matrix is brought to tridiagonal form once, and Sturm counts of it give the inertia of V - sI for any s, that is the
  number of eigenvalues above s. By bisection they enclose the wanted eigenvalues in disjoint intervals of known counts;
* for each interval a quadrature over a circle about it, of solves with zI - V for complex z, projects random vectors onto
  the interval's eigenspace; a Rayleigh-Ritz step extracts eigenpairs, and both are repeated until residuals are rounding;
* the pairs inside the interval must be as many as the inertia counts say, or the subspace is enlarged.

Spark then projects every row, and measures the covariance of the whitened fit list.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

#: One quantum is 1/256; values of 2^53 quanta and more are no longer whole doubles.
SCALE, LARGEST = 256.0, float(1 << 53)
NODES = 16
ROW_SCHEMA = "vec_id long, x binary"


# Numbers on the driver, all of the size of the covariance.


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to the symmetric v, by Householder reflections."""
    a = v.copy()
    n = len(a)
    for j in range(n - 2):
        u = a[j + 1 :, j].copy()
        size = np.linalg.norm(u)
        if size == 0:
            continue
        u[0] += np.copysign(size, u[0])
        u /= np.linalg.norm(u)
        p = a[j + 1 :, j + 1 :] @ u
        q = p - (u @ p) * u
        a[j + 1 :, j + 1 :] -= 2 * (np.outer(u, q) + np.outer(q, u))
        first = -np.copysign(size, a[j + 1, j])
        a[j + 1 :, j] = a[j, j + 1 :] = 0
        a[j + 1, j] = a[j, j + 1] = first
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, s: float) -> int:
    """How many eigenvalues are above s: the positive pivots of the tridiagonal matrix less s."""
    tiny = np.finfo(float).tiny
    above, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - s - (off[i - 1] ** 2 / pivot if i else 0.0)
        if pivot == 0:
            pivot = -tiny
        above += pivot > 0
    return above


def enclosures(v: np.ndarray, most: int, above: Callable[[float], int]) -> list[tuple[float, float, int]]:
    """Disjoint intervals (low, high, count), falling, that hold the largest eigenvalues, at least `most` of them and all
    that can't be told from these. Between intervals there is room for a contour."""
    n = len(v)
    radius = np.abs(v).sum(1).max()
    grain = radius * 1e-7
    brackets = []
    for k in range(1, n + 1):
        low, high = -radius * 1e-3 - grain, radius + grain
        while high - low > grain:  # the k-th largest is above low and not above high
            mid = (low + high) / 2
            low, high = (mid, high) if above(mid) >= k else (low, mid)
        brackets.append((low, high))
        # One bracket past the wanted ones shows where the last interval can end.
        if k > most and brackets[-2][0] - high > radius * 1e-4:
            break
    # Of neighbours too near for a contour between them one interval is made; the last bracket, unless all are, stays out.
    last = len(brackets) if len(brackets) == n and (n <= most or brackets[-2][0] - brackets[-1][1] <= radius * 1e-4) else len(brackets) - 1
    groups: list[list[tuple[float, float]]] = []
    for b in brackets[:last]:
        if groups and groups[-1][-1][0] - b[1] < 0.05 * max(abs(b[1]), radius * 1e-3):
            groups[-1].append(b)
        else:
            groups.append([b])
    edges = [*groups, [brackets[last]]] if last < len(brackets) else groups
    found = []
    for i, g in enumerate(groups):
        low, high = g[-1][0], g[0][1]
        room_up = edges[i - 1][-1][0] - high if i else high - low + radius * 0.05
        room_down = low - edges[i + 1][0][1] if i + 1 < len(edges) else high - low + radius * 0.05
        low, high = low - room_down / 3, high + room_up / 3
        found.append((low, high, above(low) - above(high)))
    return found


def eigenpairs_inside(v: np.ndarray, low: float, high: float, count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The count eigenvalues in (low, high), falling, and their unit vectors as columns."""
    n, rng = len(v), np.random.default_rng(seed)
    centre, radius = (low + high) / 2, (high - low) / 2
    # The upper half of the circle: the lower one gives the conjugates.
    angles = np.pi * (np.arange(NODES) + 0.5) / NODES
    shifts = radius * np.exp(1j * angles)
    size = min(n, count + count // 2 + 4)
    while True:
        y = rng.standard_normal((n, size))
        best = np.inf
        for _ in range(30):
            q = np.zeros((n, size))
            for z in shifts:
                q += (z * np.linalg.solve((centre + z) * np.eye(n) - v, y.astype(complex))).real / NODES
            q, _ = np.linalg.qr(q)
            e, w = np.linalg.eigh(q.T @ v @ q)
            y = q @ w
            inside = (e > low) & (e < high)
            residual = np.linalg.norm(v @ y[:, inside] - y[:, inside] * e[inside], axis=0).max(initial=0.0)
            good = inside.sum() == count
            if good and (residual <= 1e-15 * np.abs(v).sum(1).max() or residual >= best * 0.5):
                order = np.argsort(-e[inside])
                return e[inside][order], y[:, inside][:, order]
            best = min(best, residual) if good else np.inf
        if size == n:
            raise ArithmeticError(f"of {count} eigenvalues between {low} and {high} not all were found")
        size = min(n, 2 * size)


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues of the symmetric, non-negative v, falling, and unit vectors as columns; fewer where
    v has fewer above rounding."""
    n = len(v)
    most = min(most, n)
    if most == 0 or not np.abs(v).max(initial=0.0) > 0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off = tridiagonal(v)
    pairs = [eigenpairs_inside(v, *i) for i in enclosures(v, most, lambda s: count_above(diagonal, off, s))]
    e = np.concatenate([p[0] for p in pairs])[:most]
    vectors = np.concatenate([p[1] for p in pairs], axis=1)[:, :most]
    real = e > n * np.finfo(float).eps * e[0] * 4
    return e[real], vectors[:, real]


# Tables.


def _quantised(batches):
    """(vec_id, x) of the rows whose vector is whole: x is floor(256 c) of each entry, as bytes of 64-bit integers."""
    for batch in batches:
        vectors = batch.column(1)
        sizes = np.asarray(vectors.value_lengths().fill_null(0))
        flat = vectors.flatten().cast(pa.float64(), safe=False)
        values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
        quanta = np.floor(values * SCALE)
        bad = ~(np.abs(quanta) < LARGEST)  # also where not a number
        ends = np.cumsum(sizes)
        wrong = np.concatenate([[0], np.cumsum(bad)])
        good = vectors.is_valid().to_numpy(zero_copy_only=False) & (wrong[ends] == wrong[ends - sizes])
        x = np.where(bad, 0, quanta).astype("<i8")
        kept = np.flatnonzero(good)
        rows = [x[b - s : b].tobytes() for b, s in zip(ends[kept], sizes[kept], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), pa.array(rows, pa.binary())], ["vec_id", "x"])


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): x holds the entries floor(256 c) as little-endian 64-bit integers. Rows whose vector is null or has a null
    or non-finite entry are dropped, and so are entries of 2^45 and more in size, which doubles don't hold to 1/256."""
    return rows.select(rows[id_col].cast("long").alias("vec_id"), rows[vector_col].cast("array<double>").alias("v")).mapInArrow(_quantised, ROW_SCHEMA)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, d)


def _sums(d: int):
    """One row a task and dimension: the sum, exact, in two parts of 32 bits."""

    def run(batches):
        low = high = np.zeros(d, np.int64)
        n = 0
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            low, high = low + (x & 0xFFFFFFFF).sum(0), high + (x >> 32).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array([n] * d, pa.int64()), pa.array(low), pa.array(high)], ["i", "n", "low", "high"])

    return run


def _products(d: int, centre: np.ndarray, project: np.ndarray | None):
    """One row a task and pair of columns: the sum of the products of centred vectors, or of what they project to."""

    def run(batches):
        total = None
        for batch in batches:
            y = _matrix(batch.column(0), d) - centre
            y = y if project is None else y @ project
            y = np.c_[y, np.ones(len(y))]
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.tril_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "total"])

    return run


def _covariance(fit: DataFrame, d: int, centre: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance, with divisor n, of the fit list's vectors less centre, or of their projections."""
    parts = fit.select("x").mapInArrow(_products(d, centre, project), "i long, j long, total double")
    # As many rows as the matrix has entries.
    found = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).toArrow()
    i, j, total = (found.column(c).to_numpy() for c in ("i", "j", "total"))
    k = 1 + int(i.max())
    m = np.zeros((k, k))
    m[i, j] = m[j, i] = total
    n, mean = m[-1, -1], m[-1, :-1] / m[-1, -1]
    return m[:-1, :-1] / n - np.outer(mean, mean)


def _projected(d: int, n: int, sums: list[int], components: np.ndarray, shares: list[float | None], error: float | None):
    """Up to len(shares) rows a vector."""
    centre = np.array([s / n for s in sums])
    total = np.array(sums, dtype=object)
    small = max((abs(s) for s in sums), default=0) < 1 << 61
    ranks, known = len(shares), components.shape[1]

    def deviations(x: np.ndarray) -> list[int | None]:
        bound = n * np.abs(x).max(initial=0).astype(object) + max((abs(s) for s in sums), default=0)
        if small and d * bound * bound < 1 << 63:
            y = n * x - total.astype(np.int64)
            return (y * y).sum(1).tolist()
        wide = [sum(int(v) ** 2 for v in row) for row in n * x.astype(object) - total]
        return [w if w < 1 << 63 else None for w in wide]

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(1), d)
            white = (x - centre) @ components
            nulls = np.zeros((len(x), ranks), bool)
            nulls[:, known:] = True
            white = np.c_[white, np.zeros((len(x), ranks - known))]
            m = len(x) * ranks
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), ranks))),
                pa.array(np.tile(np.arange(1, ranks + 1), len(x)), pa.int32()),
                pa.array([n] * m, pa.int64()),
                pa.array([v for v in deviations(x) for _ in range(ranks)], pa.int64()),
                pa.array(white.ravel(), mask=nulls.ravel()),
                pa.array(shares * len(x), pa.float64()),
                pa.array([error] * m, pa.float64()),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(rows: DataFrame, most: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and leading component.

    Each distinct vector counts once in the fit, however many rows share it; every row with a whole vector is returned,
    repeated ones and null ids as well. Vectors of another length than most of the fit list's (of two equally frequent
    ones, the longer) are dropped, and so are empty ones. Where the covariance has rank below `most`, the components that
    don't exist have null whitened and explained; identity_error is of those that do, null if none. deviation is null if
    it passes 64 bits. An empty table gives no rows. Other columns are left out.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    found = quantised(rows, id_col, vector_col)
    fit = written(found.filter(F.length("x") > 0).select("x").distinct(), "fit")
    sizes = fit.groupBy(F.length("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    d = sizes[0].size // 8
    fit_list, found = (t.filter(F.length("x") == 8 * d) for t in (fit, found))
    sums = fit_list.select("x").mapInArrow(_sums(d), "i long, n long, low long, high long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    by_dimension = sums.groupBy("i").agg(wide("n"), wide("low"), wide("high")).orderBy("i").collect()
    n, total = int(by_dimension[0].n), [int(r.low) + (int(r.high) << 32) for r in by_dimension]
    centre = np.array([s / n for s in total])
    v = _covariance(fit_list, d, centre)
    e, vectors = leading(v, most)
    components = vectors / np.sqrt(e)
    error = float(np.abs(_covariance(fit_list, d, centre, components) - np.eye(len(e))).max()) if len(e) else None
    discard(fit)
    ranks = min(most, d)
    shares = [*(float(x) for x in e / np.trace(v)), *[None] * (ranks - len(e))]
    return found.mapInArrow(_projected(d, n, total, components, shares, error), schema)
