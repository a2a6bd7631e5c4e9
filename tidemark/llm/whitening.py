"""Whitening of embeddings by their leading principal components.

1. Vectors become integers, ``floor(64 * c) + 1000000`` for each entry, and each
   distinct integer vector goes into the fit list once (copies are combined
   before the shuffle, so a vector with a third of all rows is no hot key).
2. Tasks add up the list's exact sums, then products of entries centred by the
   mean: each task holds one matrix and hands it on by rows, which are added up
   by row number over ``SALTS`` groups first.
3. The covariance (one matrix, bounded by the dimension) is made tridiagonal by
   Householder reflections.  Sturm counts locate the leading eigenvalues by
   bisection; inverse iteration gives their vectors, orthogonalised within
   clusters of close eigenvalues.
4. Mean, components and eigenvalues are broadcast and every row is projected.

Defined results: rows whose vector is null, empty or holds a null or non-finite
entry, or one whose integer does not fit 63 bits, take no part; where vectors
differ in length those of the most frequent length take part (ties: the longer);
ids may be null or repeat, each row has its own results; directions without
variance (an eigenvalue below rounding) are no components, so a list of one
vector and an empty table give no rows; a deviation that no long can hold is
null; further columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
SALTS = 32
_EPS = np.finfo(np.float64).eps


# --- eigenvectors of a symmetric matrix, bounded by the dimension ---------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, subdiagonal and the reflections (first place, unit vector) that made them."""
    a = np.array(matrix, np.float64)
    n = len(a)
    steps = []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.abs(x[1:]).max(initial=0.0)
        if size == 0:
            continue
        x[0] += math.copysign(np.linalg.norm(x), x[0])
        u = x / np.linalg.norm(x)
        block = a[k + 1:, k + 1:]
        p = block @ u
        q = p - (u @ p) * u
        block -= 2 * (np.outer(u, q) + np.outer(q, u))
        a[k + 1:, k] -= 2 * u * (u @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
        steps.append((k + 1, u))
    return np.diag(a).copy(), np.diag(a, -1).copy(), steps


def below(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each of ``at``."""
    least = np.finfo(np.float64).tiny / _EPS + _EPS * np.abs(beside).max(initial=0.0) * _EPS
    squares = np.append(0.0, beside * beside)
    count, pivot = np.zeros(len(at), np.int64), np.ones(len(at))
    for d, s in zip(diagonal, squares, strict=True):
        pivot = d - at - s / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, each bisected down to neighbouring doubles."""
    n = len(diagonal)
    reach = np.append(np.abs(beside), 0) + np.append(0, np.abs(beside))
    pad = _EPS * 4 * max(1e-300, np.abs(diagonal).max() + reach.max())
    low, high = np.full(k, (diagonal - reach).min() - pad), np.full(k, (diagonal + reach).max() + pad)
    want = n - 1 - np.arange(k)  # as many lie below the value looked for
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = below(diagonal, beside, middle) > want
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return low + (high - low) / 2


class _Shifted:
    """T - value, factored with row exchanges, for repeated solving."""

    def __init__(self, diagonal: np.ndarray, beside: np.ndarray, value: float, least: float):
        n = len(diagonal)
        d, u, w = (diagonal - value).tolist(), [*beside.tolist(), 0.0], [0.0] * n
        low = [*beside.tolist(), 0.0]
        self.swap, self.factor = [False] * n, [0.0] * n
        for i in range(n - 1):
            if abs(low[i]) > abs(d[i]):
                self.swap[i] = True
                f = d[i] / low[i]
                d[i], u[i], w[i], d[i + 1], u[i + 1] = low[i], d[i + 1], u[i + 1], u[i] - f * d[i + 1], -f * u[i + 1]
            else:
                d[i] = d[i] if abs(d[i]) > least else least
                f = low[i] / d[i]
                d[i + 1] -= f * u[i]
            self.factor[i] = f
        d[-1] = d[-1] if abs(d[-1]) > least else least
        self.d, self.u, self.w = d, u, w

    def solve(self, y: np.ndarray) -> np.ndarray:
        x, n = y.tolist(), len(self.d)
        for i in range(n - 1):
            if self.swap[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= self.factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= self.u[i] * x[i + 1]
            if i + 2 < n:
                x[i] -= self.w[i] * x[i + 2]
            x[i] /= self.d[i]
        return np.array(x)


def leading_eigenvectors(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    n = len(matrix)
    size = np.abs(matrix).max(initial=0.0)
    if size == 0:
        return np.zeros(k), np.eye(n)[:, :k]
    diagonal, beside, steps = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, beside, k)
    norm = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0))
    vectors, cluster, moved = np.zeros((n, k)), 0, values.copy()
    rng = np.random.default_rng(11)
    for j in range(k):
        if j and moved[j - 1] - values[j] > 1e-3 * norm:
            cluster = j
        if j > cluster:  # equal shifts would give equal vectors
            moved[j] = min(values[j], moved[j - 1] - 10 * _EPS * norm)
        shifted = _Shifted(diagonal, beside, moved[j], _EPS * norm)
        x = rng.uniform(0.5, 1.0, n)
        for _ in range(5):
            x = shifted.solve(x / np.linalg.norm(x))
            for _ in range(2):
                x -= vectors[:, cluster:j] @ (vectors[:, cluster:j].T @ x)
        vectors[:, j] = x / np.linalg.norm(x)
    for at, u in reversed(steps):
        vectors[at:] -= 2 * np.outer(u, u @ vectors[at:])
    return values * size, vectors


# --- the distributed part -----------------------------------------------------------------


def integer_vectors(embeddings: DataFrame, vector_col: str = "embedding", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and ``x`` (array of longs) of the rows that take part."""
    entries = F.transform(F.col(f"`{vector_col}`"), lambda c: F.floor(c.cast("double") * SCALE))
    fits = F.forall(F.col(f"`{vector_col}`"), lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < float(1 << 62)), F.lit(False)))
    usable = embeddings.where(F.col(f"`{vector_col}`").isNotNull() & (F.size(F.col(f"`{vector_col}`")) > 0) & fits)
    return usable.select(*[F.col(f"`{c}`") for c in keep], F.transform(entries, lambda c: (c + F.lit(SHIFT)).cast("long")).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(high), pa.array(low)],
                                             names=["i", "n", "high", "low"])

    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    rows = fit.select("x").mapInArrow(run, "i int, n long, high long, low long").groupBy("i").agg(*whole).orderBy("i").collect()  # one row a dimension
    return int(rows[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _added(rows: DataFrame, width: int, salts: int = SALTS) -> np.ndarray:
    """Sum of partial matrices given as rows (i, salt, values): first over salts, then over row numbers."""

    def add(*keys: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, total = None, None
            for batch in batches:
                i, salt, values = batch.column(0).to_pylist(), batch.column(1).to_pylist(), _matrix(batch.column(2), width)
                for k in range(batch.num_rows):
                    here = (i[k], salt[k] if "salt" in keys else 0)
                    if here != at:
                        if at is not None:
                            yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["i", "salt", "v"])
                        at, total = here, np.zeros(width)
                    total += values[k]
            if at is not None:
                yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["i", "salt", "v"])
        return run

    spec = "i int, salt int, v array<double>"
    some = rows.repartition(salts, "i", "salt").sortWithinPartitions("i", "salt", "task").select("i", "salt", "v").mapInArrow(add("i", "salt"), spec)
    whole = some.repartition(min(salts, width), "i").sortWithinPartitions("i", "salt").mapInArrow(add("i"), spec)
    out = np.zeros((width, width))
    for r in whole.collect():  # one row a dimension
        out[r["i"]] += r["v"]
    return out


def _product_sums(fit: DataFrame, width: int, prepare) -> np.ndarray:
    """Sum over the list of the outer products of ``prepare(x)``, a function of blocks of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                y = prepare(batch.column(0).slice(at, 4096))
                total += y.T @ y
                some = True
        if some:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array([task % SALTS] * width, pa.int32()), pa.array([task] * width, pa.int32()),
                                              pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "salt", "task", "v"])

    return _added(fit.select("x").mapInArrow(run, "i int, salt int, task int, v array<double>"), width)


def _centred(x: np.ndarray, near: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x less the mean, which is the integer ``near`` plus the fraction ``rest``: nothing is lost to the shift."""
    return (x - near).astype(np.float64) - rest


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, ``carry``, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    head = [id_col, *(c for c in carry if c != id_col)]
    spec = "".join(f"`{c}` {embeddings.schema[c].dataType.simpleString()}, " for c in head)
    spec += "component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = integer_vectors(embeddings, vector_col, tuple(head))
    # one row a vector length: the most frequent one decides
    widths = rows.groupBy(F.size("x").alias("w")).agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("m"), F.desc("w")).limit(1).collect()
    if not widths:
        return embeddings.sparkSession.createDataFrame([], spec)
    width = widths[0]["w"]
    rows = rows.where(F.size("x") == width)
    fit = stored(rows.select("x").distinct(), "fit-list")
    n, sums = exact_sums(fit, width)
    near = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    covariance = _product_sums(fit, width, lambda c: _centred(_matrix(c, width), near, rest)) / n
    values, vectors = leading_eigenvectors(covariance, min(components, width))
    trace = float(np.trace(covariance))
    k = int((values > 8 * width * _EPS * trace).sum())
    if not k:
        return embeddings.sparkSession.createDataFrame([], spec)
    turn = vectors[:, :k] / np.sqrt(values[:k])
    white = _product_sums(fit, k, lambda c: _centred(_matrix(c, width), near, rest) @ turn) / n
    error = float(np.abs(white - np.eye(k)).max())
    sent = embeddings.sparkSession.sparkContext.broadcast((near, rest, turn, values[:k] / trace, sums))  # the dimension times COMPONENTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, rest, turn, explained, sums = sent.value
        offset = np.array([s - n * int(m) for s, m in zip(sums, near, strict=True)], np.int64)  # S less n times the integer part of the mean: below n
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _matrix(part.column(len(head)), width)
                m = len(x)
                z = _centred(x, near, rest) @ turn
                pick = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i).take(pick) for i in range(len(head))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                     pa.array(deviations(x - near, n, offset), pa.int64()).take(pick), pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=[*head, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, spec)


def deviations(y: np.ndarray, n: int, offset: np.ndarray) -> list[int | None]:
    """Exact sums over the dimensions of (n * y - offset)^2; None beyond a long."""
    most = n * int(np.abs(y).max(initial=0)) + int(np.abs(offset).max(initial=0))
    if most * most * max(1, y.shape[1]) < 1 << 63:
        d = n * y - offset
        return (d * d).sum(axis=1).tolist()
    fixed = offset.tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, fixed, strict=True)) for row in y.tolist()]
    return [e if e < 1 << 63 else None for e in exact]
