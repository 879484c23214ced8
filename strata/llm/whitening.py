"""Whitening of embeddings by the leading eigenvectors of their covariance.

Three passes over the vectors, each a map with small results per task: sums of every
dimension; products of the centred vectors (d(d+1)/2 numbers a task); projections. The
covariance is d by d whatever the number of vectors. Its eigenvectors are found on the
driver: Householder reflections make it tridiagonal, Sturm counts bisect the leading
eigenvalues, inverse iteration gives the vectors, made orthogonal within clusters of
close eigenvalues. They are broadcast and every vector is projected on them.

Entries become whole numbers first. Centring subtracts the whole number next to the mean
before multiplying, and the fraction left (half a unit at most) afterwards, so that products
of ordinary embeddings are exact and do not depend on how the rows were dealt.

Vectors that are null or hold null or non-finite entries are dropped. Shorter vectors are
filled up with zero entries. Entries beyond 2**30 in size count as 2**30. Rows with null or
repeated ids are rows like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import saved

SCALE, SHIFT = 1024, 100_000
_MOST = 1 << 40
_EPS = np.finfo(float).eps


def sound(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v)`` of the rows whose vector has finite entries only."""
    v = F.col("v")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(v.isNotNull() & fine)


def whole_numbers(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Entries as whole numbers, a row per vector, filled up to ``dims``; and the vectors' lengths."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(size.max(initial=0)) if dims is None else dims
    flat = column.flatten().to_numpy(zero_copy_only=False)
    x = np.clip(np.floor(SCALE * flat), -_MOST, _MOST).astype(np.int64) + SHIFT
    if len(size) and (size == width).all():
        return x.reshape(len(size), width), size
    out = np.full((len(size), width), SHIFT, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)] = x
    return out, size


def sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of every dimension."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, size = whole_numbers(batch.column(0))
            there = (size[:, None] > np.arange(x.shape[1])).sum(0)
            total = x.sum(0) - SHIFT * (len(x) - there)     # without what was filled in
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(x.shape[1])], pa.int32()), pa.array([0, *total.tolist()], pa.int64()),
                                              pa.array([len(x), *there.tolist()], pa.int64())], names=["dim", "total", "n"])
    parts = vectors.select("v").mapInArrow(run, "dim int, total long, n long")
    rows = {r["dim"]: r for r in parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                          F.sum("n").alias("n")).collect()}      # a row per dimension
    n = rows[-1]["n"] if rows else 0
    return n, [int(rows[j]["total"]) + SHIFT * (n - rows[j]["n"]) for j in range(len(rows) - 1)]


class Centre:
    """The mean as the next whole number and ``rest / n``."""

    def __init__(self, n: int, totals: list[int]):
        self.n, self.whole = n, np.array([(2 * s + n) // (2 * n) for s in totals], np.int64)
        self.rest = [s - n * int(k) for s, k in zip(totals, self.whole, strict=True)]
        self.fraction = np.array([r / n for r in self.rest])

    def deviations(self, y: np.ndarray) -> list[int]:
        """Exact sum over dimensions of (n * x - S) ** 2 for rows of x less ``whole``."""
        n, most = self.n, int(np.abs(y).max(initial=0))
        top = max(map(abs, self.rest), default=0)
        fits = y.shape[1] * max(most * most, most * top) < 1 << 62
        y = y if fits else y.astype(object)
        rest = np.array(self.rest, np.int64 if fits else object)
        squares, crossed = (y * y).sum(1).tolist(), (y * rest).sum(1).tolist()
        own = sum(r * r for r in self.rest)
        return [n * n * q - 2 * n * r + own for q, r in zip(squares, crossed, strict=True)]


def covariance(vectors: DataFrame, centre: Centre) -> np.ndarray:
    """Covariance (divisor n) of the whole numbers of all vectors."""
    d = len(centre.whole)
    shared = vectors.sparkSession.sparkContext.broadcast(centre)

    def run(batches) -> Iterator[pa.RecordBatch]:
        c, total = shared.value, np.zeros((d, d))
        for batch in batches:
            y = (whole_numbers(batch.column(0), d)[0] - c.whole).astype(float)
            total += y.T @ y
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "p"])
    parts = vectors.select("v").mapInArrow(run, "i int, j int, p double")
    out = np.zeros((d, d))
    for r in parts.groupBy("i", "j").agg(F.sum("p").alias("p")).collect():      # d(d+1)/2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["p"]
    return out / centre.n - np.outer(centre.fraction, centre.fraction)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors that lead there (each of length one or zero)."""
    a, mirrors = np.array(a, float), []
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        length = np.linalg.norm(v)
        if length > 0:
            v[0] += length if v[0] >= 0 else -length
            v /= np.linalg.norm(v)
            part = a[k + 1:, k + 1:]
            p = part @ v
            w = 2 * (p - (v @ p) * v)
            part -= np.outer(v, w) + np.outer(w, v)
            head = a[k + 1:, k] - 2 * (v @ a[k + 1:, k]) * v
            a[k + 1:, k] = a[k, k + 1:] = head
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each x: negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / _EPS
    count, q = np.zeros(len(x), int), np.ones(len(x))
    for k, d in enumerate(diagonal):
        with np.errstate(over="ignore"):        # an infinite pivot is one of its sign
            q = d - x - (off[k - 1] ** 2 / q if k else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection to the last bit."""
    n = len(diagonal)
    beside = np.abs(np.append(0, off)) + np.abs(np.append(off, 0))
    low, high = np.full(k, (diagonal - beside).min()), np.full(k, (diagonal + beside).max())
    room = 2 * _EPS * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - room, high + room
    at_most = n - np.arange(k)          # eigenvalues below the upper end of each
    while True:
        middle = (low + high) / 2
        inside = (low < middle) & (middle < high)
        if not inside.any():
            return (low + high) / 2
        above = sturm_count(diagonal, off, middle) >= at_most
        high, low = np.where(inside & above, middle, high), np.where(inside & ~above, middle, low)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, small: float) -> np.ndarray:
    """Solution of (T - shift) z = b by elimination with row exchanges; zero pivots become ``small``."""
    n = len(diagonal)
    main, up, up2, z = diagonal - shift, np.append(off, 0.0), np.zeros(n), b.copy()
    for k in range(n - 1):
        below, next_main, next_up = off[k], main[k + 1], up[k + 1]
        if abs(below) > abs(main[k]):
            factor = main[k] / below
            main[k], main[k + 1] = below, up[k] - factor * next_main
            up[k], up[k + 1] = next_main, -factor * next_up
            up2[k] = next_up
            z[k], z[k + 1] = z[k + 1], z[k] - factor * z[k + 1]
        else:
            if abs(main[k]) < small:
                main[k] = small
            factor = below / main[k]
            main[k + 1] = next_main - factor * up[k]
            z[k + 1] -= factor * z[k]
    for k in reversed(range(n)):
        pivot = main[k] if abs(main[k]) >= small else small
        rest = z[k] - (up[k] * z[k + 1] if k + 1 < n else 0) - (up2[k] * z[k + 2] if k + 2 < n else 0)
        z[k] = rest / pivot
        if abs(z[k]) > 1e200:       # the direction alone counts
            z /= abs(z[k])
    return z


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues; those of a cluster are kept orthogonal in every step."""
    n, rng = len(diagonal), np.random.default_rng(0)
    norm = max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0))
    small, out, first = max(_EPS * norm, np.finfo(float).tiny), np.zeros((n, len(values))), 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * norm:
            first = i
        z = rng.standard_normal(n)
        for _ in range(6):
            z = _solve(diagonal, off, value - 2 * (i - first) * _EPS * norm, z / np.linalg.norm(z), small)
            z /= np.abs(z).max()
            for _ in range(2):      # twice is enough
                z -= out[:, first:i] @ (out[:, first:i].T @ z)
        out[:, i] = z / np.linalg.norm(z)
    return out


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    diagonal, off, mirrors = tridiagonal(a)
    k = min(k, len(diagonal))
    values = leading_values(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for start, v in reversed(list(enumerate(mirrors))):
        vectors[start + 1:] -= 2 * np.outer(v, v @ vectors[start + 1:])
    return values, vectors


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """A row per sound vector and component: ``id_col``, ``component`` (from 1, by falling eigenvalue), ``n``,
    ``deviation`` (decimal: exact sum over dimensions of (n * x - S) ** 2), ``whitened``, ``explained`` (share of the trace) and
    ``identity_error`` (largest entry of the whitened columns' covariance less the identity).

    A component without variance has null ``whitened`` and takes no part in the error, which is
    null if there is no other; ``explained`` is null if nothing varies. Fewer dimensions than
    components: that many rows. No sound vector, or only empty ones: no row. Equal eigenvalues:
    any orthonormal vectors of their space."""
    vectors = sound(df, id_col, vector_col)
    n, totals = sums(vectors)
    centre = Centre(max(n, 1), totals)
    cov = covariance(vectors, centre) if totals else np.zeros((0, 0))
    values, axes = leading_components(cov, components) if totals else (np.zeros(0), np.zeros((0, 0)))
    trace, k = float(np.trace(cov)), len(values)
    alive = (values > len(totals) * 4 * _EPS * values.max(initial=0)) & (trace > 0)
    scaled = axes / np.sqrt(np.where(alive, values, 1))
    shared = df.sparkSession.sparkContext.broadcast((centre, scaled, alive))

    def run(batches) -> Iterator[pa.RecordBatch]:
        c, along, live = shared.value
        for batch in batches:
            y = whole_numbers(batch.column(1), len(c.whole))[0] - c.whole
            w = (y - c.fraction) @ along
            flat = pa.array(w.ravel(), mask=~np.broadcast_to(live, w.shape).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * k, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([Decimal(x) for x in c.deviations(y)], pa.decimal128(38, 0)), lists],
                                             names=["id", "deviation", "w"])
    kind = vectors.schema["id"].dataType.simpleString()
    wide = saved(vectors.mapInArrow(run, f"id {kind}, deviation decimal(38,0), w array<double>"), "whitened")
    live = np.flatnonzero(alive).tolist()
    pairs = [(i, j) for i in live for j in live if i <= j]
    # covar_pop merges centred moments of each task.
    far = [F.abs(F.covar_pop(F.col("w")[i], F.col("w")[j]) - float(i == j)) for i, j in pairs]
    error = wide.agg(F.greatest(*far, F.lit(0.0))).first()[0] if pairs and n else None
    share = F.lit([float(v) / trace if trace > 0 else None for v in values] or [None]).cast("array<double>")
    return wide.select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


__all__ = ["sound", "whole_numbers", "sums", "Centre", "covariance", "tridiagonal", "sturm_count", "leading_values",
           "inverse_iteration", "leading_components", "whiten"]
