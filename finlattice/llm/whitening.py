"""Whitening of embeddings along the leading eigenvectors of their covariance.

Vectors are made integers, x = floor(256 c). The fit list is each distinct x once; count, sums and the covariance of its centred vectors are added up in Spark,
so that the driver holds no more than dimensions x dimensions numbers. Eigenvectors come from a float32 decomposition and are brought to
double precision by refinement steps of matrix products (Ogita and Aishima); eigenvalues closer than a step can tell apart are
clusters, each of which is solved for itself after a shift.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, parts, pieces, release

#: Steps of a component; integers are below LIMIT in size; refinement steps at most (each squares the error, so few are taken).
GRID, LIMIT, ROUNDS = 256, float(1 << 61), 20
#: Eigenvalues nearer than this share of the largest are one cluster: a quotient by their gap would mostly carry rounding.
NEAR = 1e-6
EPS = float(np.finfo(np.float64).eps)


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One refinement of approximate eigenvectors ``x`` (columns): better ones, their eigenvalues, and the largest correction."""
    r, s = np.eye(len(a)) - x.T @ x, x.T @ a @ x
    # norms of symmetric matrices, bounded by their largest row sums
    s, size = (s + s.T) / 2, np.linalg.norm(a, np.inf)
    value = np.diag(s) / (1 - np.diag(r))
    unsure = max(2 * (np.linalg.norm(s - np.diag(value), np.inf) + size * np.linalg.norm(r, np.inf)), NEAR * size)
    gap = value[None, :] - value[:, None]
    far = np.abs(gap) > unsure
    e = np.where(far, (s + value[None, :] * r) / np.where(far, gap, 1), r / 2)
    x = x + x @ e
    order = np.argsort(value)
    for group in np.split(order, np.flatnonzero(np.diff(value[order]) > unsure) + 1):
        if len(group) > 1:
            x[:, group] = solve_cluster(a, x[:, group], float(value[group].mean()))
    return x, value, float(np.abs(e).max(initial=0))


def solve_cluster(a: np.ndarray, x: np.ndarray, shift: float) -> np.ndarray:
    """A basis of the space of ``x`` that diagonalises ``a`` there; the shift leaves only the cluster's own differences to be rounded."""
    t = x.T @ (a @ x - shift * x)
    return x @ np.linalg.eigh((t + t.T) / 2)[1]


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns, the largest entry positive) of a symmetric matrix in double precision."""
    scale = float(np.abs(a).max(initial=0)) or 1.0
    scaled = a / scale
    x = np.linalg.eigh(scaled.astype(np.float32))[1].astype(np.float64)
    former = np.inf
    for _ in range(ROUNDS):
        x, value, change = refine(scaled, x)
        if change <= 8 * EPS or former < 1e-8 and change > former / 2:  # there, or down to rounding
            break
        former = change
    order = np.argsort(-value, kind="stable")
    x = x[:, order] / np.linalg.norm(x[:, order], axis=0)
    lead = x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])]
    return value[order] * scale, x * np.where(lead < 0, -1.0, 1.0)


def integers(vector: Column) -> Column:
    """The integer vector of an embedding; null if it is null or empty, or holds a null, a non-finite entry or one whose integer isn't below 2^61 in size."""
    wide = F.transform(vector, lambda c: c.cast("double") * GRID)
    good = (F.size(wide) > 0) & F.forall(wide, lambda c: c.isNotNull() & (F.abs(c) < LIMIT))
    return F.when(good, F.transform(wide, lambda c: F.floor(c).cast("long")))


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Exact sums of a partition's integers, by dimension, and its rows."""
    total, n = [0] * dims, 0
    for b in pieces(batches):
        x = _matrix(b.column(0), dims)
        high, low = (x >> 31).sum(axis=0), (x & ((1 << 31) - 1)).sum(axis=0)
        total = [t + (int(h) << 31) + int(w) for t, h, w in zip(total, high, low, strict=True)]
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)), pa.array([n] * dims, pa.int64())], names=["i", "s", "n"])


@dataclass(frozen=True)
class Fit:
    """Count and sums of the fit list, and how to whiten (columns of unit eigenvectors, their eigenvalues, the trace of the covariance)."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    trace: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once: whole parts cancel as integers before."""
        whole, rest = self._mean()
        return (x - whole).astype(np.float64) - rest / self.n

    def _mean(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n for s in self.sums], np.int64)

    def deviations(self, x: np.ndarray, y: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; null where one passes 64 bits."""
        whole, rest = self._mean()
        near = float(self.n) ** 2 * (y * y).sum(axis=1)
        with np.errstate(over="ignore"):
            plain = (((x - whole) * self.n - rest) ** 2).sum(axis=1)
        out = plain.tolist()
        for i in np.flatnonzero(near > 9.2e18).tolist():
            exact = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums, strict=True))
            out[i] = exact if exact < 1 << 63 else None
        return out

    def whiten(self, y: np.ndarray) -> np.ndarray:
        """Coordinates along the components; NaN where the fit list doesn't vary."""
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.values > 0, y @ self.vectors / np.sqrt(self.values), np.nan)


def _products(batches: Iterator[pa.RecordBatch], fit: Fit, whitened: bool) -> Iterator[pa.RecordBatch]:
    """Rows of the sum of outer products of a partition's centred (or whitened) vectors, with what rounding lost beside them."""
    total = None
    for b in pieces(batches):
        y = fit.centred(_matrix(b.column(0), len(fit.sums)))
        if whitened:
            y = fit.whiten(y)
        p = y.T @ y
        if total is None:
            total, lost = np.zeros_like(p), np.zeros_like(p)
        total, lost = _add(total, lost, p)
    if total is not None:
        rows = [np.concatenate(x).tobytes() for x in zip(total, lost, strict=True)]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array([part] * len(rows), pa.int32()), pa.array(rows, pa.binary())], names=["i", "part", "data"])


def _add(total: np.ndarray, lost: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = total + x
    back = new - total
    return new, lost + ((total - (new - back)) + (x - back))


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the partitions' rows of each dimension, in rows sorted by it; one row is held."""
    last, total, lost = None, None, None

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([(total + lost).tobytes()], pa.binary())], names=["i", "data"])

    for b in pieces(batches):
        for i, data in zip(b.column(0).to_pylist(), b.column(2), strict=True):
            row = np.frombuffer(data.as_buffer(), np.float64)
            half = len(row) // 2
            if i != last:
                if last is not None:
                    yield close()
                last, total, lost = i, np.zeros(half), np.zeros(half)
            total, lost = _add(total, lost, row[:half])
            lost = lost + row[half:]
    if last is not None:
        yield close()


def _covariance(fitted: DataFrame, fit: Fit, whitened: bool = False) -> np.ndarray:
    """The covariance of the fit list: dimensions x dimensions numbers on the driver."""
    sums = fitted.select("x").mapInArrow(partial(_products, fit=fit, whitened=whitened), "i int, part int, data binary")
    sums = sums.repartition(parts(fitted.sparkSession), "i").sortWithinPartitions("i", "part").mapInArrow(_add_rows, "i int, data binary")
    return np.stack([np.frombuffer(r.data, np.float64) for r in sorted(sums.collect(), key=lambda r: r.i)]) / fit.n


def fit_whitening(fitted: DataFrame, dims: int, components: int) -> tuple[Fit, float | None]:
    """The fit over distinct integer vectors (``x``), and how far its whitened vectors' covariance is from the identity (None: nothing varies)."""
    exact = fitted.select("x").mapInArrow(partial(_sums, dims=dims), "i int, s decimal(38,0), n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    fit = Fit(exact[0].n, tuple(int(r.s) for r in exact))
    cov = _covariance(fitted, fit)
    cov = (cov + cov.T) / 2
    values, vectors = eigenvectors(cov)
    # what rounding alone may leave of an eigenvalue 0
    values = np.where(values > 8 * EPS * dims * max(float(values[0]), 0.0), values, 0.0)[:components]
    fit = Fit(fit.n, fit.sums, values, vectors[:, :components], float(np.trace(cov)))
    live = values > 0
    if not live.any():
        return fit, None
    off = _covariance(fitted, fit, whitened=True)[np.ix_(live, live)] - np.eye(int(live.sum()))
    return fit, float(np.abs(off).max())


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whiten(batches: Iterator[pa.RecordBatch], fit: Fit, error: float | None) -> Iterator[pa.RecordBatch]:
    k = len(fit.values)
    explained = fit.values / fit.trace if fit.trace > 0 else np.full(k, np.nan)
    for b in pieces(batches):
        x = _matrix(b.column(1), len(fit.sums))
        y, rows = fit.centred(x), len(x)
        white = fit.whiten(y).ravel()
        share = np.tile(explained, rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(b.column(0).fill_null(0).to_numpy(), k), pa.int64(), mask=np.repeat(b.column(0).is_null().to_numpy(zero_copy_only=False), k)),
                pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(np.full(rows * k, fit.n), pa.int64()),
                pa.array([d for d in fit.deviations(x, y) for _ in range(k)], pa.int64()), pa.array(white, mask=np.isnan(white)),
                pa.array(share, mask=np.isnan(share)), pa.array([error] * (rows * k), pa.float64()),
            ],
            names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """Each usable row of ``vectors`` (``vec_id``, ``embedding``; other columns are ignored) along each of the first components.

    Rows whose vector is null, empty, or holds a null or non-finite entry (or one of over 2^53 in size) are dropped. Of vectors of several lengths the most frequent length
    (then the longest) is used and the others are dropped, as they have no place among its components. Repeated rows and null ids stay. With fewer dimensions there are fewer components; a
    component along which nothing varies has a null ``whitened``; ``explained`` is null if nothing varies at all. A ``deviation`` past 64 bits is null.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), integers(F.col("embedding")).alias("x")).where("x IS NOT NULL")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return vectors.sparkSession.createDataFrame([], OUT)
    rows = rows.where(F.size("x") == length.d)
    fitted = durable(rows.select("x").distinct(), "fit-list")
    fit, error = fit_whitening(fitted, length.d, components)
    release(fitted)
    return rows.mapInArrow(partial(_whiten, fit=fit, error=error), OUT)
