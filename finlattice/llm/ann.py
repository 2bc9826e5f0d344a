"""Approximate nearest neighbours by stable projections, kd-trees and a chi-square stopping test.

Largest inner products are nearest points once every vector x gets one more coordinate, sqrt(M^2 - |x|^2) with M
the largest norm, and queries a zero. Vectors are projected to a few dimensions with Gaussian (2-stable)
weights: the squared projected distance over the squared true distance is chi-square distributed. A kd-tree over
the projections has Spark partitions ("cells") as its upper part, split by planes fitted on a sample, and a small
tree in each cell. A query verifies projected neighbours one by one in order of their projected distance, in leaves that
may hold such, and stops when a point as near as its k-th best would have been met already with the wanted
probability. Its home cell gives a first k-th best; then it visits only the cells whose boxes the same test can't rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, parts

#: Projected dimensions; their chi-square quantile of 0.95 (the stopping test); rows of a cell and of a leaf.
DIMS, CHI2, CELL, LEAF = 32, 46.194, 2048, 64
#: Rows on which split planes are fitted, and cells of the upper tree: bounds of what the driver holds. Larger cells go in slices of at most about SLICE rows.
SAMPLE, MAX_CELLS, SLICE = 50_000, 1 << 16, 1 << 16
#: Queries that search a cell at once, and numbers of a block of distances to the cells' boxes.
BLOCK, BOXES = 256, 1 << 20


@dataclass(frozen=True)
class Index:
    """Projection and upper tree; ``low`` and ``high`` are the boxes of the cells' actual points."""

    weights: np.ndarray  # (dimensions + 1) x DIMS
    top: float  # M squared
    dims: np.ndarray  # split dimension and value of each inner node, breadth first
    values: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))
        return np.hstack((x, extra[:, None]))

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        return self.lift(x, query) @ self.weights

    def cell(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), np.int64)
        for _ in range(int(np.log2(len(self.dims) + 1))):
            node = 2 * node + 1 + (p[np.arange(len(p)), self.dims[node]] > self.values[node])
        return node - len(self.dims)


def _planes(p: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Median splits along the widest dimension."""
    dims, values = np.zeros((1 << levels) - 1, np.int64), np.zeros((1 << levels) - 1)
    groups = [p]
    for node in range(len(dims)):
        g = groups[node]
        if len(g):
            dims[node] = int(np.argmax(g.max(axis=0) - g.min(axis=0)))
            values[node] = float(np.median(g[:, dims[node]]))
        right = g[:, dims[node]] > values[node] if len(g) else np.zeros(0, bool)
        groups += [g[~right], g[right]]
    return dims, values


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def _search_cell(index: Index, ids: np.ndarray, x: np.ndarray, queries: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(query, ids, scores, number verified) of each query's best k in one cell that beat its bound (a squared distance)."""
    p, pq = index.project(x, False), index.project(q, True)
    order = np.arange(len(p))
    spans = [(0, len(p))]
    while spans and spans[0][1] - spans[0][0] > LEAF:  # a median kd-tree, level by level
        nxt = []
        for a, b in spans:
            own = p[order[a:b]]
            d, m = int(np.argmax(own.max(axis=0) - own.min(axis=0))), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, d], m)]
            nxt += [(a, a + m), (a + m, b)]
        spans = nxt
    x, p, ids = x[order], p[order], ids[order]
    starts = np.array([a for a, _ in spans])
    low, high = np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)
    leaf = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(p))))
    for j in range(0, len(queries), BLOCK):
        part, worst = pq[j : j + BLOCK], bound[j : j + BLOCK].astype(float)
        near = (_away(low, high, part) <= CHI2 * worst[:, None]).any(axis=0)  # leaves that a query of the block may need
        rows = np.flatnonzero(near[leaf])
        if not len(rows):
            continue
        away = (part * part).sum(axis=1)[:, None] - 2 * part @ p[rows].T + (p[rows] * p[rows]).sum(axis=1)
        for i in range(len(part)):
            yield (j + i, *_incremental(away[i], rows, x, q[j + i], ids, worst[i], index.top, k))


def _incremental(away: np.ndarray, rows: np.ndarray, x: np.ndarray, q: np.ndarray, ids: np.ndarray, worst: float, top: float, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Verifies points in order of their projected distances ``away`` until the stopping test holds."""
    offset, step, at = float(q @ q) + top, 2 * k, 0
    have_rows, have = np.zeros(0, np.int64), np.zeros(0)
    order = np.argsort(away) if np.isinf(worst) else np.flatnonzero(away <= CHI2 * worst)
    order = order if np.isinf(worst) else order[np.argsort(away[order])]
    away = away[order]
    while at < len(order) and away[at] <= CHI2 * worst:  # the stopping test
        stop = min(at + step, int(np.searchsorted(away, CHI2 * worst, "right")))
        take = rows[order[at:stop]]
        at, step = stop, step * 2
        dist = offset - 2 * (x[take] @ q)
        have_rows, have = np.concatenate((have_rows, take[dist <= worst])), np.concatenate((have, dist[dist <= worst]))
        if len(have) > k:
            cut = np.partition(have, k - 1)[k - 1]
            have_rows, have = have_rows[have <= cut], have[have <= cut]  # ties stay
        if len(have) >= k:
            worst = min(worst, float(have.max()))
    return ids[have_rows], (x[have_rows] * q).sum(axis=1), at


def _away(low: np.ndarray, high: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes (points x boxes), a dimension at a time."""
    out = np.zeros((len(p), len(low)))
    for d in range(p.shape[1]):
        gap = np.maximum(np.maximum(low[None, :, d] - p[:, d, None], p[:, d, None] - high[None, :, d]), 0)
        out += gap * gap
    return out


def _search(batches: Iterator[pa.RecordBatch], index: Index, k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, slice, kind): a cell's points, then the queries that visit it."""
    open_cell, held, asked = None, [], []

    def close() -> Iterator[pa.RecordBatch]:
        if not held or not asked:
            return
        ids, x = np.concatenate([a for a, _ in held]), np.concatenate([a for _, a in held])
        names, q, bound = (np.concatenate([a[i] for a in asked]) for i in range(3))
        out = [[], [], []]
        for i, found, scores, _ in _search_cell(index, ids, x, names, q, bound, k):
            out[0].append(np.full(len(found), names[i]))
            out[1].append(found)
            out[2].append(scores)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["query", "rep", "score"])

    for b in batches:
        cell, kind, vec = b.column("cell").to_numpy().astype(np.int64) << 32 | b.column("slice").to_numpy(), b.column("kind").to_numpy(), b.column("vec").to_numpy()
        x, bound = _matrix(b.column("embedding")), b.column("bound").to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])))) if len(cell) else []
        for a, z in zip(cuts, [*cuts[1:], len(cell)], strict=True):
            if cell[a] != open_cell:
                yield from close()
                open_cell, held, asked = cell[a], [], []
            if kind[a] == 0:
                held.append((vec[a:z], x[a:z]))
            else:
                asked.append((vec[a:z], x[a:z], bound[a:z]))
    yield from close()


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: vec_id and vector not null, all components finite, not all zero."""
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(~odd).where(F.exists("embedding", lambda v: v != 0))


def _first_of_equals(rows: DataFrame, keep: int) -> DataFrame:
    """At most ``keep`` rows with the smallest vec_id of each vector, dropping to that number in salted steps."""
    for salt in (64, 8, 1):
        w = Window.partitionBy("h1", "h2", F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(salt))).orderBy("vec_id")
        rows = rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= keep).drop("n")
    return rows


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, seed: int = 7) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest of every vector whose vec_id is divisible by ``every``.

    Nearness is the inner product in double precision; ties go to the smaller vec_id; a vector isn't its own neighbour,
    but equal vectors are neighbours of each other. Fewer than k candidates give fewer rows. Vectors that
    are null, zero or hold null or non-finite components take no part, nor do rows without vec_id or, if lengths
    differ, vectors of another length than the most frequent one. A vec_id that occurs twice is two candidates.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v)).alias("top")).orderBy(F.desc("n"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    d, n, top = lengths[0]
    rng = np.random.default_rng(seed)
    weights = rng.standard_normal((d + 1, DIMS))
    rows = rows.where(F.size("embedding") == d).withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})
    ids = rows.select("h1", "h2", "vec_id")
    # a point for each distinct vector, with a number of its own
    grouped = _first_of_equals(ids, k + 1).groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    members = durable(grouped.withColumn("vec", F.monotonically_increasing_id()), "members")
    points = rows.join(members.select("h1", "h2", "vec", F.col("ids")[0].alias("first")), ["h1", "h2"]).where("vec_id = first")
    points = points.groupBy("vec").agg(F.min("embedding").alias("embedding"))
    sample = points.select("embedding").where(F.pmod(F.xxhash64("vec", F.lit(seed)), F.lit(1 << 30)) < (1 << 30) * min(1.0, SAMPLE / n)).limit(2 * SAMPLE).toArrow()
    levels = max(0, int(np.ceil(np.log2(min(n / CELL, MAX_CELLS))))) if n > CELL else 0
    bare = Index(weights, float(top), np.zeros(0, np.int64), np.zeros(0))
    seen = bare.project(_matrix(sample.column(0).combine_chunks()), False) if sample.num_rows else np.zeros((0, DIMS))
    del sample
    bare = Index(weights, float(top), *_planes(seen, levels))
    vector = points.schema["embedding"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = bare.project(_matrix(b.column("embedding")), False)
                yield pa.RecordBatch.from_arrays([pa.array(bare.cell(p).astype(np.int32)), *b.columns, pa.array(list(p), pa.list_(pa.float64()))], names=["cell", "vec", "embedding", "p"])

    placed = durable(points.mapInArrow(place, f"cell int, vec long, embedding {vector}, p array<double>"), "cells")
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), *(f(F.col("p")[i]).alias(f"{n}{i}") for i in range(DIMS) for n, f in (("low", F.min), ("high", F.max)))).collect()
    low, high, slices = np.full((1 << levels, DIMS), np.inf), np.full((1 << levels, DIMS), -np.inf), np.ones(1 << levels, np.int64)
    for r in boxes:
        low[r.cell], high[r.cell] = [r[f"low{i}"] for i in range(DIMS)], [r[f"high{i}"] for i in range(DIMS)]
        slices[r.cell] = -(-r.n // SLICE)
    index = Index(weights, float(top), bare.dims, bare.values, low, high)

    wanted = ids.where(F.pmod("vec_id", F.lit(every)) == 0).withColumnRenamed("vec_id", "query_id").join(members.select("h1", "h2", "vec"), ["h1", "h2"]).select("query_id", "vec")
    queries = placed.select("vec", "embedding").join(wanted.select("vec").distinct(), "vec")

    def visits(batches: Iterator[pa.RecordBatch], home: bool) -> Iterator[pa.RecordBatch]:
        """The home cell of each query, or the other cells that the test can't rule out; every slice of them."""
        size = max(1, BOXES // len(index.low))
        for whole in batches:
            for b in (whole.slice(i, size) for i in range(0, whole.num_rows, size)):
                away = _away(index.low, index.high, index.project(_matrix(b.column("embedding")), True))
                best = away.argmin(axis=1)
                if home:
                    at, cells = np.arange(len(away)), best
                    bound = np.full(len(away), np.inf)
                else:
                    bound = b.column("bound").to_numpy()
                    ok = away <= CHI2 * bound[:, None]
                    ok[np.arange(len(away)), best] = False
                    at, cells = np.nonzero(ok)
                    bound = bound[at]
                times = slices[cells]
                nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                at, cells, bound = (np.repeat(v, times) for v in (at, cells, bound))
                part = b.take(pa.array(at))
                columns = [pa.array(cells.astype(np.int32)), pa.array(nth.astype(np.int32)), pa.array(np.ones(len(at), np.int32)), part.column("vec"), part.column("embedding"), pa.array(bound)]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "slice", "kind", "vec", "embedding", "bound"])

    layout = f"cell int, slice int, kind int, vec long, embedding {vector}, bound double"
    parted = F.broadcast(spark.createDataFrame([(r.cell, int(slices[r.cell])) for r in boxes], "cell int, slices int"))  # at most MAX_CELLS rows
    stored = placed.join(parted, "cell").select("cell", F.pmod(F.xxhash64("vec"), F.col("slices")).cast("int").alias("slice"), F.lit(0).alias("kind"), "vec", "embedding", F.lit(0.0).alias("bound"))

    def search(asked: DataFrame) -> DataFrame:
        both = stored.unionByName(asked).repartition(parts(spark), "cell", "slice").sortWithinPartitions("cell", "slice", "kind", "vec")
        return both.mapInArrow(lambda b: _search(b, index, k + 1), "query long, rep long, score double")

    first = durable(search(queries.mapInArrow(lambda b: visits(b, True), layout)), "home")
    # the k-th best so far as a squared distance in the lifted space
    ranked = first.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"))))
    kth = ranked.where(F.col("n") == k + 1).select(F.col("query").alias("vec"), F.col("score").alias("kth"))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v)
    bounded = queries.join(kth, "vec", "left").select("vec", "embedding", F.coalesce(square + float(top) - 2 * F.col("kth") + 1e-9, F.lit(float("inf"))).alias("bound"))
    found = first.unionByName(search(bounded.mapInArrow(lambda b: visits(b, False), layout)))
    named = found.join(members.select(F.col("vec").alias("rep"), "ids"), "rep")
    best = named.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0]))).where(F.col("n") <= k + 1).drop("n")
    each = best.select(F.col("query").alias("vec"), "score", F.explode("ids").alias("vec_id"))
    own = Window.partitionBy("vec").orderBy(F.desc("score"), "vec_id")
    few = each.withColumn("n", F.row_number().over(own)).where(F.col("n") <= k + 1).drop("n")
    pairs = wanted.join(few, "vec").withColumn("itself", (F.col("vec_id") == F.col("query_id")).cast("int"))
    once = Window.partitionBy("query_id", "vec_id").orderBy(F.desc("score"))
    pairs = pairs.withColumn("self_n", F.row_number().over(once)).where("itself = 0 OR self_n > 1")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
