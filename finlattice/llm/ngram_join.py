"""N-gram Jaccard join with count-vector R-trees, and the near-duplicate classes built on it.

How it finds every link without comparing all documents:

1. Equal shingle sets collapse to one node, named by a hash of the set.
2. The hash range is cut into groups. Two sets that link differ in few shingles, so with enough groups at
   least one non-empty group holds the same shingles in both (pigeonhole). Each set emits a key for its
   groups; sets that share a key are candidates. A key says which class of sizes, which group and
   which shingles, so a passage that many documents share makes no large block: its groups also hold
   the documents' own shingles. Equal keys are joined in Spark as stars to their smallest node.
3. Candidate nodes form components. A component is cut into tiles of bounded size: pairs of hashed chunks of
   nodes whose sizes may link, but for those that earlier tiles have connected with each other. In each tile the group counts of the sets are points of an R-tree; a search
   bounds the overlap of two sets by the sum of coordinate minima of their counts, down the tree. What the
   bounds keep together are the components whose sets are compared; unrelated texts that a few common
   shingles brought together part here, at the price of their counts and not of their sets.
4. These components are tiled again, now with the sets. Trees and bounds pick the pairs, and those that
   aren't connected yet are verified. Links of all tiles are merged to components again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, join_spread, parts, pieces
from .components import components, forest
from .shingles import mix64, shingle_sets, slices

U64 = np.uint64
#: Sizes are classed by these lower ends: each of 1 to 5 for itself, then each 1.5 times the one before.
_ENDS = np.unique(np.concatenate((np.arange(1, 6), 6 * 1.5 ** np.arange(60))).astype(np.int64))
#: Nodes of a tile side, with sets and with points only; coordinates of a point (few suffice for small sets); children of a tree node.
TILE, POINT_TILE, COORDS, FEW, FEW_UPTO, FANOUT = 128, 512, 256, 64, 500, 16


def set_id(s: np.ndarray) -> int:
    """The node of a set: a signed 64-bit hash (two sets in 10^9 share one with a probability of 0.03)."""
    return int(mix64(np.array([mix64(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64) + U64(len(s))]))[0].astype(np.int64))


def group_keys(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set, one of which at least it shares with every other set of similarity num/den or more.

    A partner differs in d shingles at most; each differing shingle spoils one group at most. In every class
    of sizes that a pair may have, groups of m shingles or fewer give no key if even without them
    more than d groups are left (m as large as that allows). As a shared group has one size in both
    sets, and a smaller m only adds keys, both sets have the key. Below 6 shingles groups would often be
    empty; where d is 1 there, the keys are the whole set and the sets without one of their shingles.
    """
    n = len(s)
    low = -(-num * n // den)
    classes = range(max(0, int(np.searchsorted(_ENDS, low, "right")) - 1), int(np.searchsorted(_ENDS, n, "right")))
    out, sums = [], np.concatenate((np.zeros(1, U64), np.cumsum(mix64(s ^ U64(0x2545F4914F6CDD1D)), dtype=U64)))
    for c in classes:
        top = min(int(_ENDS[c + 1]) - 1, 1 << 40)
        if top < 6 and (den - num) * top // num <= 1:
            value = np.concatenate((sums[-1:], sums[-1] - np.diff(sums)))
            out.append(mix64(value ^ mix64(np.full(len(value), (c + 1) << 40, U64))))
            continue
        groups = (den - num) * top // num * 3 // 2 + 3
        differ = (den - num) * min(n, top) // num
        edges = np.searchsorted(s, (np.arange(1, groups) * ((1 << 64) / groups)).astype(U64))
        at = np.concatenate(([0], edges, [n]))
        count = np.diff(at)
        sizes = np.sort(count)
        keep = np.flatnonzero(count >= sizes[groups - differ - 1])
        value = sums[at[keep + 1]] - sums[at[keep]]
        out.append(mix64(value ^ mix64(keep.astype(U64) + (U64(c + 1) << U64(40)) + (count[keep].astype(U64) << U64(48)))))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def _nodes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        sizes, ids, points = [], [], []
        for s in shingle_sets(b.column(1), k):
            sizes.append(len(s))
            ids.append(set_id(s) if len(s) else None)
            points.append(point(s).astype(np.uint16 if len(s) < 1 << 16 else np.uint32).tobytes())
        made = [b.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(points, pa.binary())]
        yield pa.RecordBatch.from_arrays([*made, *b.columns[2:]], names=["doc_id", "n_shingles", "sid", "point", *b.schema.names[2:]])


def _emit(batches: Iterator[pa.RecordBatch], k: int, keys_of: Callable[[np.ndarray], np.ndarray], least: int) -> Iterator[pa.RecordBatch]:
    """(key, sid, hub): a batch keeps one node of each key as its hub; the others go as an edge to the hub."""
    for b in batches:
        col = b.column(0)
        for i, j in slices(col):
            keys, sids = [], []
            for s in shingle_sets(col.slice(i, j - i), k):
                if len(s) >= least:
                    own = keys_of(s)
                    keys.append(own)
                    sids.append(np.full(len(own), set_id(s), np.int64))
            if not keys:
                continue
            key, sid = np.concatenate(keys), np.concatenate(sids)
            order = np.lexsort((sid, key))
            key, sid = key[order], sid[order]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            hub = sid[np.flatnonzero(new)][np.cumsum(new) - 1]
            other = ~new & (sid != hub)
            a, h = forest(sid[other], hub[other]) if other.any() else (sid[:0], sid[:0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((key[new], mix64(a.view(U64)).view(np.int64)))), pa.array(np.concatenate((sid[new], a))), pa.array(np.concatenate((sid[new], h)))], names=["key", "sid", "hub"]
            )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of key-sorted rows, a spanning forest for each batch."""
    last_key = last_hub = None
    for b in batches:
        if not b.num_rows:
            continue
        key, sid, hub = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        new = np.concatenate(([key[0] != last_key], key[1:] != key[:-1]))
        first = np.where(new)[0]
        lead = sid[first]
        if not new[0]:
            first, lead = np.concatenate(([0], first)), np.concatenate(([last_hub], lead))
            new = new.copy()
            new[0] = True
        star = lead[np.cumsum(new) - 1]
        last_key, last_hub = key[-1], star[-1]
        a, h = np.concatenate((sid, sid)), np.concatenate((star, hub))
        keep = a != h
        if keep.any():
            a, h = forest(a[keep], h[keep])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(h)], names=["a", "b"])


class CountTree:
    """An R-tree over count vectors: nodes keep the largest and the smallest set size and the largest counts."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray) -> None:
        order = np.lexsort((*counts.T[:2], sizes))
        self.levels = []  # of (first child, end, largest counts, smallest size, largest size), leaves first
        self.order, self.counts, self.sizes = order, counts[order], sizes[order]
        low = high = self.sizes
        top = self.counts
        while True:
            at = np.arange(0, len(top), FANOUT)
            top, low, high = np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high))
            if len(top) == 1:
                break

    def search(self, counts: np.ndarray, size: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """Points whose overlap with the query may suffice, best bound first, and the bounds."""
        def may(top: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            bound = np.minimum(top, counts).sum(axis=1)
            return (bound * (num + den) >= num * (size + low)) & (den * high >= num * size) & (den * size >= num * low), bound

        at = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = (x[at] for x in self.levels[depth])
            at = at[may(top, low, high)[0]]
            below = len(self.levels[depth - 1][0]) if depth else len(self.sizes)
            at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            at = at[at < below]
        ok, bound = may(self.counts[at], self.sizes[at], self.sizes[at])
        at, bound = at[ok], bound[ok]
        best = np.argsort(-bound, kind="stable")
        return self.order[at[best]], bound[best]


def point(s: np.ndarray) -> np.ndarray:
    """Group counts of a set; these groups are cut across those of the keys."""
    return np.bincount((mix64(s) >> U64(56)).astype(np.int64), minlength=COORDS).astype(np.int32)


def folded(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Points with coordinates added up to a few, if all sets are small; the bounds stay bounds."""
    return counts.reshape(len(counts), FEW, -1).sum(axis=2) if len(sizes) and sizes.max() <= FEW_UPTO else counts


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether den * intersection >= num * union, for sorted distinct arrays."""
    common = len(x) + len(y) - len(np.union1d(x, y))
    return den * common >= num * (len(x) + len(y) - common)


def solve_tile(sids: np.ndarray, sizes: np.ndarray, counts: np.ndarray, side: np.ndarray, num: int, den: int, sets: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Edges between the two sides of a tile (side 2: within one chunk), enough of them to connect what is linked.

    With ``sets`` the links are verified; without, what the bounds allow counts as linked.
    """
    parent = np.arange(len(sids))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    counts = folded(counts, sizes)
    tree, out = CountTree(counts, sizes), []
    for i in np.flatnonzero(side != 1).tolist():
        for j in tree.search(counts[i], int(sizes[i]), num, den)[0].tolist():
            if (j > i if side[i] == 2 else side[i] == 0 and side[j] == 1) and (a := root(i)) != (b := root(j)) and (sets is None or linked(sets[i], sets[j], num, den)):
                parent[max(a, b)] = min(a, b)
                out.append((int(sids[i]), int(sids[j])))
    return out


def _tiles(batches: Iterator[pa.RecordBatch], num: int, den: int, verify: bool) -> Iterator[pa.RecordBatch]:
    """Solves tiles in rows sorted by (comp, tile); a tile may run over several batches. ``data``: the set, or its point."""
    open_key, sids, data, sides = None, [], [], []

    def close() -> Iterator[pa.RecordBatch]:
        if len(sids) > 1:
            if verify:
                sets = [np.frombuffer(x, U64) for x in data]
                sizes, counts = np.array([len(x) for x in sets], np.int64), np.stack([point(x) for x in sets])
            else:
                sets, counts = None, np.stack([np.frombuffer(x, np.uint16 if len(x) == 2 * COORDS else np.uint32).astype(np.int32) for x in data])
                sizes = counts.sum(axis=1).astype(np.int64)
            found = solve_tile(np.array(sids), sizes, counts, np.array(sides), num, den, sets)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for b in pieces(batches):
        for row in zip(*(b.column(n).to_pylist() for n in ("comp", "tile", "side", "sid", "data")), strict=True):
            if row[:2] != open_key:
                yield from close()
                open_key, sids, data, sides = row[:2], [], [], []
            elif row[3] == sids[-1]:  # equal rows of one document
                continue
            sides.append(row[2])
            sids.append(row[3])
            data.append(row[4])
    yield from close()


def _size_class(num: int, den: int) -> Column:
    """Classes of sizes so wide that only sets of one class or of neighbouring ones can link."""
    return F.floor(F.log("n") / (float(np.log(den / num)) * 1.01)).cast("int")


def _tiled(rows: DataFrame, num: int, den: int, verify: bool, rest: bool = False) -> DataFrame:
    """Edges found in the tiles of ``rows`` (comp, sid, n, chunks: size class to number of chunks, data).

    A small component is one tile. Else a node first meets its own chunk and the first chunks of its own class of sizes and of
    the two next to it: a number of tiles in proportion to the nodes. With ``rest`` the rows have a column ``core`` that is
    true for nodes connected with each other already; nodes that aren't meet all chunks of theirs and of the core.
    """
    total = F.aggregate(F.map_values("chunks"), F.lit(0), lambda a, c: a + c)
    c, m = F.col("c"), F.col("mine")
    none = F.array().cast("array<struct<tile:string,side:int>>")

    def count(cls: Column, core: bool) -> Column:
        return F.coalesce(F.try_element_at("chunks", 2 * cls + int(core)), F.lit(0))

    def grid(n: Column, make: Callable[[Column], Column], start: int = 0) -> Column:
        return F.when(n > start, F.transform(F.sequence(F.lit(start), n - 1), make)).otherwise(none)

    def cell(kind: str, low: Column, high: Column, x: Column | int, y: Column, side: Column | int) -> Column:
        x, side = (v if isinstance(v, Column) else F.lit(v) for v in (x, side))
        return F.struct(F.concat_ws(":", F.lit(kind), low, high, x, y).alias("tile"), side.cast("int").alias("side"))

    if rest:
        among = [
            grid(count(c, False), lambda o: cell("r", c, c, F.least(o, m), F.greatest(o, m), F.when(o == m, 2).when(m < o, 0).otherwise(1))),
            grid(count(c + 1, False), lambda o: cell("r", c, c + 1, m, o, 0)),
            grid(count(c - 1, False), lambda o: cell("r", c - 1, c, o, m, 1)),
        ]

        # functions of one argument: Spark takes a lambda's second one, a default too, for the place in the array
        def to_core(d: int) -> Column:
            return grid(count(c + d, True), lambda o: cell("x", c, c + d, m, o, 0))

        def to_others(d: int) -> Column:
            return grid(count(c - d, False), lambda o: cell("x", c - d, c, o, m, 1))

        with_core, from_core = ([f(d) for d in (-1, 0, 1)] for f in (to_core, to_others))
        tiles = F.when(F.col("core"), F.concat(*from_core)).otherwise(F.concat(*among, *with_core))
        mine = count(c, False)
        mine = F.when(F.col("core"), count(c, True)).otherwise(mine)
    else:
        first = m == 0
        tiles = F.concat(
            F.array(cell("f", c, c, m, m, 2)),
            F.when(first, grid(count(c, False), lambda o: cell("f", c, c, 0, o, 0), 1)).otherwise(F.array(cell("f", c, c, 0, m, 1))),
            F.when(first, grid(count(c + 1, False), lambda o: cell("f", c, c + 1, 0, o, 0))).otherwise(none),
            F.when(count(c - 1, False) > 0, F.array(cell("f", c - 1, c, 0, m, 1))).otherwise(none),
        )
        tiles = F.when(total == 0, F.array(F.struct(F.lit("").alias("tile"), F.lit(2).alias("side")))).otherwise(tiles)
        mine = count(c, False)
    placed = rows.withColumn("c", _size_class(num, den)).withColumn("mine", F.pmod(F.xxhash64("sid"), F.greatest(mine, F.lit(1))).cast("int"))
    placed = placed.select("comp", "sid", "data", F.explode(tiles).alias("t"))
    dealt = placed.select("comp", "t.tile", "t.side", "sid", "data").repartition(parts(rows.sparkSession), "comp", "tile").sortWithinPartitions("comp", "tile", "sid")
    return dealt.mapInArrow(partial(_tiles, num=num, den=den, verify=verify), "a long, b long")


def _chunks(members: DataFrame, size: int, num: int, den: int, core: Column | None = None) -> DataFrame:
    """Number of chunks of every component by twice the class of sizes (and one for the ``core``), as a map; all 0 for a component that is one tile."""
    key = 2 * _size_class(num, den) + (F.lit(0) if core is None else core.cast("int"))
    counts = members.groupBy("comp", key.alias("c")).agg(F.count("*").alias("n_nodes"))
    small = F.lit(False) if core is not None else F.sum("n_nodes").over(Window.partitionBy("comp")) <= 2 * size
    each = F.when(small, 0).otherwise(F.ceil(F.col("n_nodes") / size)).cast("int")
    return counts.withColumn("k", each).groupBy("comp").agg(F.map_from_entries(F.collect_list(F.struct("c", "k"))).alias("chunks"))


def _connected(rows: DataFrame, size: int, num: int, den: int, verify: bool, name: str) -> DataFrame:
    """Edges enough to connect what is linked among ``rows`` (comp, sid, n, data); see solve_tile.

    The first tiles connect most of a component whose texts are all near each other. Its largest part is then the core, and only
    nodes outside of it go on, to meet all others: the core's nodes, connected already, don't meet each other again. The work grows with the square
    of a component only if many of its nodes stay out of the core.
    """
    rows = durable(rows, name)
    chunks = durable(_chunks(rows, size, num, den), f"{name}-chunks")
    first = durable(_tiled(rows.join(chunks, "comp"), num, den, verify), f"{name}-links")
    big = chunks.where(F.aggregate(F.map_values("chunks"), F.lit(0), lambda a, c: a + c) > 0).select("comp")
    if big.isEmpty():
        return first
    rows = rows.join(big, "comp", "left_semi")
    label = components(first).withColumnRenamed("node", "sid")
    named = durable(rows.select("comp", "sid", "n").join(label, "sid", "left").select("comp", "sid", "n", F.coalesce("label", "sid").alias("label")), f"{name}-named")
    counts = named.groupBy("comp", "label").agg(F.count("*").alias("k")).groupBy("comp").agg(F.max_by("label", F.struct("k", "label")).alias("largest"), F.count("*").alias("labels"))
    parted = named.join(counts.where("labels > 1"), "comp").select("comp", "sid", "n", (F.col("label") == F.col("largest")).alias("core"))
    parted = durable(parted, f"{name}-parted")
    if parted.isEmpty():
        return first
    again = rows.select("sid", "data").join(parted, "sid").join(_chunks(parted, size, num, den, F.col("core")), "comp")
    return first.unionByName(_tiled(again, num, den, verify, rest=True))


def _with_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The set of each member's text; of texts under one doc_id, only those that are the member."""
    for b in pieces(batches):
        sets = [s.tobytes() if len(s) and set_id(s) == sid else None for s, sid in zip(shingle_sets(b.column("text"), k), b.column("sid").to_pylist(), strict=True)]
        data = pa.array(sets, pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("comp"), b.column("sid"), b.column("n"), data], names=["comp", "sid", "n", "data"]).filter(data.is_valid())


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def row_key() -> list[Column]:
    """Columns that rows of one doc_id (or none) and one text share."""
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("h")]


def similarity_labels(docs: DataFrame, k: int, num: int, den: int, keys_of: Callable[[np.ndarray], np.ndarray] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, n_shingles, label)`` of every row of ``docs``, and its ``keep`` columns (of type long).

    Rows of one component have one label, whatever their doc_id; rows without shingles have none.
    """
    n_parts = parts(docs.sparkSession)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    rows, docs = docs.select("doc_id", "text", *keep), docs.select("doc_id", "text")
    least = -(-num // (den - num))  # smaller sets link with equal sets only
    keys_of = keys_of or partial(group_keys, num=num, den=den)
    rows = rows.withColumn("h", text_hash())
    nodes = durable(rows.mapInArrow(partial(_nodes, k=k), ", ".join(("doc_id long, n_shingles long, sid long, point binary", *(f"{c} long" for c in keep), "h long"))), "nodes")
    keyed = docs.select("text").mapInArrow(partial(_emit, k=k, keys_of=keys_of, least=least), "key long, sid long, hub long")
    stars = keyed.repartition(n_parts, "key").sortWithinPartitions("key", "sid").mapInArrow(_stars, "a long, b long")
    alone, nodes = nodes.where("sid IS NULL"), nodes.where("sid IS NOT NULL")
    # A set's text is found again by its smallest doc_id (null last) and a hash of it. Rows of one set become one here, as do rows of one id and
    # text below, before the shuffle where they meet: any number of equal rows is one node.
    first = F.min(F.struct(*row_key(), "n_shingles", "point")).alias("rep")
    reps = nodes.groupBy("sid").agg(first).select("sid", F.col("rep.n_shingles").alias("n"), "rep.no_id", "rep.id", "rep.h", F.col("rep.point").alias("data"))

    def members(edges: DataFrame, of: DataFrame, name: str) -> DataFrame:
        comp = components(edges).select(F.col("node").alias("sid"), F.col("label").alias("comp"))
        comp = durable(comp.unionByName(comp.select(F.col("comp").alias("sid"), "comp").distinct()), f"{name}-components")
        return durable(comp.join(of, "sid"), name)

    near = members(stars, reps, "candidates")
    bounded = members(_connected(near.select("comp", "sid", "n", "data"), POINT_TILE, num, den, False, "points"), near.drop("comp", "data"), "bounded")
    # a shuffle join at every size, as members grow with the documents
    texts = docs.withColumn("h", text_hash()).groupBy(*row_key()).agg(F.first("text").alias("text"))
    texts = bounded.hint("merge").join(texts, ["no_id", "id", "h"]).select("comp", "sid", "n", "text")
    sets = texts.mapInArrow(partial(_with_sets, k=k), "comp long, sid long, n long, data binary")
    links = _connected(sets, TILE, num, den, True, "sets")
    label = components(links).withColumnRenamed("node", "sid")
    named = join_spread(nodes, label, "sid", "left").select("doc_id", "n_shingles", F.coalesce("label", "sid").alias("label"), *keep)
    return named.unionByName(alone.select("doc_id", "n_shingles", F.col("sid").alias("label"), *keep))


def similarity_components(docs: DataFrame, k: int, num: int, den: int, keys_of: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    Rows link when their sets of ``k``-word shingles have a Jaccard similarity of num/den or more; a
    component is named by its smallest doc_id. Null, empty and wordless texts have no shingles and
    stand alone. A repeated doc_id gives a row each time. A null doc_id keeps its row, and
    names a component only if all its members have none. ``keys_of`` may give other candidate keys.
    """
    rows = similarity_labels(docs, k, num, den, keys_of)
    rows = durable(rows, "labelled")
    named, alone = rows.where("label IS NOT NULL"), rows.where("label IS NULL")
    least_id = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return join_spread(named, least_id, "label").select("doc_id", "n_shingles", "component_id").unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def ngram_jaccard_join(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """The join with the parameters of the query; see similarity_components."""
    return similarity_components(docs, k, num, den)
