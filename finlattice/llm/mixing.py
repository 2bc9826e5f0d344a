"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents are to be taken ``target / source_size`` times each. The whole part is taken for certain;
the fractional part p of a document of s words holds a mass of p * s words. Pivotal rounding pairs two documents and
moves mass from one to the other, by chance in the direction that keeps each expectation, until one of them
is integral; the other goes on to the next pair. A source's sum of words is thereby kept, but for
the one document that is left at the end. Pairing runs in hashed bins first, and the bins' residuals are
combined in a reduction tree, level by level, so no task holds more than a bin of documents. Rows that
are equal in doc_id, source and size are one unit there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, parts

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a bin, on average, and bins that meet in one of the next level; equal documents written out at a time.
BIN, ARITY, RUN = 2048, 64, 10_000
#: Rows and bytes of a plan that is broadcast; a larger one is joined by a shuffle.
PLAN_ROWS, PLAN_BYTES = 10_000, 16 << 20
_FIELDS = "doc_id long, source string, size long, bin long, whole long, part double, m long, done boolean"


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sizes: DataFrame, weights: tuple[float, ...], cap: float = 3.0) -> float | None:
    """The level whose product with a source's weight is its target, unless that is over ``cap`` times its size.

    ``sizes``: place (of the source in the cycle of weights), source_size. Every source that a level puts over its cap is held
    there, and what is left is shared anew, until none is above: a pass of exact sums over the sources each time. None: all are at their caps.
    """
    level = 0.0
    over = F.lit(False)
    while True:
        sums = [F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0)), *(F.count_if(~over & (F.col("place") == i)) for i in range(len(weights)))]
        held, total, *free = sizes.agg(*(x.alias(f"x{i}") for i, x in enumerate(sums))).first()
        weight = sum(w * n for w, n in zip(weights, free, strict=True))
        if not weight:
            return None
        new = (total - cap * held) / weight
        if new <= level:
            return level
        level = new
        over = F.element_at(F.array(*map(F.lit, weights)), F.col("place") + 1) * level > cap * F.col("source_size")


def _placed(totals: DataFrame, cycle: int) -> DataFrame:
    """``totals`` with the ``place`` of each source in the cycle: its rank by code point, null last, modulo the cycle's length.

    Sources are sorted in ranges; only the ranges' row counts come to the driver.
    """
    order = [F.col("source").isNull(), F.col("source")]
    n = parts(totals.sparkSession)
    ranged = durable(totals.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()), "sources")
    counts = {r.range: r.n for r in ranged.groupBy("range").agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for r in sorted(counts):
        starts.append((r, before % cycle))
        before += counts[r]
    first = F.broadcast(totals.sparkSession.createDataFrame(starts, "range int, first int"))  # a row for each range
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return ranged.join(first, "range").withColumn("place", F.pmod(F.col("first") + rank, F.lit(cycle)).cast("int")).drop("range", "first")


def _chance(*key: object) -> float:
    """A reproducible number in [0, 1) from the rows that meet."""
    return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "big") / 2**64


def pivot(rows: list[tuple], seed: int) -> tuple[list[tuple], tuple | None]:
    """Rounds (doc_id, size, whole, part, ...) in the order given: those decided, and the one left fractional."""
    decided, held = [], None
    for row in rows:
        if row[1] == 0 or row[3] <= 0:
            decided.append((*row[:3], 0.0, *row[4:]))
            continue
        if held is None:
            held = row
            continue
        (a, sa, wa, pa_, *ra), (b, sb, wb, pb, *rb) = held, row
        ma, mb, fa, fb = pa_ * sa, pb * sb, (1 - pa_) * sa, (1 - pb) * sb
        up, down = min(fa, mb), min(ma, fb)  # words that a can gain from b, or lose to it
        if _chance(seed, a, sa, b, sb) * (up + down) < down:
            ma, mb, full = ma + up, mb - up, fa <= mb
            a_ends = full
            ends, goes = ((a, sa, wa + 1, 0.0, *ra), (b, sb, wb, mb / sb, *rb)) if a_ends else ((b, sb, wb, 0.0, *rb), (a, sa, wa, ma / sa, *ra))
        else:
            ma, mb = ma - down, mb + down
            ends, goes = ((a, sa, wa, 0.0, *ra), (b, sb, wb, mb / sb, *rb)) if ma <= 1e-9 * sa else ((b, sb, wb + 1, 0.0, *rb), (a, sa, wa, ma / sa, *ra))
        decided.append(ends)
        if goes[3] <= 1e-9:
            decided.append((*goes[:3], 0.0, *goes[4:]))
            held = None
        elif goes[3] >= 1 - 1e-9:
            decided.append((*goes[:2], goes[2] + 1, 0.0, *goes[4:]))
            held = None
        else:
            held = goes
    return decided, held


def _level(batches: Iterator[pa.RecordBatch], seed: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Pairs the rows of each (source, bin), which come sorted."""
    key, rows, out = None, [], []

    def close() -> None:
        if rows:
            decided, held = pivot(rows, seed)
            out.extend((d[0], key[0], d[1], key[1], d[2], 0.0, d[4], True) for d in decided)
            if held and last:  # the one document that can't be paired
                out.append((held[0], key[0], held[1], key[1], held[2] + (_chance(seed, "last", *held[:2]) < held[3]), 0.0, held[4], True))
            elif held:
                out.append((held[0], key[0], held[1], key[1], held[2], held[3], held[4], False))

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True))
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "source", "size", "bin", "whole", "part", "m", "done"])

    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("source", "bin", "doc_id", "size", "whole", "part", "m")]
        for source, bin_, doc_id, size, whole, part, m in zip(*cols, strict=True):
            if (source, bin_) != key:
                close()
                key, rows = (source, bin_), []
                if len(out) > 10_000:
                    yield batch()
                    out = []
            rows.append((doc_id, size, whole, part, m))
    close()
    if out:
        yield batch()


def mix_sources(docs: DataFrame, cycle: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0, seed: int = 42) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` of every row of ``docs`` (``doc_id``, ``text``, ``source``).

    Sources by code point (null last) have the weights of ``cycle`` in turn, however many they are. Null and wordless texts have size 0 and
    aren't taken. Rows equal in doc_id, source and size are counted first and rounded as one: each gets the whole part of
    the copies, as many as the sum of their fractions says one more, and one takes the rest of that sum to the pairing. The
    result depends on the rows and the seed only, not on their order or partitions.
    """
    spark = docs.sparkSession
    units = docs.select("doc_id", "source", word_count("text").alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
    units = durable(units, "sizes")
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("n"))
    placed = _placed(totals, len(cycle))
    level = water_level(placed, cycle, cap)
    share = F.element_at(F.array(*map(F.lit, cycle)), F.col("place") + 1) * (level if level is not None else 0.0)
    target = F.least(share, cap * F.col("source_size")) if level is not None else cap * F.col("source_size")
    bins = F.when(F.col("n") <= BIN, 1).otherwise(F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") / BIN)))).cast("long")
    plan = durable(placed.select(F.col("source").alias("plan_source"), "source_size", target.cast("double").alias("target"), bins.alias("bins")), "plan")
    rows, size, most = plan.agg(F.count("*"), F.coalesce(F.sum(F.length("plan_source")), F.lit(0)), F.coalesce(F.max("bins"), F.lit(1))).first()
    plan = F.broadcast(plan) if rows <= PLAN_ROWS and 4 * size <= PLAN_BYTES else plan
    rate = F.when((F.col("source_size") > 0) & (F.col("size") > 0), F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = units.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("each", F.floor(rate + 1e-12).cast("long"))
    rest = F.greatest(rate - F.col("each"), F.lit(0.0)) * F.col("m")
    # ``whole``: copies over the rows' own whole parts, so far
    start = joined.select("doc_id", "source", "size", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.col("bins")).alias("bin"), F.floor(rest + 1e-12).cast("long").alias("whole"), F.greatest(rest - F.floor(rest + 1e-12), F.lit(0.0)).alias("part"), "m")
    # sorting by the hash as well keeps neighbours in doc_id from always meeting
    levels, bins, left = [], most, start
    while True:
        last = bins == 1
        order = F.xxhash64("doc_id", "size", F.lit(seed + 1 + len(levels)))
        dealt = left.repartition(parts(spark), "source", "bin").sortWithinPartitions("source", "bin", order, "doc_id", "size")
        levels.append(durable(dealt.mapInArrow(partial(_level, seed=seed + len(levels), last=last), _FIELDS), "mixed"))
        if last:
            break
        bins = -(-bins // ARITY)
        left = levels[-1].where("NOT done").withColumn("bin", F.pmod("bin", F.lit(bins))).drop("done")
    done = levels[0].where("done")
    for level_ in levels[1:]:
        done = done.unionByName(level_.where("done"))
    out = done.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("each", F.floor(rate + 1e-12).cast("long"))
    # the rows of a unit again, a run at a time: the first ``whole`` of them have one copy more
    runs = out.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / RUN))))
    nth = runs.withColumn("nth", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("m"), (F.col("run") + 1) * RUN) - 1)))
    copies = nth.withColumn("copies", F.col("each") + (F.col("nth") < F.col("whole")).cast("long"))
    return copies.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
