import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from finlattice.llm.mixing import mix_sources, pivot


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = mix_sources(docs).collect()
    sizes = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()}
    assert len(out) == len(sizes)
    taken, target, total, largest = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in out:
        assert (r.source, r.size) == sizes[r.doc_id] and 0 <= r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        taken[r.source] += r.taken
        total[r.source] += r.size
        largest[r.source] = max(largest[r.source], r.size)
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6, s
        assert target[s] <= 3 * total[s] + 1e-6
    assert sum(target.values()) == pytest.approx(sum(total.values()))
    again = {r.doc_id: r.taken for r in mix_sources(docs.repartition(3, "text")).collect()}
    assert again == {r.doc_id: r.taken for r in out}


def test_targets_are_the_fixed_point(spark):
    """Sources of all sizes, more than are broadcast; each free one at its weight's level, the others at three times their size."""
    docs = spark.range(30_000).selectExpr("id doc_id", "concat('s', id % 12000) source", "repeat('w ', int(pow(1 + id % 12000 % 7, 3) * (id % 12000 % 4))) text")
    out = mix_sources(docs)
    rows = {r.source: (r.source_size, r.target) for r in out.select("source", "source_size", "target").distinct().collect()}
    assert len(rows) == 12_000 and sum(t for _, t in rows.values()) == pytest.approx(sum(n for n, _ in rows.values()))
    levels = [t / (1 + i % 3) for i, (_, (n, t)) in enumerate(sorted(rows.items())) if t < 3 * n - 1e-6]
    assert max(levels) == pytest.approx(min(levels)) and len(levels) > 100
    for i, (_, (n, t)) in enumerate(sorted(rows.items())):
        assert t == pytest.approx(min(3 * n, levels[0] * (1 + i % 3)))
    sums = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"))
    assert sums.where("abs(taken - target) > most + 1e-6").count() == 0


def test_equal_rows_are_spread_evenly(spark):
    """A third of the rows are one row; they share its copies out, and none of them is lost."""
    docs = spark.range(60_000).selectExpr("if(id % 3 = 0, null, id) doc_id", "if(id % 2 = 0, 'a', 'b') source", "'one two three' text")
    out = mix_sources(docs).collect()
    assert len(out) == 60_000
    hot = [r.copies for r in out if r.doc_id is None and r.source == "b"]
    assert len(hot) == 10_000 and max(hot) - min(hot) <= 1
    for s in "ab":
        assert abs(sum(r.taken for r in out if r.source == s) - next(r.target for r in out if r.source == s)) <= 3


def test_pivot_keeps_words_and_expectations():
    rows = [(i, s, 1, p) for i, (s, p) in enumerate([(10, 0.3), (7, 0.9), (0, 0.5), (30, 0.25), (4, 0.5), (10, 0.0)])]
    hits = defaultdict(float)
    for seed in range(4000):
        decided, held = pivot(rows, seed)
        words = sum(s * w for _, s, w, _ in decided) + (held[1] * (held[2] + held[3]) if held else 0)
        assert words == pytest.approx(sum(s * (w + p) for _, s, w, p in rows if s))
        for i, _, w, _ in decided:
            hits[i] += w - 1
        if held:
            hits[held[0]] += held[3]
    for i, s, _, p in rows:
        assert hits[i] / 4000 == pytest.approx(p if s else 0, abs=0.03)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "w " * 5000, None), (None, "x y z", "a"), (4, "x y z", "a"), (4, "x y z", "a"), (5, "q", "é")]
    docs = spark.createDataFrame([(d, t, s, 1, 2.0) for d, t, s in rows], "doc_id long, text string, source string, size int, target double")
    out = mix_sources(docs).collect()
    assert len(out) == len(rows) and {r.source_size for r in out if r.source == "a"} == {9}
    assert mix_sources(docs.limit(0)).count() == 0
