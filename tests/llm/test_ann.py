import numpy as np
import pytest

from finlattice.llm import ann
from finlattice.llm.ann import nearest


def brute(rows, every=20, k=20):
    use = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in use]), np.stack([v for _, v in use])
    out = {}
    for n, i in enumerate(ids):
        if i % every == 0:
            s = x @ x[n]
            order = [j for j in np.lexsort((ids, -np.round(s, 12))) if j != n][:k]
            out[int(i)] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert found.keys() == {q for q, w in want.items() if w}
    hits = total = 0
    for q, own in found.items():
        own.sort(key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(want[q]) + 1)) and q not in [r.vec_id for r in own]
        assert all(a.score > b.score or (a.score == b.score and a.vec_id < b.vec_id) for a, b in zip(own, own[1:]))
        hits += len({r.vec_id for r in own} & {i for i, _ in want[q]})
        total += len(want[q])
    return hits / total


@pytest.mark.parametrize("cell, slice_", [(4096, 1 << 16), (128, 1 << 16), (512, 100)])
def test_recall_on_the_whole_table(spark, monkeypatch, cell, slice_):
    monkeypatch.setattr(ann, "CELL", cell)
    monkeypatch.setattr(ann, "SLICE", slice_)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert recall(nearest(table).collect(), brute(rows)) >= 0.95


def test_norms_that_differ(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(16) * rng.exponential()]) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert recall(nearest(frame).collect(), brute(rows)) >= 0.9


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (20, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 0.0]), (40, [0.0, -2.0]), (8, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = {q: [] for q in (0, 20, 40)}
    for r in sorted(nearest(frame).collect(), key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, r.score))
    assert got == {0: [(1, 1.0), (20, 1.0), (2, 0.5), (40, 0.0)], 20: [(0, 1.0), (1, 1.0), (2, 0.5), (40, 0.0)], 40: [(0, 0.0), (1, 0.0), (20, 0.0), (2, -1.0)]}
    many = spark.createDataFrame([(i, [1.0, 0.5]) for i in range(200)], "vec_id long, embedding array<float>")
    for r in nearest(many).groupBy("query_id").agg({"vec_id": "max", "rank": "max"}).collect():
        assert r["max(rank)"] == 20 and r["max(vec_id)"] == (20 if r.query_id < 20 else 19)
    assert nearest(frame.limit(0)).count() == 0


def test_one_id_with_two_vectors_is_two_candidates(spark):
    rows = [(0, [1.0, 0.0]), (7, [2.0, 0.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [0.5, 0.0])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(7, 2.0), (7, 1.0), (8, 1.0), (9, 0.5)]


def test_the_stopping_test_stops():
    """Of points in 200 loose clusters a query verifies a small share, also without a bound to begin with."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((200, 64))[rng.integers(0, 200, 8000)] + 0.5 * rng.standard_normal((8000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = ann.Index(rng.standard_normal((65, ann.DIMS)), 1.0, np.zeros(0, np.int64), np.zeros(0))
    found = list(ann._search_cell(index, np.arange(8000), x, np.arange(400), x[:400], np.full(400, np.inf), 21))
    assert sum(n for *_, n in found) / (400 * 8000) < 0.1
    hits = sum(len(set(ids.tolist()) & set(np.argsort(-(x @ x[i]))[:21].tolist())) for i, ids, _, _ in found)
    assert hits / (400 * 21) > 0.95
