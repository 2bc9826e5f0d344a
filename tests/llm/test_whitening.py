"""Whitening against plain numpy in double precision and exact integers."""

import math

import numpy as np
import pytest

from finlattice.llm import whitening

SF = "/root/testdata/sf0.01"


def brute(vectors, components=4):
    """n, deviations, eigenvalues, trace and coordinates of integer vectors (an array); fitted on distinct ones."""
    fit = np.array(sorted({tuple(v) for v in vectors.tolist()}), np.int64)
    n, sums = len(fit), [sum(map(int, c)) for c in fit.T]
    deviation = [sum((n * int(x) - s) ** 2 for x, s in zip(v, sums, strict=True)) for v in vectors]
    mean = np.array([s / n for s in sums])
    cov = (fit - mean).T @ (fit - mean) / n
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    return n, deviation, value, np.trace(cov), (vectors - mean) @ vector / np.sqrt(value)


def compare(rows, ids, x, components=4):
    n, deviation, value, trace, white = brute(x, components)
    k = len(value)
    assert len(rows) == len(ids) * k
    found = {(r.vec_id, r.component): r for r in rows}
    sign = [0.0] * k
    for i, v in enumerate(ids):
        for c in range(k):
            r = found[v, c + 1]
            assert (r.n, r.deviation) == (n, deviation[i])
            assert r.explained == pytest.approx(value[c] / trace, rel=1e-9)
            sign[c] = sign[c] or float(np.sign(r.whitened * white[i, c]))
            assert r.whitened * sign[c] == pytest.approx(white[i, c], abs=1e-8)
    assert max(r.identity_error for r in rows) < 1e-9


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = table.select("vec_id", "embedding").collect()
    x = np.floor(256 * np.array([r.embedding for r in data], np.float64)).astype(np.int64)
    compare(whitening.whiten(table).collect(), [r.vec_id for r in data], x)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(300, 5)).astype(np.float32).astype(float)
    good[7] = good[8] = good[9]
    rows = [(i, v.tolist(), 1, "a") for i, v in enumerate(good)]
    odd = [None, [], [1.0, None, 1.0, 1.0, 1.0], [math.nan] * 5, [math.inf] + [0.0] * 4, [1.0, 2.0], [1e30] * 5]
    rows += [(1000 + i, v, 1, "a") for i, v in enumerate(odd)]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<double>, x int, component string").repartition(5)
    compare(whitening.whiten(frame).collect(), list(range(300)), np.floor(256 * good).astype(np.int64))


def test_far_from_zero_and_past_64_bits(spark):
    rng = np.random.default_rng(4)
    good = 4e6 + rng.normal(size=(200, 4))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(good)], "vec_id long, embedding array<double>")
    compare(whitening.whiten(frame).collect(), list(range(200)), np.floor(256 * good).astype(np.int64))
    wide = spark.createDataFrame([(i, [float(i) * 1e9, 1.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert all(r.deviation is None for r in whitening.whiten(wide).collect() if r.vec_id != 2)


def test_nothing_varies_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    rows = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], schema)).collect()
    assert len(rows) == 4 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None for r in rows)
    rows = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(6)], schema)).collect()
    assert {r.component for r in rows if r.whitened is not None} == {1} and {r.component for r in rows} == {1, 2, 3}
    assert all(r.explained == pytest.approx(1.0) for r in rows if r.component == 1)


@pytest.mark.parametrize("kind", ["spread", "clustered", "equal", "diagonal"])
def test_refinement_reaches_double_precision(kind):
    rng = np.random.default_rng(6)
    d = 40
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    value = {"spread": np.arange(1.0, d + 1), "clustered": np.repeat(np.arange(1.0, 5), 10) + np.tile(np.arange(10) * 1e-9, 4), "equal": np.repeat([1.0, 2.0], 20), "diagonal": np.arange(d) / 7.0}[kind]
    a = np.diag(value) if kind == "diagonal" else (q * value) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(d)).max() < 2e-14
    assert np.abs(a @ x - x * found).max() < 2e-14 * max(1.0, np.abs(a).max()) * 4
    assert np.abs(found - np.sort(value)[::-1]).max() < 1e-12
    if kind == "clustered":  # neighbours 1e-9 apart: their vectors are told apart as far as double precision can
        s = x.T @ a @ x
        assert np.abs(s - np.diag(np.diag(s))).max() < 1e-13
    plain = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert np.abs(plain.T @ plain - np.eye(d)).max() > 1e-8 or kind == "diagonal"
