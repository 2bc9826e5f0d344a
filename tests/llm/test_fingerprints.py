import hashlib

import numpy as np
import xxhash
from pyspark.sql import functions as F
from test_ngram_join import shingles

from finlattice.llm.fingerprints import edited_fingerprints, fingerprints


def expected(rows):
    """Edited texts by the contract's words."""
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1] or ""), r[1] or ""))
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 2
        out.append((d, len(t), hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest(), t, t[: len(t) - k] + nxt[:k], nxt))
    return out


def jaccard(a, b):
    x, y = shingles(a, 5), shingles(b, 5)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in edited_fingerprints(docs).collect()}
    plain = {r.doc_id: r.fingerprint for r in fingerprints(docs).collect()}
    want = expected(rows)
    assert len(got) == len(want) == len(rows)
    for d, n, sha, t, e, nxt in want:
        r = got[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (n, sha, plain[d])
        assert abs(r.near_edited - jaccard(t, e)) < 0.2 and abs(r.near_next - jaccard(t, nxt)) < 0.2
    off = np.array([got[d].near_edited - jaccard(t, e) for d, _, _, t, e, _ in want])
    # 128 places: a standard deviation of at most 1 / (2 sqrt(128)) = 0.044, a mean deviation of 0.8 times that, no bias
    assert np.abs(off).mean() < 0.04 and abs(off.mean()) < 0.01
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t, set()).add(plain[d])
    assert all(len(v) == 1 for v in by_text.values())


def test_odd_rows(spark):
    rows = [(5, None), (2, ""), (9, "é😀 b c d e f g"), (-3, "one"), (None, "x y"), (7, "long " * 60_000), (7, "long " * 60_000), (7, "other")]
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, key string")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([tuple(r[:3]) for r in edited_fingerprints(docs).collect()], key=key) == sorted([w[:3] for w in expected(rows)], key=key)
    assert edited_fingerprints(docs.limit(0)).count() == 0
    one = edited_fingerprints(docs.where("doc_id = 9")).collect()[0]
    assert one.near_next == 1.0 and one.n_chars == len("é😀 b c d e f g")


def test_large_and_repeated_ids_are_spread_over_ranges(spark):
    """Hashed 64-bit ids, and a third of the rows under one id: ranges are even, and each row's next one is right."""
    docs = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1 << 60).otherwise(F.xxhash64("id")).alias("doc_id"), F.concat(F.lit("text of "), "id").alias("text"))
    rows = [tuple(r) for r in docs.collect()]
    out = edited_fingerprints(docs)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[:3]) for r in out.collect()), key=key) == sorted((w[:3] for w in expected(rows)), key=key)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < len(rows) / 3


def test_many_equal_rows_are_computed_once(spark, monkeypatch):
    from finlattice.llm import fingerprints as module

    monkeypatch.setattr(module, "RUN", 700)
    rows = [(None, "a b c d e f g")] * 2500 + [(3, "x y")] * 1200 + [(i, f"text of {i}") for i in range(40)] + [(3, "other")] * 2
    out = edited_fingerprints(spark.createDataFrame(rows, "doc_id int, text string").repartition(6))
    key = lambda r: tuple(str(x) for x in r)
    got = out.collect()
    assert sorted((tuple(r[:3]) for r in got), key=key) == sorted((w[:3] for w in expected(rows)), key=key)
    assert sum(r.near_next == 1.0 for r in got) >= 2499 + 1199 + 1 and out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    same = edited_fingerprints(spark.createDataFrame([(1, "same text")] * 1500, "doc_id long, text string")).collect()
    assert len(same) == 1500 and {(r.near_next, r.edited_sha256) for r in same} == {(1.0, same[0].edited_sha256)}
