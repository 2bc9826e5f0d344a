"""Language-model scores against a brute-force model in plain dictionaries."""

import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from finlattice.llm import lm_score
from finlattice.llm.elias_fano import Sequence, Trie

SCHEMA = "doc_id long, text string, held_out boolean"


def brute(rows, order, min_context):
    """(n_tokens, n_known, N, base, score) of each row with exact probabilities."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [("<s>", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), None) for _, t, _ in rows]
    grams = Counter()
    for t, (_, _, held) in zip(texts, rows, strict=True):
        if not held:
            grams.update(t[i - k + 1 : i + 1] for i in range(1, len(t)) for k in range(1, min(order, i + 1) + 1))
    words = {g: c for g, c in grams.items() if len(g) == 1}
    total, after = sum(words.values()), defaultdict(list)
    for g, c in grams.items():
        after[g[:-1]].append(c)

    def p(g):
        if len(g) == 1:
            return (grams[g] + 0.1) / (total + 0.1 * (len(words) + 1))
        low, seen = p(g[1:]), after.get(g[:-1])
        if len(g) > 2 and any(grams[g[i:j]] < min_context for j in range(2, len(g)) for i in (0,)):
            return low
        return low if not seen else max(grams[g] - 0.75, 0) / sum(seen) + 0.75 * len(seen) / sum(seen) * low

    out = []
    for t in texts:
        ends = range(1, len(t))
        base = sum(math.log10(p(t[i : i + 1])) for i in ends)
        out.append((len(t) - 1, sum(t[i : i + 1] in words for i in ends), total, base, sum(math.log10(p(t[max(0, i - order + 1) : i + 1])) for i in ends)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, order, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i % 40, " ".join(rng.choice(["a", "B", "ccc", "Dd", "é", "x,y"], rng.integers(0, 60))) + (" odd%d" % i if i % 7 == 0 else ""), bool(i % 10 == 3)) for i in range(120)]
    rows += [(None, None, None), (None, "", True), (5, "a b\tccc\n\x0b b", None), (5, "a b\tccc\n\x0b b", None), (7, "b a " * 3000, False), (8, "   wide", True)]
    found = lm_score.score_texts(spark.createDataFrame(rows, SCHEMA).repartition(4).withColumnsRenamed({}), order, 2).collect()
    want = brute(rows, order, 2)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted(((r.doc_id, r.n_tokens, round(r.base_score, 6), r) for r in found), key=key)
    right = sorted(((d, n, round(b, 6), (n, k, t, b, s)) for (d, _, _), (n, k, t, b, s) in zip(rows, want, strict=True)), key=key)
    assert [x[:3] for x in got] == [x[:3] for x in right]
    assert Counter((r.doc_id, r.n_tokens, r.held_out) for r in found) == Counter((d, w[0], bool(h)) for (d, _, h), w in zip(rows, want, strict=True))
    for (_, _, _, r), (_, _, _, (n, k, t, base, score)) in zip(got, right, strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, k, t)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert abs(r.score - score) < 4e-4 * n + 1e-9


def test_split_and_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm_score.score_documents(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)
    assert all(r.n_known == r.n_tokens for r in rows if not r.held_out)


def test_empty_table_and_nothing_to_learn(spark):
    assert lm_score.score_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    (row,) = lm_score.score_documents(spark.createDataFrame([(10, "a b", 1)], "doc_id int, text string, chunk int")).withColumn("x", lm_score.F.lit(1)).collect()
    assert row.n_tokens == 3
    (row,) = lm_score.score_texts(spark.createDataFrame([(1, "a b", True)], SCHEMA)).collect()
    assert (row.n_known, row.train_tokens, row.base_score, row.score) == (0, 0, 0.0, 0.0)


def test_sequence_access_and_search():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (1, 5), (10, 10), (1000, 5000), (1000, 2**63), (200_000, 10**6), (5, 2**64 - 1)):
        v = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        head, arrays = Sequence.encode(v)
        s = Sequence(*head, arrays)
        assert np.array_equal(s.access(np.arange(n)), v)
        asked = np.concatenate((v, rng.integers(0, top, 1000, dtype=np.uint64, endpoint=True)))
        at, inside = s.find(asked), np.isin(asked, v)
        assert np.array_equal(at >= 0, inside)
        assert np.array_equal(v[at[inside]], asked[inside]) if n else True


def test_trie_is_compact_and_normalised():
    rng = np.random.default_rng(1)
    contexts, words = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (500, 3000))
    pairs = np.unique(rng.integers(0, len(contexts) * len(words), 100_000))
    owner, word = pairs // len(words), pairs % len(words)
    trie = Trie(contexts, words, owner, word, [np.zeros(len(pairs), np.uint16)], [])
    assert trie.bytes < 6 * len(pairs) + 16 * (len(contexts) + len(words))
    c, at = trie.find(contexts, words, owner, word)
    assert np.array_equal(c, np.arange(len(contexts))) and np.array_equal(at, np.arange(len(pairs)))
    assert trie.fanout(np.arange(len(contexts))).sum() == len(pairs)
    assert (trie.find(contexts[:5], np.full(1, 12345, np.uint64), np.arange(5), np.zeros(5, np.int64))[1] == -1).all()
    count = rng.integers(1, 100, 50).astype(np.uint64)
    request = lm_score.pack(contexts[:1], np.array([50], np.uint64), np.sort(words[:50]), np.arange(50, dtype=np.uint32), count)
    alpha, gamma, _ = lm_score.look_up(lm_score.build_trie([request], 2), request)
    assert abs(lm_score.value(alpha).sum() + lm_score.value(gamma)[0] - 1) < 1e-3


def test_memory_of_a_chunk():
    """Two workers with a chunk each have to fit beside an executor's heap: under 90 bytes a token over all levels, with what sorting takes (52 where arrays of 64 bits for each token took 124)."""
    rng = np.random.default_rng(2)
    n, docs = 400_000, 40
    tokens = rng.zipf(1.3, n).clip(max=50_000).astype(np.uint64)
    lengths = np.full(docs, n // docs)
    tokens[np.cumsum(lengths) - lengths] = lm_score.BEGIN
    words, at = lm_score.indexed(tokens)
    data = lm_score.pack(np.arange(docs), np.ones(docs, np.uint8), lengths, at, words)
    del tokens, at, words
    tracemalloc.start()
    grams = lm_score.Grams(data, 1)
    p = np.ones(n)
    for _ in range(2):
        grams.climb()
        types = len(grams.word)
        grams.interpolate(p, {0: lm_score.pack(*np.zeros((2, types), np.uint16))})
        grams.extend({0: lm_score.pack(np.ones(types, bool))})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90 * n
