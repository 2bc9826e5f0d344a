"""Phrases against SQL on the whole table and against plain counting on odd rows; the HAT-trie against a dictionary."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from finlattice.llm import hat_trie, phrases, sql

SF = "/root/testdata/sf0.01"


def brute(rows, least, top):
    counts, sizes = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            counts.update((lang, *w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    cands = {g: a for g, a in counts.items() if len(g) > 2 and a >= least}
    out = []
    for (lang, *w), a in cands.items():
        best = min((2000000 * a // (counts[lang, *w[:k]] + counts[lang, *w[k:]]), k) for k in range(1, len(w)))
        longer = [c for g, c in cands.items() if g[0] == lang and len(g) - 1 > len(w) and any(list(g[i : i + len(w)]) == w for i in range(1, len(g) - len(w) + 1))]
        if not any(100 * c >= 80 * a for c in longer):
            out.append((lang, " ".join(w), a, counts[lang, *w[: best[1]]], counts[lang, *w[best[1] :]], sizes[lang], best[0]))
    ranked, place = [], Counter()
    for x in sorted(out, key=lambda x: (x[0], -x[6], -x[2], x[1].encode())):
        place[x[0]] += 1
        if place[x[0]] <= top:
            ranked.append((x[0], place[x[0]], *x[1:]))
    return ranked


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_whole_table(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = rows_of(phrases.mine_phrases(spark.read.parquet(f"{SF}/documents.parquet")))
    assert got == sorted(con.sql(sql.OP11).fetchall()) and len(got) > 100


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows(spark, small, monkeypatch):
    if small:  # containers burst and runs leave inside each chunk
        monkeypatch.setattr(phrases.HatTrie, "add", lambda self, p: iter([x for i in range(0, len(p), 50) for x in [*_put(self, p[i : i + 50])]]))
    rng = np.random.default_rng(2)
    words = ["a", "B", "cc", "Dd", "é", "ß-x", "e.f", "g\th", "i\x0bj", "k!"]
    rows = [(["en", "de", None, "und", ""][i % 5], " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(400)]
    rows += [("en", None), (None, None), ("en", ""), ("de", " \t.,;\n"), ("en", "rare words here"), ("de", "x y z x y z " * 400), ("en", "tail"), ("fr", "une fois. " * 3)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, n long, phrase int").repartition(3)
    for least, top in ((30, 2000), (5, 7)):
        assert rows_of(phrases.mine_phrases(frame, least, top)) == brute(rows, least, top)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 200)
    assert rows_of(phrases.mine_phrases(frame, 8)) == brute(rows, 8, 2000)


def _put(trie, paths):
    trie.root.add(paths)
    if trie.root.size() > 20:
        yield trie.spill(10)


def test_no_rows(spark):
    schema = "lang string, text string"
    assert phrases.mine_phrases(spark.createDataFrame([], schema)).count() == 0
    assert phrases.mine_phrases(spark.createDataFrame([("en", "one two")], schema)).count() == 0


def test_large_counts_are_exact(spark):
    a = 9_000_000_000_001
    counts = spark.createDataFrame([("en", [1], a + 7, "x"), ("en", [2], a + 12, "y"), ("en", [1, 2], a, None)], "lang string, phrase array<long>, f long, word string")
    (row,) = phrases.score_cuts(counts).collect()
    assert row.score == 2000000 * a // (2 * a + 19)


@pytest.mark.parametrize("burst,limit", [(16384, 1 << 20), (3, 1 << 20), (4, 60)])
def test_hat_trie(burst, limit, monkeypatch):
    monkeypatch.setattr(hat_trie, "BURST", burst)
    monkeypatch.setattr(hat_trie, "LIMIT", limit)
    monkeypatch.setattr(hat_trie, "BLOCK", 64)
    rng = np.random.default_rng(3)
    paths = np.concatenate((rng.zipf(1.5, (3000, 3)) % 600, [[256, 0, 0], [256, 256, 0], [1, 2, 65536]] * 5, np.full((50, 3), 7)))
    trie, found, runs = hat_trie.HatTrie(3), Counter(), []
    runs += trie.add(paths)
    runs.append(trie.spill())
    assert len(runs) > 1 or limit > 60
    for p, n in runs:
        assert p.tolist() == sorted(p.tolist())
        for row, c in zip(p.tolist(), n.tolist(), strict=True):
            found[tuple(row)] += c
    assert found == Counter(map(tuple, paths.tolist()))
