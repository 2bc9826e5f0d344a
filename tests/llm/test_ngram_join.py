import random
import re

import duckdb
import numpy as np
import pytest

from finlattice.llm import ngram_join
from finlattice.llm.components import components, forest
from finlattice.llm.fingerprints import near_duplicates
from finlattice.llm.ngram_join import CountTree, group_keys, ngram_jaccard_join, point, similarity_components
from finlattice.llm.sql import OP8

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, num, den):
    """Components by comparing all pairs of distinct sets."""
    sets = [frozenset(shingles(t, k)) for _, t in rows]
    distinct = [s for s in dict.fromkeys(sets) if s]
    index = {}
    for i, s in enumerate(distinct):
        for x in s:
            index.setdefault(x, []).append(i)
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(distinct):
        common = {}
        for x in s:
            for j in index[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if den * c >= num * (len(s) + len(distinct[j]) - c):
                parent[root(i)] = root(j)
    at = {s: root(i) for i, s in enumerate(distinct)}
    least = {}
    for (d, _), s in zip(rows, sets):
        if s and d is not None:
            least[at[s]] = min(d, least.get(at[s], d))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(((d, len(s), least.get(at[s], d) if s else d) for (d, _), s in zip(rows, sets)), key=key)


def check(df, rows, k, num, den):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=key) == brute(rows, k, num, den)


def near_copies(seed, n, length, vocabulary, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(ngram_jaccard_join(docs), rows, 4, 85, 100)
    check(similarity_components(docs, 5, 4, 5), rows, 5, 4, 5)
    check(near_duplicates(docs), rows, 5, 4, 5)


def test_borderline_group_over_many_tiles(spark):
    texts = near_copies(3, 700, 90, 10**6, 5) + near_copies(4, 200, 12, 30, 3) + near_copies(5, 300, 400, 10**6, 18)
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    check(ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")), rows, 4, 85, 100)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (5, "another text altogether here now"), (None, "one two"), (None, None), (7, "a" * 300_000), (6, "a" * 300_000), (None, "alone words of no id at all"), (9, "one two")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, component_id int")
    check(ngram_jaccard_join(docs), rows, 4, 85, 100)
    assert ngram_jaccard_join(docs.limit(0)).count() == 0


@pytest.mark.parametrize("num,den", [(85, 100), (4, 5)])
def test_linked_sets_share_a_key(num, den):
    rng = np.random.default_rng(1)
    tried = 0
    for _ in range(4000):
        n = int(rng.integers(6, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        common = a[rng.random(len(a)) >= rng.random() * 0.2]
        b = np.unique(np.concatenate((common, rng.integers(0, 1 << 63, int(rng.integers(0, n // 6 + 2))).astype(np.uint64))))
        both = len(np.intersect1d(a, b))
        if den * both >= num * (len(a) + len(b) - both) and len(b) > 5:
            tried += 1
            assert len(np.intersect1d(group_keys(a, num, den), group_keys(b, num, den))) or len(a) <= den // (den - num), (len(a), len(b), both)
    assert tried > 500


def test_tree_bounds_lose_no_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(200) > rng.random() * 0.3], rng.integers(0, 1 << 63, int(rng.integers(0, 30))).astype(np.uint64)))) for _ in range(300)]
    counts, sizes = np.stack([point(s) for s in sets]), np.array([len(s) for s in sets])
    tree = CountTree(counts, sizes)
    for i in range(0, 300, 7):
        found = set(tree.search(counts[i], sizes[i], 85, 100)[0].tolist())
        for j, s in enumerate(sets):
            both = len(np.intersect1d(sets[i], s))
            assert j in found or 100 * both < 85 * (len(sets[i]) + len(s) - both)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(120)] + [(7, 7), (None, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    nodes, labels = forest(np.array([a for a, _ in real]), np.array([b for _, b in real]))
    assert got == dict(zip(nodes.tolist(), labels.tolist()))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_name_a_node_once(spark):
    """A chain that two shortenings don't take to its end: its nodes come back in later rounds."""
    edges = [(i + 1, i) for i in range(1, 40)] + [(i + 1, i) for i in range(100, 107)]
    got = sorted((r.node, r.label) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == [(i, 1) for i in range(2, 41)] + [(i, 100) for i in range(101, 108)]


def test_small_nested_sets_share_a_key():
    for num, den in ((4, 5), (85, 100), (1, 2), (2, 3)):
        for seed in range(40):
            s = np.random.default_rng(seed).integers(0, 1 << 63, 12).astype(np.uint64)
            for n in range(1, 13):
                for m in range(1, n):
                    if den * m >= num * n:
                        assert len(np.intersect1d(group_keys(np.unique(s[:n]), num, den), group_keys(np.unique(s[:m]), num, den))), (num, den, m, n)


def test_few_shingles_link(spark):
    """Texts of 7 to 10 words and 3 to 6 shingles, each with one word added, at each end."""
    rows = []
    for i in range(60):
        words = [f"w{i}x{j}" for j in range(7 + i % 4)]
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join([*words, "more"])), (3 * i + 2, " ".join(["before", *words]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(similarity_components(docs, 5, 4, 5), rows, 5, 4, 5)
    check(near_duplicates(docs), rows, 5, 4, 5)
    check(ngram_jaccard_join(docs), rows, 4, 85, 100)


def test_join_equals_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    got = ngram_jaccard_join(spark.read.parquet(path)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(OP8).fetchall())


def test_many_equal_rows_are_one_node(spark, monkeypatch):
    tiled = []
    of = ngram_join._tiled

    def counted(rows, *args, **kwargs):
        tiled.append(rows.count())
        return of(rows, *args, **kwargs)

    monkeypatch.setattr(ngram_join, "_tiled", counted)
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:199], "other"])
    rows = [(None, " ".join(words))] * 20_000 + [(1, near), (2, "nothing like it at all"), (7, near), (7, near)]
    frame = spark.createDataFrame(rows, "doc_id int, text string").repartition(8)
    got = ngram_jaccard_join(frame).groupBy("doc_id", "component_id").count().collect()
    assert sorted(((r.doc_id or 0), r.component_id, r["count"]) for r in got) == [(0, 1, 20_000), (1, 1, 1), (2, 2, 1), (7, 1, 2)]
    assert max(tiled) == 2


def test_chains_over_many_tiles_are_one_component(spark, monkeypatch):
    """Texts that are near their neighbours only: most links join a node outside the core with the core, or with another such node."""
    monkeypatch.setattr(ngram_join, "POINT_TILE", 12)
    monkeypatch.setattr(ngram_join, "TILE", 8)
    text = lambda i, n: " ".join(f"w{j}" for j in range(i * 10, i * 10 + n))
    rows = [(i, text(i, 200)) for i in range(240)] + [(1000 + i, text(5000 + i, 205 + 3 * (i % 5))) for i in range(120)]
    got = {r.doc_id: r.component_id for r in ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want = {d: c for d, _, c in brute(rows, 4, 85, 100)}
    assert got == want and want[239] == 0
