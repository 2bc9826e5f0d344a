"""Collocations: contiguous phrases of two to four words that stay together, by language.

Counts are exact over all documents. Tasks cut documents into chunks of words by number (see grams); a word's name is a hash of the word and its
language. Rounds of counting leave out what can't be frequent: first words, then pairs of frequent words, then longer phrases of
frequent pairs (a part of a phrase is at least as frequent as the phrase). Pairs and longer phrases are counted in a HAT-trie, whose sorted runs are merged by prefix in Spark:
all runs of one prefix (both words of a pair, the first three of longer phrases) go to one partition. Scores, containment and ranks are joins and windows over the frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, pieces, release
from .grams import CELL, CHUNK_BYTES, by_chunk, by_shard, cells, chunk_ids, dealt, gaps, grouped, n_shards, pack, summed, totals, unpack, words_of
from .hat_trie import HatTrie
from .shingles import _LOWER, mix64, slices, utf8_parts

U64 = np.uint64
_BREAKS = gaps(b".,;:!?\x0a\x0b\x0c\x0d")
_GAPS = _BREAKS | gaps(b"\x20\x09")
LONGEST = 4
FOUND = f"{CELL}, lang string, phrase array<long>, f long, word string"


def _pieces_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Word hashes, where a new piece begins, each word's row, and its bytes' place, of a column of texts."""
    data, off = utf8_parts(col)
    found, starts, stops, row = words_of(data, off, _GAPS)
    passed = np.concatenate(([0], np.cumsum(_BREAKS[data])))
    new = np.ones(len(found), bool)
    new[1:] = (passed[starts[1:]] != passed[stops[:-1]]) | (row[1:] != row[:-1])
    return found, new, row, (starts, stops), data


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of one language each: words by number from 1, a 0 before each piece, and the words' hashes and bytes in the order of their numbers."""
    ids, held, size = chunk_ids(), {}, 0

    def close() -> Iterator[pa.RecordBatch]:
        for lang, groups in held.items():
            tokens, new = np.concatenate([g[0] for g in groups]), np.concatenate([g[1] for g in groups])
            names, first, at = np.unique(tokens, return_index=True, return_inverse=True)
            base = np.cumsum([0, *(len(g[0]) for g in groups)])
            spelt = [b""] * len(names)
            owner = np.searchsorted(base, first, "right") - 1
            for i, (g, f) in enumerate(zip(owner.tolist(), first.tolist(), strict=True)):
                starts, stops, data = groups[g][2:]
                spelt[i] = data[starts[f - base[g]] : stops[f - base[g]]].tobytes()
            row = np.insert(at.astype(np.uint32) + np.uint32(1), np.flatnonzero(new), 0)
            lengths = np.array([len(s) for s in spelt], np.uint64)
            data = pack(row, names, lengths, np.frombuffer(b"".join(spelt), np.uint8), np.frombuffer(lang.encode(), np.uint8))
            made = cells([(next(ids), 0, -1, data)])
            yield pa.RecordBatch.from_arrays([*made.columns, pa.array([len(tokens)], pa.int64()), pa.array([lang])], names=[*made.schema.names, "n_words", "lang"])

    for b in pieces(batches):
        for i, j in slices(b.column(1)):
            langs = b.column(0).slice(i, j - i).dictionary_encode()
            col = b.column(1).slice(i, j - i)
            found, new, row, (starts, stops), data = _pieces_of(col)
            data = _LOWER[data]
            of = langs.indices.to_numpy()[row]
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                at = np.flatnonzero(of == k)
                if len(at):
                    salt = U64(xxhash.xxh64_intdigest(lang.encode()))
                    # the bytes are kept once for the slice; its languages share them
                    held.setdefault(lang, []).append((mix64(found[at] ^ salt), new[at], starts[at], stops[at], data))
            size += len(data)
            if size >= CHUNK_BYTES:
                yield from close()
                held, size = {}, 0
    yield from close()


def _ask_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for chunk, rows in grouped(batches, "chunk"):
        row, names, lengths, spelt, lang = unpack(rows[0][3])
        counts = np.bincount(row, minlength=len(names) + 1)[1:].astype(np.uint64)
        ends = np.cumsum(lengths, dtype=np.int64)
        words = [spelt[a:b] for a, b in zip((ends - lengths.astype(np.int64)).tolist(), ends.tolist(), strict=True)]
        for shard, at in dealt((names % U64(shards)).astype(np.int64)):
            yield cells([(chunk, 1, shard, pack(names[at], counts[at], lengths[at], np.concatenate([words[i] for i in at.tolist()]), lang))])


def _results(lang: list[str], phrases: list[list[int]], f: np.ndarray, words: list[str] | None = None) -> pa.RecordBatch:
    n = len(f)
    none = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.binary())]
    arrays = [*none, pa.array(lang, pa.string()), pa.array(phrases, pa.list_(pa.int64())), pa.array(f.astype(np.int64)), pa.array(words or [None] * n, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["chunk", "level", "shard", "data", "lang", "phrase", "f", "word"])


def _answers(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    made, n = cells(rows), len(rows)
    return pa.RecordBatch.from_arrays([*made.columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], names=[*made.schema.names, "lang", "phrase", "f", "word"])


def _signed(names: np.ndarray) -> list:
    return names.astype(U64).view(np.int64).tolist()


def _count_words(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Frequent words with their counts; to each chunk, which of its words are frequent."""
    for _, rows in grouped(batches, "shard"):
        asked = [unpack(r[3]) for r in rows]
        names, counts = summed(np.concatenate([a[0] for a in asked]), np.concatenate([a[1] for a in asked]).astype(np.uint64))
        often, known, spelt = counts >= least, np.zeros(len(names), bool), {}
        for (chunk, level, shard, _), (own, _, lengths, data, lang) in zip(rows, asked, strict=True):
            at = np.searchsorted(names, own)
            yield _answers([(chunk, level, shard, pack(often[at]))])
            ends = np.cumsum(lengths, dtype=np.int64)
            for i in np.flatnonzero(often[at] & ~known[at]).tolist():
                spelt[int(at[i])] = (lang.tobytes().decode(), data[ends[i] - int(lengths[i]) : ends[i]].tobytes().decode())
            known[at] = True
        some = sorted(spelt)
        yield _results([spelt[i][0] for i in some], [[x] for x in _signed(names[some])], counts[some], [spelt[i][1] for i in some])


def _frequent(rows: list[tuple[int, int, int, bytes]], shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunk's row with rare words as breaks, its names (the first, of a break, is 0), and its language."""
    row, names, _, _, lang = unpack(rows[0][3])
    often, answers = np.zeros(len(names) + 1, bool), {r[2]: r[3] for r in rows if r[1] == 1}
    for shard, at in dealt((names % U64(shards)).astype(np.int64)):
        often[at + 1] = unpack(answers[shard])[0]
    return np.where(often[row], row, 0).astype(np.int64), np.concatenate(([U64(0)], names)), lang


def _runs(paths: Iterator[np.ndarray], length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    trie = HatTrie(length)
    for p in paths:
        yield from trie.add(p)
    last = trie.spill()
    if len(last[1]):
        yield last


def _sent(chunk: int, level: int, runs: Iterator[tuple[np.ndarray, np.ndarray]], names: np.ndarray, lang: np.ndarray, prefix: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Runs dealt out by the hash of their paths' first words; each row has its own list of names."""
    for paths, counts in runs:
        key = np.zeros(len(paths), U64)
        for j in range(prefix):
            key = mix64(key * U64(0x9E3779B97F4A7C15) + names[paths[:, j]])
        for shard, at in dealt((key % U64(shards)).astype(np.int64)):
            own, place = np.unique(paths[at], return_inverse=True)
            place = place.reshape(len(at), -1).astype(np.uint32)
            yield cells([(chunk, level, shard, pack(lang, names[own], own.astype(np.uint64), counts[at].astype(np.uint64), *(place[:, j] for j in range(paths.shape[1]))))])


def _pairs(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of frequent words, and the pairs by number."""
    at = np.flatnonzero((row[:-1] > 0) & (row[1:] > 0)) if len(row) else np.zeros(0, np.int64)
    return at, (row[at] << 32) | row[at + 1]


def _ask_pairs(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for chunk, rows in grouped(batches, "chunk"):
        row, names, lang = _frequent(rows, shards)
        at, _ = _pairs(row)
        blocks = (np.stack((row[at[i : i + (1 << 18)]], row[at[i : i + (1 << 18)] + 1]), axis=1) for i in range(0, len(at), 1 << 18))
        yield from _sent(chunk, 2, _runs(blocks, 2), names, lang, 2, shards)


def _ask_long(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Runs of three or four words whose neighbours are frequent pairs; a missing fourth word is 0."""
    for chunk, rows in grouped(batches, "chunk"):
        row, names, lang = _frequent(rows, shards)
        at, pairs = _pairs(row)
        told = np.unique(np.concatenate([np.zeros(0, np.int64), *(unpack(r[3])[0].astype(np.int64) for r in rows if r[1] == 2)]))
        open_ = np.zeros(len(row) + LONGEST, bool)
        open_[at[np.isin(pairs, told)]] = True
        wide = np.concatenate((row, np.zeros(LONGEST, np.int64)))
        begins = np.flatnonzero(open_[:-1] & open_[1:])
        blocks = (
            np.stack((wide[i], wide[i + 1], wide[i + 2], np.where(open_[i + 2], wide[i + 3], 0)), axis=1) for i in (begins[j : j + (1 << 18)] for j in range(0, len(begins), 1 << 18))
        )
        yield from _sent(chunk, 3, _runs(blocks, LONGEST), names, lang, 3, shards)


class Merged:
    """All runs of a shard: names and languages, each path's words among the names (by column), its language and count, and where each request's part lies."""

    def __init__(self, rows: list[tuple[int, int, int, bytes]]) -> None:
        asked = [unpack(r[3]) for r in rows]
        spelt = [a[0].tobytes().decode() for a in asked]
        self.langs = sorted(set(spelt))
        sizes = [len(a[3]) for a in asked]
        self.lang = np.repeat([self.langs.index(x) for x in spelt], sizes)
        self.names = np.unique(np.concatenate([a[1] for a in asked]))
        self.columns = [np.concatenate([np.searchsorted(self.names, a[1])[a[j]] for a in asked]).astype(U64) for j in range(4, len(asked[0]))]
        self.counts = np.concatenate([a[3] for a in asked]).astype(np.uint64)
        ends = np.cumsum(sizes).tolist()
        self.places = [(e - n, e) for e, n in zip(ends, sizes, strict=True)]

    def found(self, first: np.ndarray, width: int, f: np.ndarray) -> pa.RecordBatch:
        """Results: the first ``width`` words of the paths at the given places, with their counts."""
        words = [_signed(self.names[self.columns[j][first].astype(np.int64)]) for j in range(width)]
        return _results([self.langs[i] for i in self.lang[first].tolist()], [list(w) for w in zip(*words, strict=True)], f)


def _grouped_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and sums of counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), counts
    order = np.argsort(keys, kind="stable")
    new = np.flatnonzero(np.concatenate(([True], np.diff(keys[order]) != 0)))
    return keys[order[new]], order[new], np.add.reduceat(counts[order], new)


def _count_pairs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Frequent pairs with their counts; to each chunk, its frequent pairs by number."""
    for _, rows in grouped(batches, "shard"):
        runs = Merged(rows)
        keys = runs.columns[0] << U64(32) | runs.columns[1]
        pairs, first, sums = _grouped_counts(keys, runs.counts)
        often = sums >= least
        mine = np.isin(keys, pairs[often])
        for (chunk, level, shard, data), (a, b) in zip(rows, runs.places, strict=True):
            _, _, own, _, p, q = unpack(data)
            hit = np.flatnonzero(mine[a:b])
            yield _answers([(chunk, level, shard, pack(own[p[hit]].astype(U64) << U64(32) | own[q[hit]].astype(U64)))])
        yield runs.found(first[often], 2, sums[often])


def _count_long(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Frequent phrases of three and of four words with their counts: a count of three words is the sum of all that begin with them."""
    for _, rows in grouped(batches, "shard"):
        runs = Merged(rows)
        a, b, c, d = runs.columns
        head = np.unique(a << U64(32) | b, return_inverse=True)[1].astype(U64) << U64(32) | c
        three, first, sums = _grouped_counts(head, runs.counts)
        often = sums >= least
        yield runs.found(first[often], 3, sums[often])
        whole = np.flatnonzero(runs.names[d.astype(np.int64)] != 0)
        _, first, sums = _grouped_counts(np.searchsorted(three, head[whole]).astype(U64) << U64(32) | d[whole], runs.counts[whole])
        often = sums >= least
        yield runs.found(whole[first[often]], 4, sums[often])


def count_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Exact counts of at least ``least``: ``(lang, phrase, f, word)`` of phrases of one to four word names (``word``: of one), and ``(lang, n)`` of all words.

    Both frames read durable tables.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = durable(docs.mapInArrow(_chunks, f"{CELL}, n_words long, lang string"), "chunks")
    n_chunks, size = totals(chunks)
    shards = n_shards(chunks, size)
    found = [durable(by_shard(by_chunk([chunks], n_chunks, partial(_ask_words, shards=shards)), shards, partial(_count_words, least=least), FOUND), "words")]
    for name, ask, count in (("pairs", _ask_pairs, _count_pairs), ("longer", _ask_long, _count_long)):
        told = (t.where("chunk IS NOT NULL") for t in found)
        found.append(durable(by_shard(by_chunk([chunks, *told], n_chunks, partial(ask, shards=shards)), shards, partial(count, least=least), FOUND), name))
    counts = found[0].unionByName(found[1]).unionByName(found[2]).where("phrase IS NOT NULL").select("lang", "phrase", "f", "word")
    counts = durable(counts, "phrases")
    sizes = durable(chunks.groupBy("lang").agg(F.sum("n_words").alias("n")), "sizes")
    release(chunks, *found)
    return counts, sizes


def score_cuts(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of phrases of two words and more, by the lowest-scoring cut (ties: the first).

    Both parts of a cut are phrases with a count of their own, as they are at least as frequent.
    """
    whole = counts.where(F.size("phrase") > 1).select("lang", "phrase", F.col("f").alias("a"))
    cuts = whole.select("*", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("phrase", F.lit(1), F.col("k")).alias("head"), F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k")).alias("tail"))
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(counts.select(F.col("phrase").alias(part), F.col("f").alias(name)), part)
    score = F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def uncontained(scored: DataFrame) -> DataFrame:
    """Without phrases that a longer one contains at least 80 times out of 100."""
    m, size = F.col("m"), F.size("phrase")
    inside = scored.where(size > 2).select("phrase", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("m")).select("*", F.explode(F.sequence(F.lit(1), size - m + 1)).alias("at"))
    longest = inside.groupBy(F.slice("phrase", F.col("at"), m).alias("phrase")).agg(F.max("a").alias("longer"))
    return scored.join(longest, "phrase", "left").where("longer IS NULL OR CAST(100 AS DECIMAL(20, 0)) * longer < CAST(80 AS DECIMAL(20, 0)) * a").drop("longer")


def mine_phrases(docs: DataFrame, least: int = 30, top: int = 2000) -> DataFrame:
    """Each language's ``top`` phrases of ``docs`` (``lang``, ``text``; other columns are ignored) that occur ``least`` times or more.

    A null language is ``und``, as that name is; a null text counts as empty. Repeated rows count each time. Ties in score and count are
    ranked by the phrase's UTF-8 bytes. An empty table, or one without frequent phrases, gives no rows. Words are named by 64-bit hashes.
    """
    counts, sizes = count_phrases(docs, least)
    kept = uncontained(durable(score_cuts(counts), "scored"))
    # ties at the end are told apart by the words themselves, which only these need
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    head = kept.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= top)
    words = counts.where("word IS NOT NULL").select(F.col("phrase")[0].alias("name"), "word")
    spelt = head.select("*", F.posexplode("phrase").alias("pos", "name")).join(words, "name").groupBy("lang", "phrase", "a", "l", "r", "score")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ")
    named = spelt.agg(text.alias("text")).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")).cast("long"))
    return named.where(F.col("rank") <= top).join(sizes, "lang").select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
