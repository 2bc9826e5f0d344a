"""Language-model scores of documents from an n-gram model of all training documents.

The model interpolates with absolute discounting: p(w | h) = max(c(hw) - D, 0) / c(h) + D T(h) / c(h) p(w | h'), T(h) the number of different
successors of h, h' the context without its first word; below it is the unigram base with 0.1 added. A text is its words, then an end;
contexts begin with a mark that isn't predicted. A context of two words or more has a level of its own if it was seen ``min_context`` times. Nothing else is cut: counts cover all training documents.

1. Tasks cut documents into chunks of words by number (see grams).
2. For each order, chunks ask the shards, by the hash of the context, for their distinct n-grams. A shard adds up the counts and builds its part
   of the trie: Elias-Fano levels with monotone pointers and 16-bit codes of the probabilities, memory-mapped, searched by successor.
3. Each chunk interpolates the answers and adds up its documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, pieces, release
from .elias_fano import Trie
from .grams import BATCH_CELLS, CELL, CHUNK_BYTES, by_chunk, by_shard, cells, chunk_ids, dealt, gaps, grouped, indexed, n_shards, pack, summed, totals, unpack, words_of
from .shingles import mix64, slices, utf8_parts

U64 = np.uint64
_GAPS = gaps(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Names of the begin and the end of a text among word hashes.
BEGIN, END = U64(0x8BB84B93962EACC9), U64(0x4B33A62ED433D4A3)
DISCOUNT, ADDED = 0.75, 0.1
#: Codes hold -log10 of a probability in steps of 1 / STEPS; NONE is a probability of 0.
STEPS, NONE = 4096, 65535
#: Added to the level of answers that tell which n-grams may be contexts.
OFTEN = 100
#: Tokens whose probabilities are worked out at once.
TOKENS = 1 << 17


def code(p: np.ndarray) -> np.ndarray:
    """Quantised probabilities."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.minimum(np.round(-np.log10(p) * STEPS), NONE - 1), NONE).astype(np.uint16)


def value(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == NONE, 0.0, 10.0 ** (codes / -STEPS))


#: The value of every code.
VALUES = value(np.arange(NONE + 1, dtype=np.uint16))


def _framed(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts, each between a begin and an end, and their numbers."""
    found, _, _, doc = words_of(*utf8_parts(col), _GAPS)
    lengths = np.bincount(doc, minlength=len(col)) + 2
    stops = np.cumsum(lengths)
    tokens, inside = np.empty(stops[-1], U64), np.ones(stops[-1], bool)
    inside[stops - lengths] = inside[stops - 1] = False
    tokens[stops - lengths], tokens[stops - 1], tokens[inside] = BEGIN, END, found
    return tokens, lengths


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of documents: ids, flags (1: learnt from, 2: the id is null), lengths, words by number, and the words' sorted hashes."""
    ids, held, size = chunk_ids(), [], 0

    def close() -> pa.RecordBatch:
        doc_id, flags, lengths, tokens = (np.concatenate(x) for x in zip(*held, strict=True))
        words, at = indexed(tokens)
        row = cells([(next(ids), 0, -1, pack(doc_id, flags, lengths, at, words))])
        return pa.RecordBatch.from_arrays([*row.columns, pa.array([len(tokens)], pa.int64())], names=[*row.schema.names, "n_words"])

    for b in pieces(batches):
        for i, j in slices(b.column(1)):
            part = b.slice(i, j - i)
            tokens, lengths = _framed(part.column(1))
            doc_id = part.column(0)
            flags = part.column(2).to_numpy(zero_copy_only=False).astype(np.uint8) + 2 * doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
            held.append((doc_id.fill_null(0).to_numpy(), flags, lengths, tokens))
            size += part.column(1).nbytes
            if size >= CHUNK_BYTES:
                yield close()
                held, size = [], 0
    if held:
        yield close()


class Grams:
    """The n-grams of a chunk, level by level; ``answers[k]``: codes for those of level k, as far as they have come.

    What there is for each token takes 32 bits or one byte: a worker holds a few such arrays beside its answers.
    """

    def __init__(self, data: bytes, shards: int) -> None:
        self.doc_id, self.flags, self.lengths, at, self.words = unpack(data)
        self.shards = shards
        self.at = at.astype(np.uint32)
        self.lengths = self.lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat((self.flags & 1).astype(bool), self.lengths)
        self.predicted = np.ones(len(self.at), bool)
        self.predicted[self.starts] = False
        # n-gram that ends at each token, hashes of n-grams, and the tokens with a context of the level
        self.level, self.node, self.hashes, self.open = 1, self.at, self.words, self.predicted

    def unigrams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each shard: places of its words, and their counts in training documents."""
        counts = np.bincount(self.at[self.predicted & self.train], minlength=len(self.words)).astype(np.uint64)
        for shard, at in dealt((self.words % U64(self.shards)).astype(np.int64)):
            yield shard, at, counts[at]

    def of_documents(self, x: np.ndarray) -> np.ndarray:
        """Sums over the predicted tokens of each document; ``x`` is overwritten."""
        x[~self.predicted] = 0
        return np.add.reduceat(x, self.starts, dtype=np.int64 if x.dtype == bool else x.dtype)

    def climb(self) -> None:
        """Goes on to the n-grams of the next level."""
        self.level += 1
        # the first token of a chunk is a begin, so each open token has one before it
        self.tokens = np.flatnonzero(self.open).astype(np.uint32)
        key = self.node[:-1][self.open[1:]].astype(U64)
        key *= U64(len(self.words))
        key += self.at[self.open]
        self.node = self.type = None
        types, self.type = indexed(key)
        del key
        n = U64(max(len(self.words), 1))
        self.context, self.word = self.hashes[(types // n).astype(np.int64)], self.words[(types % n).astype(np.int64)]
        self.hashes = None
        self.deal = list(dealt((mix64(self.context) % U64(self.shards)).astype(np.int64)))

    def counts(self) -> np.ndarray:
        """How often training documents have each n-gram of the level."""
        return np.bincount(self.type[self.train[self.tokens]], minlength=len(self.word)).astype(np.uint64)

    def codes(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the probabilities and of the weights of the shorter context for each n-gram of the level."""
        alpha, gamma = np.full(len(self.word), NONE, np.uint16), np.full(len(self.word), NONE, np.uint16)
        for shard, at in self.deal:
            alpha[at], gamma[at] = unpack(answers[shard])
        return alpha, gamma

    def interpolate(self, p: np.ndarray, answers: dict[int, bytes]) -> None:
        """Turns probabilities of tokens by shorter contexts, ``p``, into those by the level's."""
        alpha, gamma = self.codes(answers)
        for i in range(0, len(self.tokens), TOKENS):
            at, of = self.tokens[i : i + TOKENS], self.type[i : i + TOKENS]
            p[at] = VALUES[alpha[of]] + VALUES[gamma[of]] * p[at]

    def extend(self, answers: dict[int, bytes]) -> None:
        """Opens the next level where the n-grams of this one are often enough."""
        often = np.zeros(len(self.word), bool)
        for shard, at in self.deal:
            (often[at],) = unpack(answers[shard])
        node, may = np.zeros(len(self.at), np.uint32), np.zeros(len(self.at), bool)
        node[self.tokens], may[self.tokens] = self.type, often[self.type]
        self.node, self.hashes = node, mix64(self.context * U64(0x9E3779B97F4A7C15) + self.word)
        self.tokens = self.type = self.context = self.word = self.deal = None
        self.open = np.concatenate(([False], may[:-1])) & self.predicted


def _ask_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for chunk, rows in grouped(batches, "chunk"):
        grams = Grams(rows[0][3], shards)
        yield cells([(chunk, 1, shard, pack(grams.words[at], counts)) for shard, at, counts in grams.unigrams()])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact counts of the words asked for; a row with a null chunk tells the shard's sums: different words, and all words, of training documents."""
    for shard, rows in grouped(batches, "shard"):
        asked = [unpack(r[3]) for r in rows]
        words, counts = summed(np.concatenate([a[0] for a in asked]), np.concatenate([a[1] for a in asked]).astype(np.uint64))
        known = words != BEGIN
        yield cells([(None, 1, shard, np.array([(counts[known] > 0).sum(), counts[known].sum()], np.uint64).tobytes())])
        for (chunk, level, _, _), a in zip(rows, asked, strict=True):
            yield cells([(chunk, level, shard, pack(counts[np.searchsorted(words, a[0])]))])


def _by_level(rows: list[tuple[int, int, int, bytes]]) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    for _, level, shard, data in rows:
        out.setdefault(level, {})[shard] = data
    return out


def _ask_grams(batches: Iterator[pa.RecordBatch], level: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of a level with their counts in the chunk: contexts and how many each has, words as places in a list."""
    for chunk, rows in grouped(batches, "chunk"):
        answers, grams = _by_level(rows[1:]), Grams(rows[0][3], shards)
        grams.climb()
        while grams.level < level:
            grams.extend(answers[OFTEN + grams.level])
            grams.climb()
        counts = grams.counts()
        for shard, at in grams.deal:
            context = grams.context[at]
            new = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
            yield cells([(chunk, level, shard, pack(context[new], np.diff(np.append(new, len(at))).astype(np.uint64), *indexed(grams.word[at]), counts[at]))])


def build_trie(requests: list[bytes], min_context: int) -> Trie:
    """The shard's part of the model: codes of c - D over c(h), and whether an n-gram is often enough for a context; of contexts: codes of D over c(h)."""
    names = [unpack(r) for r in requests]
    contexts, words = np.unique(np.concatenate([x[0] for x in names])), np.unique(np.concatenate([x[2] for x in names]))
    keys, counts = [], []
    for context, n, word, at, count in names:
        owner = np.repeat(np.searchsorted(contexts, context), n.astype(np.int64)).astype(U64)
        seen = count > 0
        keys.append((owner * U64(len(words)) + np.searchsorted(words, word)[at].astype(U64))[seen])
        counts.append(count[seen].astype(np.uint64))
    key, count = summed(np.concatenate(keys), np.concatenate(counts))
    owner, word = (key // U64(max(len(words), 1))).astype(np.int64), (key % U64(max(len(words), 1))).astype(np.int64)
    count = count.astype(np.float64)
    whole = np.bincount(owner, count, len(contexts))
    return Trie(contexts, words, owner, word, [code((count - DISCOUNT) / whole[owner]), count >= min_context], [code(DISCOUNT / np.maximum(whole, 1)), whole > 0])


def look_up(trie: Trie, request: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of each n-gram's probability and of the shorter context's weight, and whether it may be a context."""
    context, n, word, of, _ = unpack(request)
    owner = np.repeat(np.arange(len(context)), n.astype(np.int64))
    c, at = trie.find(context, word, owner, of)
    known, hit = trie.context_codes[1][np.maximum(c, 0)] & (c >= 0), at >= 0
    alpha, often = np.full(len(of), NONE, np.uint16), np.zeros(len(of), bool)
    alpha[hit], often[hit] = trie.codes[0][at[hit]], trie.codes[1][at[hit]]
    gamma = np.ones(len(c))
    gamma[known] = value(trie.context_codes[0][c[known]]) * trie.fanout(c[known])
    return alpha, code(gamma)[owner], often


def _answer_grams(batches: Iterator[pa.RecordBatch], min_context: int) -> Iterator[pa.RecordBatch]:
    for shard, rows in grouped(batches, "shard"):
        trie = build_trie([r[3] for r in rows], min_context)
        for chunk, level, _, data in rows:
            alpha, gamma, often = look_up(trie, data)
            yield cells([(chunk, level, shard, pack(alpha, gamma)), (chunk, OFTEN + level, shard, pack(often))])


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(batches: Iterator[pa.RecordBatch], order: int, shards: int, n_words: int, n_all: int) -> Iterator[pa.RecordBatch]:
    for _, rows in grouped(batches, "chunk"):
        answers, grams = _by_level(rows[1:]), Grams(rows[0][3], shards)
        counts = np.zeros(len(grams.words))
        for shard, at, _ in grams.unigrams():
            counts[at] = unpack(answers[1][shard])[0]
        base = (counts + ADDED) / (n_all + ADDED * (n_words + 1))
        base_score, n_known = grams.of_documents(np.log10(base)[grams.at]), grams.of_documents((counts > 0)[grams.at])
        p = base[grams.at]
        while grams.level < order:
            grams.climb()
            grams.interpolate(p, answers.get(grams.level, {}))
            if grams.level < order:
                grams.extend(answers.get(OFTEN + grams.level, {}))
        score = grams.of_documents(np.log10(p, out=p))
        n = len(grams.doc_id)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(grams.doc_id, pa.int64(), mask=grams.flags >= 2), pa.array((grams.flags & 1) == 0), pa.array(grams.lengths - 1, pa.int64()),
                pa.array(n_known), pa.array(np.full(n, n_all, np.int64)), pa.array(base_score), pa.array(score),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )


def score_texts(docs: DataFrame, order: int = 3, min_context: int = 4) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``, ``held_out``; other columns are ignored) with its base and model log10 probabilities.

    The model learns from rows whose ``held_out`` is false or null. A null text counts as empty: its one token is the end. Null and repeated ids
    keep their rows. Without training rows every token has the base's probability of unknown words. Words are
    named by 64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text", (~F.coalesce("held_out", F.lit(False))).alias("train"))
    chunks = durable(docs.mapInArrow(_chunks, f"{CELL}, n_words long"), "chunks")
    # a few rows of the exchange at once, as some are wide
    kept = partial(durable, batch_rows=BATCH_CELLS)
    n_chunks, size = totals(chunks)
    shards = n_shards(chunks, size)
    asked = by_chunk([chunks], n_chunks, partial(_ask_words, shards=shards))
    found = kept(by_shard(asked, shards, _count_words), "counts")
    sums = [np.frombuffer(r[0], np.uint64) for r in found.where("chunk IS NULL").select("data").collect()]  # one row a shard
    n_words, n_all = (int(sum(int(s[i]) for s in sums)) for i in range(2))
    told = []
    for level in range(2, order + 1):
        asked = by_chunk([chunks, *(t.where(F.col("level") > OFTEN) for t in told)], n_chunks, partial(_ask_grams, level=level, shards=shards))
        told.append(kept(by_shard(asked, shards, partial(_answer_grams, min_context=min_context)), "codes"))
    answers = [found.where("chunk IS NOT NULL"), *told]
    scores = kept(by_chunk([chunks, *answers], n_chunks, partial(_score, order=order, shards=shards, n_words=n_words, n_all=n_all), SCORES), "scores")
    release(chunks, found, *told)
    return scores


def score_documents(docs: DataFrame) -> DataFrame:
    """The query's split: rows whose crc32(doc_id as text) mod 10 is 0 are held out (a null id: learnt from)."""
    return score_texts(docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 10 == 0))
