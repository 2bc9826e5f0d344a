"""Document fingerprints: MinHash over five-word shingles, and near-duplicate classes from signature bands.

A signature is the minimum of 128 universal hash permutations over a text's shingle hashes, computed for
all texts of a batch at once; the fingerprint keeps the low 16 bits of each minimum, as hexadecimal
text. Likeness is the share of equal places. A text without words has the empty fingerprint, which is like
itself (1.0) and unlike all others (0.0).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_KEYS, HOT_ROWS, durable, parts, release
from .ngram_join import similarity_components
from .shingles import mix64, shingle_hashes, slices, utf8_parts

#: Signature length, and rows of it that make a band (32 bands of 4 rows: at a similarity of 0.8 a pair shares no band with a probability of 5e-8).
PERMUTATIONS, BAND = 128, 4
WORDS = 5
_RNG = np.random.Generator(np.random.PCG64(20240229))
_A = _RNG.integers(0, 1 << 31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, PERMUTATIONS, np.uint32)


def minima(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Signatures (rows x PERMUTATIONS, 32 bits) of texts given by their shingle hashes; all ones without shingles."""
    out = np.full((len(offsets) - 1, PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        x, starts = (shingles >> np.uint64(32)).astype(np.uint32), offsets[:-1][full]
        work = np.empty_like(x)
        for p in range(PERMUTATIONS):
            np.multiply(x, _A[p], out=work)
            np.add(work, _B[p], out=work)
            out[full, p] = np.minimum.reduceat(work, starts)
    return out


def band_keys(s: np.ndarray) -> np.ndarray:
    """Keys of a shingle set: one for each band of its signature."""
    sig = minima(s, np.array([0, len(s)]))[0].astype(np.uint64).reshape(-1, BAND)
    value = np.arange(1, len(sig) + 1, dtype=np.uint64)
    for j in range(BAND):
        value = mix64(value ^ mix64(sig[:, j] + np.uint64(j)))
    return value.astype(np.int64)


def _signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """16-bit signatures of the texts, and whether each has words."""
    sigs, words = [], []
    for i, j in slices(texts):
        h, off = shingle_hashes(*utf8_parts(texts.slice(i, j - i)), WORDS)
        sigs.append((minima(h, off) & np.uint32(0xFFFF)).astype(np.uint16))
        words.append(np.diff(off) > 0)
    return np.concatenate(sigs), np.concatenate(words)


def _likeness(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> np.ndarray:
    return np.where(wa & wb, (a == b).mean(axis=1), (wa == wb).astype(float))


def _hex(sigs: np.ndarray, words: np.ndarray) -> pa.Array:
    return pa.array([s.tobytes().hex() if w else "" for s, w in zip(sigs, words, strict=True)], pa.string())


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([b.column(0), _hex(*_signatures(b.column(1)))], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row of ``docs`` (``doc_id``, ``text``); null texts count as empty."""
    return docs.select("doc_id", "text").mapInArrow(_plain, "doc_id long, fingerprint string")


def near_duplicates(docs: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: classes of texts linked by a Jaccard similarity of num/den or more.

    Documents that share a signature band are joined in Spark and verified on their shingle sets.
    """
    return similarity_components(docs, WORDS, num, den, band_keys)


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, tail, key): each row's next document is the row after it, and of all but one of ``m`` equal rows itself."""
    held = None  # the last row so far
    for b in batches:
        for i, j in slices(b.column("text")):
            part = b.slice(i, j - i)
            ids, tails, texts, m = (part.column(c).to_pylist() for c in ("doc_id", "tail", "text", "m"))
            texts = [t or "" for t in texts]
            if held:
                ids, tails, texts, m = ([h, *x] for h, x in zip(held, (ids, tails, texts, m), strict=True))
            held = ids[-1], tails[-1], texts[-1], m[-1]
            pairs = [(r, r + 1, 1) for r in range(len(ids) - 1) if not tails[r]] + [(r, r, m[r] - 1) for r in range(len(ids) - 1) if not tails[r] and m[r] > 1]
            if not pairs:
                continue
            at, nxt, copies = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
            edited = [texts[r][: len(texts[r]) - len(texts[r]) // 2] + texts[q][: len(texts[r]) // 2] for r, q, _ in pairs]
            sig, words = _signatures(pa.array(texts, pa.large_string()))
            esig, ewords = _signatures(pa.array(edited, pa.large_string()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[r] for r in at], pa.int64()),
                    pa.array([len(texts[r]) for r in at], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    _hex(sig[at], words[at]),
                    _hex(esig, ewords),
                    pa.array(_likeness(sig[at], words[at], esig, ewords)),
                    pa.array(_likeness(sig[at], words[at], sig[nxt], words[nxt])),
                    pa.array(copies),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "copies"],
            )


#: Copies of a row that are given back at a time.
RUN = 10_000
#: Keys that are sampled for each range, to place its bounds.
KEYS_PER_RANGE = 32


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half comes from the next document.

    Documents are ordered by doc_id (null first, repeated ones by a hash of the text and the text), the first follows the last. One
    shuffle deals them into ranges of (doc_id, hash), so ids of any size and many texts under one id are spread alike; only
    rows equal in both lie in one range; where these are very many they are one row with their number, so that a task computes them once. Bounds come from a sample of these pairs (KEYS_PER_RANGE a range); the first
    document of a range also goes, as its tail, to the range before (one row of each batch that holds it).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.lit(1).cast("long").alias("m"))
    keys = durable(keyed.select("key", "h"), "keys")
    total, first = keys.agg(F.count("*"), F.min(F.struct("key", "h"))).first()
    if not total:
        return spark.createDataFrame([], _EDITED)
    n = 4 * parts(spark)
    drawn = keys.sample(min(1.0, 2 * KEYS_PER_RANGE * n / total), seed=7).limit(4 * KEYS_PER_RANGE * n).toArrow()
    key, h = (drawn.column(i).to_numpy() for i in range(2))
    at = np.lexsort((h, key))[np.arange(1, n) * drawn.num_rows // n] if drawn.num_rows else []
    pairs = sorted({tuple(first), *zip(key[at].tolist(), h[at].tolist(), strict=True)})
    bounds, hashes = np.array([k for k, _ in pairs], np.int64), np.array([h for _, h in pairs], np.int64)

    @F.pandas_udf("array<int>")
    def ranges(key: pd.Series, h: pd.Series) -> pd.Series:
        k, h = key.to_numpy(np.int64), h.to_numpy(np.int64)
        low, high = np.searchsorted(bounds, k, "left"), np.searchsorted(bounds, k, "right")
        at = high - 1
        for i in np.flatnonzero(high > low):  # keys that are bounds: the hash decides
            at[i] = low[i] + np.searchsorted(hashes[low[i] : high[i]], h[i], "right") - 1
        lead = (bounds[at] == k) & (hashes[at] == h)
        tails = set(np.flatnonzero(lead)[np.unique(at[lead], return_index=True)[1]].tolist())
        return pd.Series([[b, -1 - (b - 1) % len(bounds)] if i in tails else [b] for i, b in enumerate(at.tolist())])

    # at most HOT_KEYS of them
    hot = durable(keys.groupBy("key", "h").count().where(F.col("count") > max(HOT_ROWS, total // HOT_KEYS)).select("key", "h"), "hot-rows")
    release(keys)
    some = not hot.isEmpty()
    if some:
        hot = F.broadcast(hot)
        one = keyed.join(hot, ["key", "h"], "left_semi").groupBy("doc_id", "key", "h").agg(F.first("text").alias("text"), F.sum("m").alias("m"))
        keyed = keyed.join(hot, ["key", "h"], "left_anti").unionByName(one)
    dealt = keyed.select("doc_id", "text", "key", "h", "m", F.explode(ranges("key", "h")).alias("r"))
    dealt = dealt.select("doc_id", "text", "key", "h", "m", (F.col("r") < 0).alias("tail"), F.when(F.col("r") < 0, -1 - F.col("r")).otherwise(F.col("r")).alias("bucket"))
    rows = dealt.repartition(parts(spark), "bucket").sortWithinPartitions("bucket", "tail", "key", "h", "text")
    out = rows.select("doc_id", "tail", "text", "m").mapInArrow(_edited, f"{_EDITED}, copies long")
    if some:
        runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN))
        out = out.select("*", F.explode(runs).alias("run")).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(RUN).cast("long"), F.col("copies") - F.col("run") * RUN))).alias("copy"))
    return out.drop("copies", "run", "copy")
