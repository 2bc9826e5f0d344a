"""Vectorised word and word-shingle hashing over Arrow string columns.

Everything works on the UTF-8 bytes of whole texts: ASCII letters are lower-cased, a word is a maximal
run of bytes other than space and 0x09-0x0D, and a shingle is ``k`` consecutive words (a text with
fewer words has its whole word sequence as its one shingle, a text without words has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BYTE_BASE, _WORD_BASE = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text handled at once, a bound on working memory (a longer single text is one slice).
SLICE_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.cumprod(out, dtype=U64)


def utf8_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(col: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about SLICE_BYTES of text each."""
    _, off = utf8_parts(col)
    start = 0
    while start < len(off) - 1:
        stop = max(start + 1, int(np.searchsorted(off, off[start] + SLICE_BYTES, "right")) - 1)
        yield start, stop
        start = stop


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts in order, and each text's offsets among them."""
    n, rows = len(data), len(off) - 1
    if n == 0:
        return np.zeros(0, U64), np.zeros(rows + 1, np.int64)
    data = _LOWER[data]
    word = ~_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    at = off[:-1][off[:-1] < n]
    begins[at] = word[at]
    starts = np.flatnonzero(begins)
    counts = np.zeros(rows + 1, np.int64)
    np.cumsum(np.bincount(np.searchsorted(off, starts, "right") - 1, minlength=rows)[:rows], out=counts[1:])
    if len(starts) == 0:
        return np.zeros(0, U64), counts
    first = starts[0]
    gaps = np.diff(np.append(starts, n))
    place = np.arange(first, n) - np.repeat(starts, gaps)
    value = _powers(_BYTE_BASE, int(gaps.max()) + 1)[place] * (data[first:].astype(U64) + U64(1))
    value[~word[first:]] = 0
    return mix64(np.add.reduceat(value, starts - first)), counts


def shingle_hashes(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles (repeats kept) of all texts in order, and each text's offsets."""
    words, wo = word_hashes(data, off)
    n = np.diff(wo)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    so = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros(int(so[-1]), U64)
    power = _powers(_WORD_BASE, max(k, 1))
    if len(words) >= k:
        full = np.zeros(len(words) - k + 1, U64)
        for j in range(k):
            full += words[j : len(words) - k + 1 + j] * power[j]
        doc = np.repeat(np.arange(len(n)), n)
        inside = doc[: len(full)] == doc[k - 1 :]
        long_rows = np.repeat(n >= k, counts)
        out[long_rows] = full[inside]
    for r in np.flatnonzero((n > 0) & (n < k)):
        w = words[wo[r] : wo[r + 1]]
        out[so[r]] = (w * power[: len(w)]).sum(dtype=U64) + U64(len(w))
    return mix64(out), so


def shingle_sets(col: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    for a, b in slices(col):
        h, so = shingle_hashes(*utf8_parts(col.slice(a, b - a)), k)
        for r in range(b - a):
            yield np.unique(h[so[r] : so[r + 1]])
