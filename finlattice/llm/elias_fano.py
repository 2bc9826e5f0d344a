"""Elias-Fano sequences and the n-gram trie made of them, in one memory-mapped file.

A sequence of n non-decreasing numbers below u keeps the lower log2(u / n) bits of each as they are, and the upper bits in
unary: number i sets bit (upper part + i). Select on these bits, by a count for each word of 64, gives access and successor search.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

U64 = np.uint64
_POP = np.array([bin(x).count("1") for x in range(256)], np.uint8)
#: For each byte value and r: the place of its r-th set bit.
_SELECT = np.array([([i for i in range(8) if x >> i & 1] + [0] * 8)[:8] for x in range(256)], np.uint8)
#: Numbers packed or looked up at once.
SLICE = 1 << 17


class Sequence:
    """An Elias-Fano sequence over arrays of words, which may lie in a mapped file."""

    def __init__(self, n: int, low_bits: int, top: int, arrays: list[np.ndarray]) -> None:
        self.n, self.low_bits, self.top = n, low_bits, top
        self.low, self.high, self.ones = arrays

    @staticmethod
    def encode(values: np.ndarray) -> tuple[tuple[int, int, int], list[np.ndarray]]:
        """Head and arrays of a sequence; see __init__."""
        values, n = values.astype(U64), len(values)
        last = int(values[-1]) if n else 0
        low_bits = max(0, (last // max(n, 1)).bit_length() - 1)
        top = last >> low_bits
        bits = np.zeros(-(-(n + top + 1) // 64) * 64, np.uint8)
        bits[(values >> U64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(U64)
        ones = np.concatenate(([0], np.cumsum(_POP[high.view(np.uint8)].reshape(-1, 8).sum(axis=1, dtype=np.int64)))).astype(U64)
        places = np.arange(low_bits, dtype=U64)
        packed = [np.packbits((values[i : i + SLICE, None] >> places & U64(1)).astype(np.uint8).ravel(), bitorder="little") for i in range(0, n, SLICE)] if low_bits else []
        low = np.concatenate((*packed, np.zeros(16, np.uint8)))
        return (n, low_bits, top), [low[: len(low) // 8 * 8].view(U64), high, ones]

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), U64)
        bit = at.astype(U64) * U64(self.low_bits)
        word, shift = (bit >> U64(6)).astype(np.int64), bit & U64(63)
        over = np.where(shift > 0, self.low[word + 1] << (U64(64) - np.maximum(shift, U64(1))), U64(0))
        return (self.low[word] >> shift | over) & U64((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Places of the k-th set (or clear) bits of the upper parts."""
        before = self.ones if one else np.arange(len(self.ones), dtype=U64) * U64(64) - self.ones
        word = np.searchsorted(before, k.astype(U64), "right") - 1
        rest = k - before[word].astype(np.int64)
        raw = self.high[word] if one else ~self.high[word]
        raw = raw.view(np.uint8).reshape(-1, 8)
        upto = np.cumsum(_POP[raw], axis=1, dtype=np.int64)
        byte = (upto <= rest[:, None]).sum(axis=1)
        rows = np.arange(len(k))
        rest = rest - np.where(byte > 0, upto[rows, np.maximum(byte - 1, 0)], 0)
        return word * 64 + byte * 8 + _SELECT[raw[rows, byte], rest]

    def access(self, at: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        return ((self._select(at, True) - at).astype(U64) << U64(self.low_bits)) | self._low(at)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each number, -1 where it isn't in the sequence: its successor is searched among those with its upper part."""
        return np.concatenate([self._find(x[i : i + SLICE]) for i in range(0, len(x), SLICE)]) if len(x) else np.zeros(0, np.int64)

    def _find(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), -1, np.int64)
        upper = x.astype(U64) >> U64(self.low_bits)
        asked = np.flatnonzero(upper <= U64(self.top)) if self.n else out[:0]
        if not len(asked):
            return out
        h = upper[asked].astype(np.int64)
        lower = x[asked].astype(U64) & U64((1 << self.low_bits) - 1)
        lo = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - (h - 1), 0)
        end = self._select(h, False) - h
        hi = end.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            less = self._low(mid) < lower[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        hit = lo < end
        hit[hit] = self._low(lo[hit]) == lower[hit]
        out[asked[hit]] = lo[hit]
        return out


class Trie:
    """One level of an n-gram trie: contexts, a monotone pointer from each to its successors, their codes.

    Contexts and words are named by hashes; a successor is kept as its word's rank beside its context's, so that the search
    for it runs inside the context's range only. The arrays lie in an unnamed scratch file of the task, mapped read-only: pages
    are loaded as they are asked for and the file goes with the object.
    """

    def __init__(self, contexts: np.ndarray, words: np.ndarray, owner: np.ndarray, word: np.ndarray, codes: list[np.ndarray], context_codes: list[np.ndarray]) -> None:
        """``contexts`` and ``words``: sorted hashes; ``owner`` and ``word``: places among them of each successor, sorted; codes of successors and of contexts."""
        self.n_words = len(words)
        pointers = np.searchsorted(owner, np.arange(len(contexts) + 1))
        sequences = [Sequence.encode(v) for v in (contexts, words, pointers, owner.astype(U64) * U64(max(self.n_words, 1)) + word.astype(U64))]
        arrays = [a for _, group in sequences for a in group] + codes + context_codes
        with tempfile.TemporaryFile() as file:
            at = []
            for a in arrays:
                at.append(file.tell())
                file.write(np.ascontiguousarray(a).tobytes())
                file.write(bytes(-file.tell() % 8 + 8))
            file.flush()
            self.bytes = file.tell()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        views = [np.frombuffer(self.map, a.dtype, len(a), start) for a, start in zip(arrays, at, strict=True)]
        self.contexts, self.words, self.pointers, self.successors = (Sequence(*head, views[3 * i : 3 * i + 3]) for i, (head, _) in enumerate(sequences))
        self.codes, self.context_codes = views[12 : 12 + len(codes)], views[12 + len(codes) :]

    def find(self, context: np.ndarray, word: np.ndarray, owner: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of different contexts, and of the successors that are word ``of[i]`` after context ``owner[i]``; -1 where there is none."""
        c, w = self.contexts.find(context), self.words.find(word)
        place, head, tail = np.full(len(of), -1, np.int64), c[owner], w[of]
        both = np.flatnonzero((head >= 0) & (tail >= 0))
        place[both] = self.successors.find(head[both].astype(U64) * U64(max(self.n_words, 1)) + tail[both].astype(U64))
        return c, place

    def fanout(self, c: np.ndarray) -> np.ndarray:
        """Number of successors of the contexts at the given places."""
        return (self.pointers.access(c + 1) - self.pointers.access(c)).astype(np.int64) if len(c) else np.zeros(0, np.int64)
