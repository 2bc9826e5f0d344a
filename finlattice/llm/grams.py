"""Words of whole texts as ids of a chunk, and the exchange of n-grams between chunks and shards.

Counts over all documents are formed without sending every token through a shuffle: a task cuts its documents into chunks of a
bounded size of text, a chunk asks once for each distinct n-gram it holds, with its own count of it, and the shard that an
n-gram falls to adds these up and answers each chunk. Requests and answers are packed arrays, so that Spark moves few rows.
Every table of the exchange has the columns of CELL: a chunk's words (level 0), or a shard's part of a level's requests or answers.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts
from .shingles import _BYTE_BASE, _LOWER, _powers, mix64

U64 = np.uint64
CELL = "chunk long, level int, shard int, data binary"
#: Bytes of text of a chunk (a longer single text is one chunk), words of all texts for each shard, chunks of a partition.
CHUNK_BYTES, SHARD_WORDS, CHUNKS_IN_PART = 16 << 20, 4_000_000, 2
#: Cells of a batch that a worker gets: some are megabytes, so that a batch of a whole partition would be held several times.
BATCH_CELLS = 32


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; unsigned integers in as few bytes as their largest needs, wider ones as all first bytes, then all second ones."""
    out = []
    for a in arrays:
        if a.dtype.kind == "u" and len(a):
            a = a.astype(np.min_scalar_type(a.max()))
        wide = a.dtype.itemsize if a.dtype.itemsize > 2 else 1
        out.append((a.dtype.str, wide, np.ascontiguousarray(a.view(np.uint8).reshape(-1, wide).T).tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(out, protocol=5))


def unpack(data: bytes) -> list[np.ndarray]:
    out = []
    for kind, wide, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(wide, -1).T).ravel().view(kind))
    return out


def gaps(of: bytes) -> np.ndarray:
    """Which byte values part words."""
    out = np.zeros(256, bool)
    out[list(of)] = True
    return out


def words_of(data: np.ndarray, off: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of all words of all texts (ASCII letters lower-cased), and each word's text."""
    word = ~gap[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = word[edge]
    ends[edge - 1] = word[edge - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(starts):
        return np.zeros(0, U64), starts, stops, starts
    first = starts[0]
    room = np.diff(np.append(starts, len(data)))
    place = np.arange(first, len(data)) - np.repeat(starts, room)
    value = _powers(_BYTE_BASE, int(room.max()) + 1)[place] * (_LOWER[data[first:]].astype(U64) + U64(1))
    value[~word[first:]] = 0
    return mix64(np.add.reduceat(value, starts - first)), starts, stops, np.searchsorted(off, starts, "right") - 1


def chunk_ids() -> Iterator[int]:
    """Numbers that no other task of the job gives."""
    task = TaskContext.get()
    yield from range(task.partitionId() << 32, (task.partitionId() + 1) << 32)


def cells(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    chunk, level, shard, data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(level, pa.int32()), pa.array(shard, pa.int32()), pa.array(data, pa.binary())], names=["chunk", "level", "shard", "data"])


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[tuple[int, int, int, bytes]]]]:
    """The cells of each value of ``key``, in rows sorted by it."""
    last, held = None, []
    for b in batches:
        at = b.schema.get_field_index(key)
        for i in range(b.num_rows):
            row = tuple(b.column(j)[i].as_py() for j in range(4))
            if held and row[at] != last:
                yield last, held
                held = []
            last = row[at]
            held.append(row)
    if held:
        yield last, held


def n_shards(chunks: DataFrame, n_words: int) -> int:
    return max(parts(chunks.sparkSession), -(-n_words // SHARD_WORDS))


def by_chunk(tables: list[DataFrame], n_chunks: int, solve: Callable, schema: str = CELL) -> DataFrame:
    """``solve`` over the cells of each chunk: its words, then answers by level and shard. A single table has whole chunks already."""
    rows = tables[0].select("chunk", "level", "shard", "data")
    if len(tables) > 1:
        for t in tables[1:]:
            rows = rows.unionByName(t.select("chunk", "level", "shard", "data"))
        rows = rows.repartition(max(parts(rows.sparkSession), n_chunks // CHUNKS_IN_PART), "chunk").sortWithinPartitions("chunk", "level", "shard")
    return rows.mapInArrow(solve, schema)


def by_shard(requests: DataFrame, shards: int, solve: Callable, schema: str = CELL) -> DataFrame:
    """``solve`` over the requests of each shard."""
    return requests.repartition(shards, "shard").sortWithinPartitions("shard", "chunk").mapInArrow(solve, schema)


def dealt(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs, with the places of its items in their order."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for at in np.split(order, cuts):
        if len(at):
            yield int(shard[at[0]]), at


def indexed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and the place of each value among them; places take 32 bits, and no more than three arrays of 64 are held at once."""
    order = np.argsort(values)
    values = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    found = values[new]
    del values
    rank = np.cumsum(new, dtype=np.uint32)
    rank -= np.uint32(1)
    at = np.empty(len(rank), np.uint32)
    at[order] = rank
    return found, at


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts, at)


def totals(chunks: DataFrame) -> tuple[int, int]:
    """Number of chunks and of words in a table of chunks with a column ``n_words``."""
    return tuple(int(x or 0) for x in chunks.agg(F.count("*"), F.sum("n_words")).first())
