"""SentencePiece encoding, decoding and counting with an Aho-Corasick automaton and a single-pass Viterbi.

The pieces of a vocabulary file are the patterns of an automaton. One pass over a text follows its output links:
at each position all pieces that end there relax the best score. Ties go to the piece that starts first, as
unigram tokenizers relax in order of starts and replace on a better score only. A character that no piece of its
own covers is unknown: it scores ten below the smallest piece and gives its UTF-8 bytes as byte pieces. Scores are
summed as doubles; the vocabulary's are whole numbers, so sums are exact at any length.

If no piece holds a word mark after another character (checked when the vocabulary is loaded), best paths never
cross the start of a word. Words are then encoded each for itself, and repeated words once.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "\u2581"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of a vocabulary file that may be sent to every task, and words whose pieces a task keeps.
MAX_MODEL_BYTES, KEPT_WORDS, KEPT_LENGTH = 32 << 20, 400_000, 48
#: Characters up to which a unit's scores are held at once.
SHORT = 10_000
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNKNOWN_PENALTY = 10.0


def read_model(path: str) -> bytes:
    """The vocabulary file's bytes, read once on the driver; its size is checked before it is sent to tasks."""
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has over {MAX_MODEL_BYTES} bytes")
    return data


class _Kept(dict):
    """What was made of each word before; a full table starts anew, and long words aren't kept."""

    def __init__(self, make: Callable[[str], object]) -> None:
        self.make = make

    def __missing__(self, word: str) -> object:
        found = self.make(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = found
        return found


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = sp.unk_id()
        self.special = {i for i in range(n) if sp.is_control(i)}
        usable = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.score = {i: float(sp.get_score(i)) for i in usable}
        self.unknown_score = min(self.score.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in usable:
            self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), self.score[i], i))
        self.automaton.make_automaton()
        self.longest = max(len(self.pieces[i]) for i in usable)
        self.single = frozenset(self.pieces[i] for i in usable if len(self.pieces[i]) == 1)
        self.by_word = not any(MARK in self.pieces[i].lstrip(MARK) for i in usable)
        self.kept = _Kept(lambda word: array("i", self.encode_unit(word if word[0] == MARK else MARK + word)).tobytes())
        self.read = _Kept(lambda ids: self.decode(np.frombuffer(ids, np.int32).tolist(), first=False))
        #: Count and score as the two parts of one number, which add up at once (both are whole numbers).
        self.best = _Kept(lambda word: complex(*self.count_unit(word if word[0] == MARK else MARK + word)))

    def units(self, text: str) -> list[str]:
        """The normalised text in parts that are encoded each for itself; where all begin with one mark, it is left out."""
        if not text:
            return []
        if self.by_word and MARK not in text and "" not in (words := text.split(" ")):
            return words
        text = MARK + text.replace(" ", MARK)
        return _WORD.findall(text) if self.by_word else [text]

    def viterbi(self, unit: str) -> tuple[Sequence[int], Sequence[int]]:
        """For every end of the best path: start of its last piece, and that piece's id (unknown: -1). Scores are kept for as long as a piece may reach back."""
        n, unknown, ring = len(unit), self.unknown_score, self.longest + 1
        best = [0.0] * ring
        start, last = array("q", [-1]) * (n + 1), array("i", [-1]) * (n + 1)
        done, single = 0, 0  # ends up to ``done`` are final; the last end that a piece of one character reaches

        def close(to: int) -> None:
            """Ends that no piece of one character reaches may be reached by an unknown one."""
            nonlocal done
            while done < to:
                done += 1
                s = best[(done - 1) % ring] + unknown
                if start[done] < 0 or (done != single and s > best[done % ring]):
                    best[done % ring], start[done], last[done] = s, done - 1, -1

        for end, (length, score, i) in self.automaton.iter(unit):
            end += 1
            if end > done + 1:
                close(end - 1)
            s = best[(end - length) % ring] + score
            if start[end] < 0 or s > best[end % ring]:
                best[end % ring], start[end], last[end] = s, end - length, i
            if length == 1:
                single = end
        close(n)
        return start, last

    def count_unit(self, unit: str) -> tuple[int, float]:
        """Pieces and score of the best path: the same relaxations with the count carried in place of the path, over a ring of a piece's length."""
        n = len(unit)
        if self.plain(unit):  # the place before the first is the last one, by Python's indices
            best, count = [-math.inf] * n + [0.0], [0] * (n + 1)
            for end, (length, score, _) in self.automaton.iter(unit):
                s = best[end - length] + score
                if s > best[end]:
                    best[end], count[end] = s, count[end - length] + 1
            return count[n - 1], best[n - 1]
        unknown, ring = self.unknown_score, self.longest + 1
        best, count = [0.0] * ring, [0] * ring
        done, single, met = 0, 0, 0  # ``met``: the last end that a piece reaches

        def close(to: int) -> None:
            nonlocal done
            while done < to:
                done += 1
                s = best[(done - 1) % ring] + unknown
                if met != done or (done != single and s > best[done % ring]):
                    best[done % ring], count[done % ring] = s, count[(done - 1) % ring] + len(unit[done - 1].encode())

        for end, (length, score, _) in self.automaton.iter(unit):
            end += 1
            if end > done + 1:
                close(end - 1)
            s = best[(end - length) % ring] + score
            if met != end or s > best[end % ring]:
                best[end % ring], count[end % ring], met = s, count[(end - length) % ring] + 1, end
            if length == 1:
                single = end
        close(n)
        return count[n % ring], best[n % ring]

    def plain(self, unit: str) -> bool:
        """Whether every character is a piece, so that no path holds an unknown one; and the unit is short."""
        return len(unit) <= SHORT and self.single.issuperset(unit)

    def encode_unit(self, unit: str) -> list[int]:
        out, at = [], len(unit)
        if self.plain(unit):
            best, last = [-math.inf] * at + [0.0], [0] * at
            for end, (length, score, i) in self.automaton.iter(unit):
                s = best[end - length] + score
                if s > best[end]:
                    best[end], last[end] = s, i
            while at > 0:
                out.append(i := last[at - 1])
                at -= len(self.pieces[i])
            out.reverse()
            return out
        start, last = self.viterbi(unit)
        while at > 0:
            i = last[at]
            out.extend([i] if i >= 0 else [self.bytes.get(b, self.unknown) for b in reversed(unit[at - 1].encode())])
            at = start[at]
        out.reverse()
        return out

    def encode_parts(self, text: str) -> list[bytes]:
        """The ids of each unit, as bytes of 32-bit integers."""
        return list(map(self.kept.__getitem__, self.units(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.encode_parts(text)), np.int32).tolist()

    def count(self, text: str) -> tuple[int, float]:
        """Pieces and best score of the whole text; no pieces are made."""
        total = sum(map(self.best.__getitem__, self.units(text)), 0j)
        return int(total.real), total.imag

    def decode_parts(self, parts: list[bytes]) -> str:
        """The text of the ids of whole units."""
        text = "".join(map(self.read.__getitem__, parts))
        return text[1:] if text[:1] == " " else text

    def decode(self, ids: list[int], first: bool = True) -> str:
        """The text of ids: marks become spaces, byte pieces UTF-8, the ``first`` mark goes; control ids give nothing."""
        if self.byte_of.keys().isdisjoint(ids) and self.special.isdisjoint(ids):
            text = "".join(map(self.pieces.__getitem__, ids)).replace(MARK, " ")
        else:
            parts: list[bytes] = []
            for i in ids:
                if i in self.byte_of:
                    parts.append(bytes((self.byte_of[i],)))
                elif i not in self.special:
                    parts.append(self.pieces[i].replace(MARK, " ").encode())
            text = b"".join(parts).decode("utf-8", "replace")
        return text[1:] if first and text[:1] == " " else text


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    """One codec for each vocabulary in a worker."""
    return Codec(model)


def _pieces(batches: Iterator[pa.RecordBatch], model: object, name: str) -> Iterator[pa.RecordBatch]:
    c = codec(model.value)
    for b in batches:
        at = b.schema.get_field_index("text")
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            flat, ends, same = [], [0], []
            for text in part.column(at).to_pylist():
                ids = c.encode_parts(text or "")
                flat += ids
                same.append(c.decode_parts(ids) == (text or ""))
                ends.append(ends[-1] + sum(map(len, ids)) // 4)
            col = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(flat), np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns, col, pa.array(np.diff(ends).astype(np.int64)), pa.array(same)], names=[*b.schema.names, name, "n_pieces", "round_trip"]).drop_columns(["text"])


def sentencepiece_encode(docs: DataFrame, model_path: str = DEFAULT_MODEL, name: str = "piece_ids") -> DataFrame:
    """``(doc_id, piece_ids, n_pieces, round_trip)`` of every row of ``docs`` (``doc_id``, ``text``).

    Null and empty texts have no pieces. ``round_trip`` tells whether decoding gives the text back; only
    texts that hold the word mark U+2581 itself don't, as the vocabulary writes spaces with it.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: _pieces(b, model, name), f"doc_id long, {name} array<int>, n_pieces long, round_trip boolean")


def _texts(batches: Iterator[pa.RecordBatch], model: object) -> Iterator[pa.RecordBatch]:
    c = codec(model.value)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])


def sentencepiece_decode(encoded: DataFrame, model_path: str = DEFAULT_MODEL, name: str = "piece_ids") -> DataFrame:
    """``(doc_id, text)`` of rows with piece ids; null and empty lists give empty texts."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))
    return encoded.select(F.col("doc_id").cast("long"), name).mapInArrow(lambda b: _texts(b, model), "doc_id long, text string")


def _counts(batches: Iterator[pa.RecordBatch], model: object) -> Iterator[pa.RecordBatch]:
    c = codec(model.value)
    for b in batches:
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            found = [c.count(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "n_tokens", "best_score"])


def count_tokens(docs: DataFrame, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """``(doc_id, n_tokens, best_score)`` of every row: the length and score of the best segmentation, without making it.

    Null and empty texts have 0 tokens and a score of 0.0.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: _counts(b, model), "doc_id long, n_tokens long, best_score double")
