"""Language identification with blended-spectrum string kernels.

A text's spectrum of order n is the set of byte n-grams of its lower-cased form, hashed to a fixed number of slots; the
kernel of two texts is the mean over n = 1..4 of ``|common| / sqrt(|one| * |other|)``. Landmark texts give a
Nyström approximation of it, on which one-versus-rest kernel ridge regressions are fitted. As the kernel
is linear in the presence vectors, the landmarks and coefficients fold into one matrix for each n, and
batches of texts are scored by matrix products of presence rows with it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces
from .shingles import slices, utf8_parts

#: Slots of the spectra of order 1, 2, 3 and 4.
SLOTS = (256, 4096, 16384, 32768)
#: Bounds of what is fitted on: training texts of a language and in all, landmarks in all (but one of each language), languages.
TRAIN_PER_LANG, MAX_TRAIN, MAX_LANDMARKS, MAX_LANGS = 300, 1200, 240, 512
#: Texts drawn of a language beyond twice those wanted: fewer than wanted come with a probability of 1e-9 or less.
SPARE = 24
#: Ridge, and the scale of margins in the soft-max.
RIDGE, SHARPNESS = 1e-3, 6.0
_ROWS = 128
_LETTER = r"\p{L}"
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[[c for c in range(128) if not chr(c).isalpha()]] = 0x20


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    weights: tuple[np.ndarray, ...]


def spectra(texts: pa.Array) -> Iterator[list[np.ndarray]]:
    """For each block of rows, presence matrices (rows x slots) of every order."""
    for i, j in slices(texts):
        for a in range(i, j, _ROWS):
            part = pc.utf8_lower(texts.slice(a, min(_ROWS, j - a)))
            data, off = utf8_parts(part)
            data = _CLEAN[data].astype(np.uint32)
            row = np.repeat(np.arange(len(part)), np.diff(off))
            out, code = [], np.zeros(len(data), np.uint32)
            for n, slots in enumerate(SLOTS, 1):
                m = len(data) - n + 1
                seen = np.zeros(len(part) * slots, bool)
                if m > 0:
                    code = code[:m] + data[n - 1 :] * _MULTIPLIERS[n - 1]
                    at = data if n == 1 else (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - slots.bit_length() + 1)
                    inside = row[:m] == row[n - 1 :]
                    seen[row[:m][inside] * slots + at[:m][inside]] = True
                out.append(seen.reshape(len(part), slots))
            yield out


def _normal(seen: np.ndarray) -> np.ndarray:
    x = seen.astype(np.float32)
    x /= np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1) * len(SLOTS)).astype(np.float32)
    return x


def fit(spectrum_rows: list[np.ndarray], langs: list[str]) -> LanguageModel:
    """Ridge regressions from presence matrices of the training texts, each language's first rows being its landmarks."""
    names = tuple(sorted(set(langs)))
    lang = np.array([names.index(x) for x in langs])
    marks = np.concatenate([np.flatnonzero(lang == c)[: max(1, MAX_LANDMARKS // len(names))] for c in range(len(names))])
    kernel = np.zeros((len(langs), len(marks)))
    for seen in spectrum_rows:
        landmarks = _normal(seen[marks]).T
        for a in range(0, len(seen), _ROWS):  # a block at a time, for the driver's memory
            kernel[a : a + _ROWS] += _normal(seen[a : a + _ROWS]) @ landmarks
    values, vectors = np.linalg.eigh(kernel[marks])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi, target = kernel @ root, np.where(lang[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = 1 / np.bincount(lang)[lang]  # all languages count alike
    gram = (phi * weight[:, None]).T @ phi + RIDGE * np.eye(phi.shape[1])
    alpha = root @ np.linalg.solve(gram, (phi * weight[:, None]).T @ target)
    return LanguageModel(names, tuple((_normal(seen[marks]).T @ alpha).astype(np.float32) for seen in spectrum_rows))


def score(model: LanguageModel, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Best language of each text, and its share of the regressions' soft-max; und and 0.0 without a letter."""
    total = [np.zeros((0, len(model.langs)))]
    for block in spectra(texts):
        total.append(sum(_normal(seen) @ w for seen, w in zip(block, model.weights, strict=True)))
    margin = np.concatenate(total).astype(float) * SHARPNESS
    share = np.exp(margin - margin.max(axis=1, keepdims=True)) if len(margin) else margin
    share /= share.sum(axis=1, keepdims=True)
    letter = pc.fill_null(pc.match_substring_regex(texts, _LETTER), False).to_numpy(zero_copy_only=False)
    best = share.argmax(axis=1) if len(share) else []
    return [model.langs[i] if ok else "und" for i, ok in zip(best, letter, strict=True)], np.where(letter, share.max(axis=1) if len(share) else 0.0, 0.0)


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = 0
        for block in spectra(b.column("text")):
            n = len(block[0])
            packed = [np.packbits(np.concatenate(r)).tobytes() for r in zip(*block, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("h").slice(at, n), b.column("lang").slice(at, n), pa.array(packed, pa.binary())], names=["h", "lang", "bits"])
            at += n


def train(labelled: DataFrame, per_lang: int = TRAIN_PER_LANG, max_langs: int = MAX_LANGS) -> LanguageModel | None:
    """Fits on at most ``per_lang`` distinct texts of every language (MAX_TRAIN in all), chosen by hash, from rows with ``text`` and non-null ``lang``.

    Of over ``max_langs`` values of ``lang`` those with most distinct texts are learned (ties: by name), which bounds the
    model sent to tasks. The texts' spectra (7 kB each, whatever the text's length) come to the driver. None if no row is labelled.
    """
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    hashed = F.xxhash64("text", F.lit(7)).alias("h")
    # shares are of distinct texts, as copies are drawn together and count once
    counts = rows.select("lang", hashed).distinct().groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    if not counts:
        return None
    per_lang = max(1, min(per_lang, MAX_TRAIN // len(counts)))
    shares = labelled.sparkSession.createDataFrame([(r.lang, min(1.0, (2.0 * per_lang + SPARE) / r.n)) for r in counts], "lang string, share double")
    drawn = rows.select("lang", "text", hashed).join(F.broadcast(shares), "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    found = drawn.drop("share").dropDuplicates(["lang", "h"]).mapInArrow(_sample, "h long, lang string, bits binary").collect()
    chosen: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r.h * 0x9E3779B97F4A7C15 & (1 << 64) - 1, r.h)):
        if len(own := chosen.setdefault(r.lang, [])) < per_lang:
            own.append(r.bits)
    flat = [(lang, bits) for lang, own in chosen.items() for bits in own]
    cuts = np.cumsum((0, *SLOTS))
    matrix = np.stack([np.unpackbits(np.frombuffer(bits, np.uint8), count=cuts[-1]) for _, bits in flat]).view(bool)
    del found, chosen
    return fit([matrix[:, a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], [lang for lang, _ in flat])


def _predict(batches: Iterator[pa.RecordBatch], model: object) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        text = b.column(b.schema.get_field_index("text"))
        langs, shares = score(model.value, text)
        rest = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in rest), pa.array(langs, pa.string()), pa.array(shares, pa.float64())], names=[*rest, "lang_pred", "score"])


def held_out() -> F.Column:
    """Whether the CRC-32 of the doc_id's text leaves 2 modulo 4; false without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs`` (``doc_id``, ``text``, ``lang``).

    Fitted on rows that aren't held out. Texts that are null or have no letter are ``und`` with a
    score of 0.0, as is every text if no row is labelled. Equal texts get equal predictions.
    """
    model = train(docs.where(~held_out()).select("text", "lang"))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda b: _predict(b, sent), "doc_id long, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; names that ``docs`` has already are replaced."""
    docs = docs.drop("lang_pred", "score")
    model = train(docs.where(~held_out()).select("text", "lang"))
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            langs, shares = score(sent.value, b.column(b.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(shares, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    schema = docs.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    return docs.mapInArrow(add, schema)


def crc_remainder(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4
