"""The codec against a plain Viterbi over whole texts and against the tokenizers library's unigram model."""

import random

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer, models

from finlattice.llm.sentencepiece_codec import DEFAULT_MODEL, MARK, Codec, count_tokens, read_model, sentencepiece_decode, sentencepiece_encode


@pytest.fixture(scope="module")
def codec():
    return Codec(read_model(DEFAULT_MODEL))


@pytest.fixture(scope="module")
def unigram():
    sp = SentencePieceProcessor(model_file=DEFAULT_MODEL)
    vocab = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]
    # ids stay; pieces that no text may give are written so that none can match
    vocab = [(p if not (sp.is_control(i) or sp.is_unknown(i)) else f"\0{i}\0", s) for i, (p, s) in enumerate(vocab)]
    return Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))


def plain(codec, text):
    """Quadratic Viterbi over the whole normalised text, relaxing by ascending start."""
    s = MARK + text.replace(" ", MARK) if text else ""
    by = {codec.pieces[i]: (v, i) for i, v in codec.score.items()}
    best, n = [None] * (len(s) + 1), len(s)
    best[0] = (0.0, 0, [])
    for a in range(n):
        score, count, ids = best[a]
        single = False
        for b in range(a + 1, min(n, a + 16) + 1):
            if s[a:b] in by:
                v, i = by[s[a:b]]
                single |= b == a + 1
                if best[b] is None or score + v > best[b][0]:
                    best[b] = (score + v, count + 1, [*ids, i])
        if not single and (best[a + 1] is None or score + codec.unknown_score > best[a + 1][0]):
            raw = s[a].encode()
            best[a + 1] = (score + codec.unknown_score, count + len(raw), [*ids, *(codec.bytes[c] for c in raw)])
    return best[n]


def samples(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rng = random.Random(1)
    alphabet = "aeinrst  ▁\n\té漢😀zq'.,<0x0A>"
    return [t[:1500] for t in texts[:60]] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)] + ["", " ", "  a", "\x00́"]


def test_codec_agrees_with_plain_viterbi_and_unigram(spark, codec, unigram):
    for text in samples(spark):
        score, count, ids = plain(codec, text)
        assert codec.encode(text) == ids, text
        assert codec.count(text) == (count, score)
        if text:
            normal = MARK + text.replace(" ", MARK)
            if "<" not in text:
                assert unigram.encode(normal, add_special_tokens=False).ids == ids, text
        assert codec.decode(ids) == text.replace(MARK, " "), text


def test_long_unbroken_text(codec):
    text = "ab" * 50_000
    ids = codec.encode(text)
    assert codec.decode(ids) == text
    assert codec.count(text)[0] == len(ids)


def test_frames(spark):
    rows = [(1, "hello world", 9), (2, None, 9), (2, None, 9), (None, "", 9), (3, "x▁y", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_pieces int")
    out = sentencepiece_encode(docs)
    got = {(r.doc_id, r.n_pieces, r.round_trip) for r in out.collect()}
    assert (2, 0, True) in got and (None, 0, True) in got and any(g[0] == 3 and not g[2] for g in got)
    assert out.count() == 5
    assert {(r.doc_id, r.text) for r in sentencepiece_decode(out).collect()} >= {(1, "hello world"), (2, ""), (3, "x y")}
    counts = {(r.doc_id, r.n_tokens) for r in count_tokens(docs).collect()}
    assert counts == {(r.doc_id, r.n_pieces) for r in out.collect()}
    assert count_tokens(docs.limit(0)).count() == 0
