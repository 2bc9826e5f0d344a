import numpy as np
import pyarrow as pa

from finlattice.llm.lang_id import SLOTS, crc_remainder, fit, identify_languages, score, spectra, train


def test_held_out_accuracy_and_independence(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = identify_languages(docs).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if crc_remainder(d) == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held if lang[r.doc_id]]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_folded_weights_equal_the_kernel_form():
    texts = [f"{w} the of and {w[::-1]} number {i}" for i, w in enumerate(["alpha", "beta", "gamma", "delta", "omega"] * 8)] + [f"der die und {w} nicht {i}" for i, w in enumerate(["haus", "baum", "weg", "tag"] * 10)]
    langs = ["en"] * 40 + ["de"] * 40
    blocks = [np.concatenate(x) for x in zip(*spectra(pa.array(texts)))]
    model = fit(blocks, langs)
    found, share = score(model, pa.array(texts))
    assert found == langs and share.min() > 0.5
    sets = [{tuple(t.lower().encode()[i : i + 1]) for i in range(len(t))} for t in texts[:3]]
    assert blocks[0].shape == (80, SLOTS[0])
    assert [int(r.sum()) for r in blocks[0][:3]] == [len({c if chr(c[0]).isalpha() else (32,) for c in s}) for s in sets]


def test_odd_rows(spark):
    rows = [(i, "the house and the tree of them", "en") for i in range(40)] + [(100 + i, "das haus und der baum nicht", "de") for i in range(40)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "123 !!! 💥", None), (None, "der baum", None), (203, "the tree " * 50_000, None), (203, "the tree " * 50_000, None)]
    docs = spark.createDataFrame([(d, t, g, 0.5) for d, t, g in rows], "doc_id long, text string, lang string, score double")
    got = {(r.doc_id, r.lang_pred) for r in identify_languages(docs).collect()}
    assert {(200, "und"), (201, "und"), (202, "und"), (None, "de"), (203, "en")} <= got
    assert identify_languages(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in identify_languages(docs.where("lang IS NULL")).collect()} == {"und"}


def test_languages_of_mostly_copies_are_learned(spark):
    """Twenty languages of 20,000 rows each, of three distinct texts."""
    rows = spark.range(400_000).selectExpr("concat('l', id % 20) lang", "concat('text ', char(97 + id % 20), char(97 + id % 20), ' of form ', char(97 + id % 3)) text")
    assert set(train(rows).langs) == {f"l{i}" for i in range(20)}


def test_many_languages(spark):
    rows = spark.range(9000).selectExpr("concat('l', id % 300) lang", "concat(repeat(concat(char(97 + id % 20), char(97 + id % 15), ' '), 5), id) text")
    assert len(train(rows).langs) == 300
    assert train(rows, max_langs=7).langs == tuple(sorted(f"l{i}" for i in range(300))[:7])
