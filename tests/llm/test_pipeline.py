"""Each stage of the pipeline against a plain version of it."""

import hashlib

import corpus_pipeline as cp
from test_ngram_join import brute

from finlattice.llm.secrets import find_secrets
from finlattice.llm.sentencepiece_codec import DEFAULT_MODEL, Codec, read_model

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    kept = cp.identify_language(spark, docs, SF)
    assert kept.columns == list(cp.COLUMNS)
    got = {r.doc_id: r for r in kept.collect()}
    assert got.keys() == {d for d, r in rows.items() if r.text and any(c.isalpha() for c in r.text)}

    alone = cp.drop_near_duplicates(spark, kept, SF)
    pairs = [(d, r.text) for d, r in got.items()]
    want = {d for d, _, c in brute(pairs, 5, 4, 5) if d == c}
    got = {r.doc_id: r.text for r in alone.collect()}
    assert got.keys() == want

    clean = cp.hide_secrets(spark, alone, SF)
    masked = {r.doc_id: r for r in clean.collect()}
    assert masked.keys() == want
    for d, r in masked.items():
        assert (r.text == got[d]) == (not find_secrets(got[d])[1]) and not find_secrets(r.text)[0] and r.n_chars == len(r.text)

    mixed = cp.mix(spark, clean, SF)
    assert mixed.columns == list(cp.COLUMNS)
    assert {r.doc_id for r in mixed.collect()} <= want
    words = lambda f: f.selectExpr("sum(size(filter(split(text, '[ \\t-\\r]+'), x -> x <> ''))) n").first().n
    assert abs(words(mixed) - words(clean)) < 0.1 * words(clean)

    codec = Codec(read_model(DEFAULT_MODEL))
    for r in cp.encode(spark, clean, SF).collect():
        assert r.round_trip and codec.decode(r.piece_ids) == masked[r.doc_id].text


def test_run_agrees_with_itself(spark):
    digest = lambda: hashlib.sha256(repr(sorted(map(str, cp.run(spark, "/root/testdata/sf0.001").collect()))).encode()).hexdigest()
    assert digest() == digest()


def test_null_and_repeated_ids(spark):
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(12))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    row = lambda d, t, s="a": (d, t, "en", s, len(t))

    rows = [row(4, text(1)), row(4, text(1)), row(4, text(2)), row(2, text(2) + " more"), row(None, text(3)), row(None, text(3)), row(None, text(3) + " end"), row(None, text(4)), row(7, text(4)), row(9, "--"), row(9, " "), row(9, " ")]
    got = cp.drop_near_duplicates(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None) == sorted([(4, text(1)), (2, text(2) + " more"), (7, text(4)), (9, "--"), (9, " "), (9, " ")])
    assert [r.text in (text(3), text(3) + " end") for r in got if r.doc_id is None] == [True]

    rows = [row(None, text(i)) for i in range(30)] + [row(5, text(40))] * 6 + [row(5, text(i), "b") for i in range(50, 60)] + [row(None, text(60), None)] * 3
    docs = spark.createDataFrame(rows, schema)
    want = {}
    for r in cp.mixing.mix_sources(docs).collect():
        want[r.source] = r.target
    got = cp.mix(spark, docs, SF).collect()
    for source, target in want.items():
        assert abs(12 * sum(r.source == source for r in got) - target) <= 12 + 1e-6, source
    assert any(r.doc_id is None and r.source == "a" for r in got)


def test_all_stages_with_many_equal_rows_clashing_columns_and_none(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, label long, sid long, h long"
    words = [f"word{i}" for i in range(200)]
    one, near = " ".join(words), " ".join([*words[:199], "other"])
    row = lambda d, t, s: (d, t, "en", s, len(t or ""), 1, 2, 3)
    rows = [row(None, one, "a")] * 20_000 + [row(3, near, "a"), row(4, None, "b"), row(5, "password=hunter22 and some other words here", "b"), row(6, "1234 5678", None)]
    spark.createDataFrame(rows, schema).repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    got = cp.run(spark, str(tmp_path)).collect()
    assert got and all(r.round_trip for r in got) and {r.doc_id for r in got} <= {3, 5}
    empty = tmp_path / "none"
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    assert cp.run(spark, str(empty)).count() == 0
