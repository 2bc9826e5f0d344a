"""Readers, sinks and streaming ingestion on small files."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from finlattice.operators import cells, facts, records
from finlattice.sources import readers, sinks
from finlattice.streaming.ingest import ingest, ingested, progress


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text if isinstance(text, str) else json.dumps(text))
        return str(path)

    return write


def test_pages(spark, put, tmp_path):
    put("corpus/ABC/2023/annual_2023/page_001.md", "first\nsecond")
    put("corpus/ABC/2023/annual_2023/page_012.md", "")
    put("corpus/ABC/2023/annual_2023/cover.md", "no page")
    put("corpus/page_003.md", "no folders")
    got = [tuple(r) for r in readers.read_pages(spark, f"{tmp_path}/corpus").collect()]
    assert got == [("ABC", 2023, "annual_2023", 1, "ABC/2023/annual_2023/page_001.md", "first\nsecond")]  # empty files aren't read


def test_extractions(spark, put, tmp_path):
    put("x/ABC_annual_2023_consolidated.md", "UNIT_TYPE: thousands\n| Source Item | Canonical | Ref | 12M Dec 2023 |\n|---|---|---|---|\n| Sales | revenue | A | (1,200) |")
    put("x/DEF_quarterly_2023-09-30_unconsolidated.md", "PAGE_ERROR: unreadable")
    put("x/readme.md", "other")
    files = readers.read_extractions(spark, f"{tmp_path}/x")
    assert {tuple(r)[1:5] for r in files.collect()} == {("ABC", "annual", "2023", "consolidated"), ("DEF", "quarterly", "2023-09-30", "unconsolidated")}
    rows = cells.parse_cells(files).withColumn("v", cells.qc_number(F.col("raw"))).collect()
    assert [(r.file, r.canonical, r.v) for r in rows] == [("ABC_annual_2023_consolidated", "revenue", -1200.0)]
    assert [r.file for r in cells.page_errors(files).collect()] == ["DEF_quarterly_2023-09-30_unconsolidated"]


def test_companies(spark, put):
    path = put("c.json", [{"Symbol": "abc", "Company Name": "A", "Industry": "Commercial Banks", "fiscal_period": "12-31"}, {"Symbol": "Def", "Company Name": None, "Industry": "Cement"}, {"Symbol": None}])
    assert {tuple(r) for r in readers.read_companies(spark, path).collect()} == {("ABC", "A", "Commercial Banks", 12, "BANK"), ("DEF", None, "Cement", 6, "CORPORATE")}


def test_periods(spark, put):
    one = {"ticker": "ABC", "consolidation": "c", "period_end": "2023-06-30", "duration": "12M", "duration_months": 12, "unit_type": "thousands", "source_file": "f", "filing_date": "2023-09-01"}
    path = put("p.json", {"periods": [{**one, "values": {"revenue": 5.5, "profit": {"value": -2, "source_item": "Profit"}, "none": None}}]})
    got = {r.field: (r.value, r.source_item, r.period_end, r.months) for r in readers.read_periods(spark, path).collect()}
    assert got["revenue"] == (5.5, None, date(2023, 6, 30), 12) and got["profit"][:2] == (-2.0, "Profit") and got["none"][0] is None


def test_lines_rules_prices_and_manifest(spark, put):
    path = put("a.jsonl", '{"k": 1, "t": "x"}\n\nnot json\n{"k": 2}\n')
    assert {tuple(r) for r in readers.read_jsonl(spark, path, "k long, t string").collect()} == {(1, "x"), (2, None)}
    rules = put("r.json", [{"ticker": "A", "reason": "why", "periods": ["p1", "p2"]}, {"ticker": "B", "period": "p3"}, {"reason": "no ticker"}])
    assert {(r.ticker, r.reason, r.period) for r in readers.read_rules(spark, rules).collect()} == {("A", "why", "p1"), ("A", "why", "p2"), ("B", None, "p3")}
    nested_rules = put("n.json", {"allowlist": [{"ticker": "A", "period": "annual_2023", "consolidation": "c"}, {"ticker": "B", "periods": ["quarterly_2024-03-31", "2024-06-30", "soon"]}]})
    assert {(r.ticker, r.section, r.period_end) for r in readers.read_rules(spark, nested_rules).collect()} == {("A", "c", date(2023, 12, 31)), ("B", None, date(2024, 3, 31)), ("B", None, date(2024, 6, 30)), ("B", None, None)}
    excluded = put("x.json", {"exclude": [{"file": "a.md"}, {"file": "a.md"}, {"reason": "no file"}]})
    assert [r.file for r in readers.read_exclusions(spark, excluded).collect()] == ["a.md"]
    results = put("c.json", {"files": [{"file": "a", "status": "pass"}, {"file": "b", "status": "fail", "formulas": 0}, {"file": "c", "status": "fail", "formulas": 3}, {"file": "d"}]})
    assert dict(map(tuple, readers.read_qc_status(spark, results).collect())) == {"a": "pass", "b": "no_formulas", "c": "fail", "d": "no_formulas"}
    shares = put("s.json", '{"symbol": "a", "shares": 12}\n{"symbol": "b"}\n{"symbol": "c", "shares": 0}\n')
    assert [tuple(r) for r in readers.read_shares(spark, shares).collect()] == [("A", 12)]
    prices = put("q.json", '{"symbol": "A", "date": "2024-01-02", "closing_price": 3.5}\n{"symbol": "A", "date": "2024-01-03", "closing_price": null}\n')
    assert [tuple(r) for r in readers.read_prices(spark, prices).collect()] == [("A", date(2024, 1, 2), 3.5)]
    nested = spark.createDataFrame([(json.dumps({"A": {"2023": {"c": {"pl": [3, 4], "bs": [5]}}}}),)], "value string")
    assert {tuple(r) for r in readers.statement_pages(nested).collect()} == {("A", "2023", "c", "pl", 3), ("A", "2023", "c", "pl", 4), ("A", "2023", "c", "bs", 5)}


def test_sinks(spark, tmp_path):
    row = {c: None for c in facts.COLUMNS} | {"ticker": "A", "statement_type": "pl", "value": 1.5, "source_pages": [2, 3]}
    schema = ", ".join(f"{c} {'array<int>' if c == 'source_pages' else 'double' if c == 'value' else 'string'}" for c in facts.COLUMNS)
    sinks.publish_facts(spark.createDataFrame([tuple(row.values())], schema), f"{tmp_path}/facts")
    back = spark.read.parquet(f"{tmp_path}/facts").collect()
    assert [(r.ticker, r.statement_type, r.value, r.source_pages) for r in back] == [("A", "pl", 1.5, "[2,3]")]
    docs = spark.createDataFrame([("abc", "i", "annual", "2023", "2023", ["t"], "7", "x.jpg", "", "y" * 50_001), (None, None, None, None, None, None, "x", None, None, None)], "ticker string, industry string, filing_type string, filing_period string, filing_year string, section_tags array<string>, pg string, jpg_path string, summary string, text string")
    got = {r.ticker: r for r in sinks.document_rows(docs).collect()}
    assert got["ABC"].text == "y" * 50_000 + sinks.MARKER and got["ABC"].section_tags == '["t"]' and got["ABC"].pg == 7 and got[None].pg is None


def test_ingest_once_for_each_key(spark, tmp_path):
    schema, source, target = "k long, v string", f"{tmp_path}/in", f"{tmp_path}/out"
    bad = lambda df: df.withColumn("error", F.when(F.col("v") == "bad", "is bad"))
    run = lambda: ingest(spark, source, schema, target, f"{tmp_path}/cp", ["k"], ["v"], bad)
    save = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    save([(1, "a"), (1, "b"), (2, "bad"), (3, None)])
    run()
    assert {tuple(r) for r in ingested(spark, target, schema).collect()} == {(1, "a"), (3, None)}
    save([(1, "later"), (2, "good"), (4, "d")])
    run()
    run()
    assert sorted(tuple(r) for r in ingested(spark, target, schema).select("k", "v").collect()) == [(1, "a"), (2, "good"), (3, None), (4, "d")]
    assert [(r.k, r.error) for r in ingested(spark, target, schema, "failed").collect()] == [(2, "is bad")]
    assert dict(map(tuple, progress(spark, target, schema).collect())) == {"done": 4, "failed": 1, "skipped": 1}


def test_presence_without_source_and_null_values(spark):
    rows = spark.createDataFrame([("f", 1234567.0, "x"), ("f", None, "x"), ("g", 5.0, "x"), ("f", 450.0, "x"), ("f", 12.5, "x"), ("f", 98_765.0, "x"), ("f", 7.25, "x")], "file string, value double, text string")
    sources = spark.createDataFrame([("f", "sold 1,234 in thousands in 2020, 7.2%")], "file string, text string")
    got = {(r.file, r.value, r.presence, r.text) for r in records.value_presence(rows, sources, ["file"], multiyear=True).collect()}
    assert got == {("f", 1234567.0, "found", "x"), ("f", None, "missing", "x"), ("g", 5.0, "no_source", "x"), ("f", 450.0, "missing", "x"), ("f", 12.5, "missing", "x"), ("f", 98_765.0, "missing", "x"), ("f", 7.25, "found", "x")}


def test_label_match_edges(spark):
    rows = spark.createDataFrame([("f", 1, "**Cash**", "cash_and_equivalents", -1234.0), ("f", 2, "Cash", "cash_and_equivalents", 22.0), ("f", 3, "Reserves", "Reserves", None), ("f", 4, "Other", "other", 1.0), ("g", 1, "Cash", "receivables", 1.0), ("f", 5, None, "inventory", 1.0), ("f", 6, "", "inventory", 1.0)], "file string, row_no long, source_item string, canonical string, value double")
    pages = spark.createDataFrame([("f", 1, "Composition %\n| Reserves | 2 | 9,999,999 |"), ("f", 2, "Rupees in '000\n| Cash in hand | 5 | 7,000 |\n| **cash** | 22 | (1,234) | 500 |\nReserves 5,000\n| Reserves | | - |"), ("g", 1, None)], "file string, page long, text string")
    got = {(r.file, r.row_no, r.plain, r.status) for r in records.qc_label_match(rows, pages).collect()}
    assert got == {("f", 1, True, "matched"), ("f", 2, True, "mismatched"), ("f", 3, False, "matched"), ("g", 1, True, "no_source"), ("f", 5, True, "not_found"), ("f", 6, True, "not_found")}
