"""Odd rows of records, labels and files: VARIANT periods, indexes against brute force, compensation layouts, the one-pass check."""

import random

from pyspark.sql import functions as F

from finlattice.functions import expr
from finlattice.operators import cells, facts, quarters, records
from finlattice.plans import catalog
from finlattice.sources import readers


def test_period_variants(spark):
    texts = [
        '{"ticker": "A", "values": {"a": 1, "b": 1.5e3, "c": null, "d": "7", "e": true, "f": [1], "g": {}, "h": {"value": "9", "ref": 3, "x": {"y": [1]}}, "i": {"value": 2, "source_item": "s", "ref": "A", "is_calculated": "no"}}}',
        '{"ticker": 5, "period_end": "soon", "duration_months": 3.5, "values": {"a": 2}}', '{"ticker": "B"}', '{"values": 3}', '{"values": {}}', "not json", "", None, "[]",
    ]
    got = readers.period_variants(spark.createDataFrame([(i, t, "f") for i, t in enumerate(texts)], "id int, record string, field2 string")).collect()
    first = {r.field: (r.kind, r.value, r.source_item, r.ref, r.is_calculated, r.more) for r in got if r.id == 0}
    assert first == {
        "a": ("number", 1.0, None, None, None, None), "b": ("number", 1500.0, None, None, None, None), "c": ("null", None, None, None, None, None), "d": ("text", None, None, None, None, None), "e": ("other", None, None, None, None, None),
        "f": ("other", None, None, None, None, None), "g": ("object", None, None, None, None, None), "h": ("object", None, None, None, None, '{"x":{"y":[1]}}'), "i": ("object", 2.0, "s", "A", None, None),
    }
    (other,) = [r for r in got if r.id != 0]
    assert (other.id, other.value, other.period_end, other.field2) == (1, 2.0, None, "f")


def test_label_hits_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["Cash", "and", "bank", "balances", "at", "A", "Total assets", "tax", "%", "été", "(1,234)"]
    lines = [(k, i, "| " + " ".join(rng.choices(words, k=rng.randint(0, 6)))) for k in ("f", "g") for i in range(150)] + [("f", 900, ""), ("h", 1, None)]
    labels = [(k, x) for k in ("f", "g", "h", None) for x in ("Cash and", "A", "", "bank balances at", "TAX", "tal ass", "nowhere here", "ÉTÉ", "| C", "cash and cash and")]
    got = records.label_hits(spark.createDataFrame(labels, "file string, label string"), spark.createDataFrame(lines, "file string, line_no int, line string"), "file")
    want = {(k, x, i) for k, x in labels for f, i, line in lines if k == f and line is not None and x.lower() in line.lower()}
    rows = [(r.file, r.label, r.line_no) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_presence_equals_search(spark):
    rng = random.Random(4)
    text = " ".join(rng.choice([f"{rng.randint(0, 10**7):,}", str(rng.randint(0, 10**6)), f"{rng.random() * 100:.2f}%", f"{rng.random() * 9:.1f}", "1,2,3..4%%", "x9y", "9" * 300]) for _ in range(300))
    values = [float(rng.randint(0, 1500)) for _ in range(300)] + [round(rng.random() * 100, 2) for _ in range(200)] + [0.5, 123456.789, 1e15, -7.25]
    rows = spark.createDataFrame([("f", v) for v in values], "file string, value double")
    forms = {r.value: set(r.p) for r in rows.select("value", records.printed_forms(F.col("value"), True).alias("p")).collect()}
    assert max(len(x) for p in forms.values() for x in p) <= records.LONGEST_FORM
    got = {r.value: r.presence for r in records.value_presence(rows, spark.createDataFrame([("f", text)], "file string, text string"), ["file"], True).collect()}
    assert got == {v: "found" if any(p in text for p in forms[v]) else "missing" for v in values}


def test_compensation_layouts(spark):
    def facts_of(*texts, year=2024):
        frame = spark.createDataFrame([(str(i), year, t) for i, t in enumerate(texts)], "file string, year int, text string")
        return sorted(((r.file, r.scope, r.role, r.year, r.persons, r.base_salary, r.bonus, r.retirement, r.total) for r in records.compensation_roles(frame, ["file"]).collect()), key=str)

    two = "| | CEO 2024 | CEO 2023 | Non-Executive Directors |\n|---|---|---|---|\n| Basic salary | 1,000 | 900 | - |\n| Bonus | (5) | | 7 |\n| Provident fund | 10 | 9 | |\n| Gratuity | 1 | | |\n| Total | 1,011 | 909 | 7 |\n| Number of persons | 1 | 1 | 4 |"
    assert facts_of(two) == [("0", "unconsolidated", "chief_executive", 2023, 1.0, 900.0, None, 9.0, 909.0), ("0", "unconsolidated", "chief_executive", 2024, 1.0, 1000.0, -5.0, 11.0, 1011.0), ("0", "unconsolidated", "non_executive_directors", 2024, 4.0, None, 7.0, None, 7.0)]
    assert facts_of("no table", "", "| a | b |\n|---|---|\n| x | 1 |", None) == []
    scoped = "# Consolidated\n| | Executives |\n|---|---|\n| Total | 5 |\n# Unconsolidated\n| | Executives |\n|---|---|\n| Total | 6 |"
    assert [(s, t) for _, s, *_, t in facts_of(scoped)] == [("consolidated", 5.0), ("unconsolidated", 6.0)]


def test_one_pass_equals_the_parts(spark):
    head = "UNIT_TYPE: thousands\n| Source Item | Canonical | Ref | 2024 | 2023 |\n|---|---|---|---|---|\n"
    texts = {
        "ok": head + "| a | x | A | 1,000 | 2,000 |\n| b | y | B | 500 | 100 |\n| t | total | C=A+B | 1,500 | 2,100 |", "bad": head + "| a | x | A | 1,000 | 2,000 |\n| b | y | B | 500 | 100 |\n| t | total | C=A+B | 9,500 | 2,100 |",
        "thin": head + "".join(f"| a | x{i} | | 5,000 | |\n" for i in range(12)), "both": head + "".join(f"| a | x{i} | A | 5,000 | |\n" for i in range(12)) + "| t | total | C=A+B | 1 | |", "error": "PAGE_ERROR: none", "empty": "", "plain": "no table",
        "short": "| Canonical |\n|---|\n| a |", "auth": head + "| a | share_capital_authorized | A | 1,000 | 1 |\n| t | total | C=A | 1,000 | 5,000 |",
    }
    sources = {"ok": "1,000 and 2000 500 1 500 2100", "bad": "5", "thin": "5,000,000", "both": None, "auth": "1,003", "error": "1,000"}
    files = spark.createDataFrame([(f, t, sources.get(f)) for f, t in texts.items()], "file string, text string, source string")
    parsed = cells.parse_cells(files.drop("source")).withColumn("value", cells.qc_number(F.col("raw")))
    numbers = files.select("file", F.explode(cells.printed_numbers(F.col("source"))).alias("number"))
    want = cells.file_status(files, cells.qc_formulas(parsed), cells.column_structure(parsed), cells.match_source(parsed.select("file", "value"), numbers), numbers)
    want = cells.extraction_status(want, want).select("file", "n_formulas", "n_failed", "source", "status", "qc_status")
    got = cells.check_files(files)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.status for r in got.collect()} == {"pass", "fail", "column_issue", "fail_and_column_issue", "manifest_error"}
    assert cells.check_files(files.limit(0)).count() == 0
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_published_units(spark):
    rows = [("full_rupees", "x", 5.0), ("Rupees", "x", 0.005), ("millions", "x", 5000.0), (None, "x", 5.0), ("rupees", "eps_basic", 5.0), ("rupees", "dividend_per_share", 5.0)]
    frame = spark.createDataFrame(rows, "unit string, field string, want double")
    assert all(r.want == r.got for r in frame.withColumn("got", 5.0 * facts.flat_factor(F.col("unit"), F.col("field"))).collect())


def test_periods_given_twice_and_off_the_calendar(spark):
    schema = "ticker string, section string, period_end string, months int, field string, value double, source_file string"
    rows = [("A", "c", "2024-02-29", 9, "f", 90.0, "a"), ("A", "c", "2024-02-29", 9, "f", 95.0, "0"), ("A", "c", "2023-12-31", 6, "f", 50.0, "a"), ("A", "c", "2023-09-30", 3, "f", 20.0, "a"), ("A", "c", "2023-11-30", 6, "f", 44.0, "a"), ("B", "c", "2024-02-29", 9, "f", 9.0, "a"), ("B", "c", "2024-02-29", 3, "f", 3.0, "a"), ("B", "c", "2023-12-31", 6, "f", 5.0, "a")]
    frame = spark.createDataFrame(rows, schema).withColumn("period_end", F.to_date("period_end"))
    got = {(r.ticker, r.quarter, str(r.period_end), r.method, r.value) for r in quarters.derive_quarters(frame).collect()}
    assert got == {("A", "Q1", "2023-09-30", "direct_3M", 20.0), ("A", "Q2", "2023-12-31", "6M-Q1", 30.0), ("A", "Q2", "2023-11-30", "6M-Q1", 24.0), ("A", "Q3", "2024-02-29", "9M-6M", 40.0), ("B", "Q3", "2024-02-29", "direct_3M", 3.0)}


def test_small_source_numbers_count(spark):
    head = "| Source Item | Canonical | Ref | 2024 |\n|---|---|---|---|\n"
    files = [("near", head + "| a | x | A | 1,002 |", "998"), ("thousand", head + "| a | x | A | 950,000 |", "about 950"), ("other", head + "| a | x | A | 5,000 |", "7"), ("none", head + "| a | x | A | 5,000 |", "0")]
    got = cells.check_files(spark.createDataFrame(files, "file string, text string, source string"))
    assert {r.file: r.source for r in got.collect()} == {"near": "pass", "thousand": "warn", "other": "warn", "none": "skip"}


def test_tables_are_parsed_once(spark):
    """No expression of the parsers is copied into a filter, another projection or a lambda, where it would be computed for each line."""
    files = spark.createDataFrame([("f", "UNIT_TYPE: x\n| Source Item | **Canonical** | Ref | 2024 |\n|---|---|---|---|\n| a\u3000| x | A | (1,000) |\n|| y || 7- |")], "file string, text string")
    got = cells.parse_cells(files).withColumn("value", cells.qc_number(F.col("raw")))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1
    assert [(r.source_item, r.canonical, r.ref, r.value) for r in got.collect()] == [("a", "x", "A", -1000.0), ("", "y", "", -7.0)]


def test_presence_broadcasts_nothing(spark):
    """Sizes that are estimated before the parts of printed numbers are counted are too small to broadcast by."""
    for name, of in (("value_presence", "/root/testdata/sf0.001"), ("presence_by_manifest", "/root/testdata/sf0.001")):
        assert "Broadcast" not in catalog.queries()[name](spark, of)._jdf.queryExecution().executedPlan().toString()


def test_label_hits_of_many_labels_equal_brute_force(spark):
    rng = random.Random(5)
    lines = [(k, i, "| " + " ".join(rng.choices(("Cash", "and", "bank", "A", "tax", "%", "été"), k=rng.randint(0, 6)))) for k in ("f", "g") for i in range(60)]
    labels = [(k, x) for k, n in (("f", 8), ("g", 3)) for x in ("Cash and", "A", "nowhere here", "", "bank", "TAX", "tax bank", "ÉTÉ")[:n]]
    got = records.label_hits(spark.createDataFrame(labels, "file string, label string"), spark.createDataFrame(lines, "file string, line_no int, line string"), "file", few=4)
    rows = [(r.file, r.label, r.line_no) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {(k, x, i) for k, x in labels for f, i, line in lines if k == f and x.lower() in line.lower()}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert sum("LogicalRDD" in x and "line_no" in x for x in plan.split("\n")) == 1


def test_tables_are_flattened_in_their_row(spark):
    text = "# One\n\n| Item | **2024** | 2023 |\n|---|---|---|\n| a | 1 | (2) |\n## Two\n| b | 3 | - |\n\ntext\n| Item | 2022 |\n\n|:--|\n| c | 4% | 9 |\n| d |"
    got = records.flatten_tables(spark.createDataFrame([("f", text), ("g", None), ("h", "")], "file string, text string"), ["file"])
    assert sorted((r.line_no, r.section, r.line_item, r.col_no, r.column, r.value) for r in got.collect()) == [(4, "One", "a", 0, "2024", 1.0), (4, "One", "a", 1, "2023", -2.0), (6, "Two", "b", 0, "2024", 3.0), (12, "Two", "c", 0, "2022", 4.0)]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_headers_are_cut_once(spark):
    """A header without its remark is made once, not for every pattern that looks at it."""
    heads = ["9M Sep 2024 (Audited)", "31 Feb 2024", "30 Jun 2024", "June 30, 2024 (x)", "Note", None, ""]
    got = spark.createDataFrame([(h,) for h in heads], "h string").select("h", expr.once(p=expr.period_header(F.col("h")))).select("h", "p.*")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(h#") == 1
    assert [(str(r.period_end), r.months) for r in got.collect()] == [("2024-09-30", 9), ("None", None), ("2024-06-30", None), ("2024-06-30", None), ("None", None), ("None", None), ("None", None)]


def test_formulas_in_the_row_of_their_file(spark):
    head = "UNIT_TYPE: thousands\n| Source Item | Canonical | Ref | 2024 | 2023 |\n|---|---|---|---|---|\n"
    texts = {
        "two": head + "| t | total | Z=A-(B+C) | 400 | 9 |\n| a | x | A | (1,000) | 2,000- |\n| b | y | B | **$ 5 00** | — |\n| a | z | A | 1 000 | |\n| u | sum | Y = A+B+C+D | 1,5 | 0 |", "auth": head + "| a | share_capital_authorized | A | 1,000 | 1 |\n| t | total | C=A | 1,000 | 5,000 |",
        "zero": head + "| a | x | A | 0 | - |\n| t | total | C=A | 0 | 7 |\n| t | total | C=A", "none": "no table", "error": "PAGE_ERROR: x\n" + head + "| a | x | A | 1 | 1 |\n| t | total | C=A | 1 | 5 |", "narrow": "| Source Item | Canonical | Ref |\n| a | x | C=A |",
    }
    files = spark.createDataFrame([*texts.items(), ("null", None)], "file string, text string")
    want = cells.qc_formulas(cells.parse_cells(files).withColumn("value", cells.qc_number(F.col("raw"))))
    got = cells.table_formulas(files)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.file for r in got.collect()} == {"two", "zero"}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_number_parser_is_compiled(spark):
    """Java interprets methods of over 8000 bytes, however often they run."""
    frame = spark.range(10).select(F.concat(F.lit("("), "id", F.lit(")")).alias("raw")).select(cells.qc_number(F.col("raw")))
    made = frame._jdf.queryExecution().debug().codegenToSeq()
    assert made.size() > 0 and all(made.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(made.size()))
