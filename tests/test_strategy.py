"""Odd rows for the checks over several filings, and what their queries don't show."""

import math
from datetime import date

import pytest

from finlattice.plans import catalog
from finlattice.operators import strategy

FIGS = "ticker string, section string, period_end string, months int, field string, filing string, value double"


def figures(spark, values, key=("A", "x", "2024-06-30", 12, "f")):
    return spark.createDataFrame([(*key, f"f{i}", v) for i, v in enumerate(values)], FIGS)


@pytest.mark.parametrize(
    "values,agreed,states",
    [
        ([100.0, 104.0, 1e5, 130.0], 100.0, ["agrees", "agrees", "unit_error", "differs"]),
        ([100.0], 100.0, ["single"]),
        ([0.0, 0.0, 5.0], 0.0, ["agrees", "agrees", "differs"]),
        ([-100.0, -101.0, 100.0, -0.1], -101.0 + 1.0, ["agrees", "agrees", "differs", "unit_error"]),
        ([7.0, 7000.0], 7.0, ["agrees", "unit_error"]),
        ([None, math.nan, 3.0], 3.0, ["single"]),
        ([100.0, 104.0, 108.0, 112.0, 300.0], 100.0, ["agrees"] * 4 + ["differs"]),
    ],
)
def test_cross_filing(spark, values, agreed, states):
    rows = sorted(strategy.cross_filing(figures(spark, values)).collect(), key=lambda r: r.filing)
    assert [r.status for r in rows] == states
    assert {r.agreed for r in rows} == {agreed}


def test_cross_filing_keys_and_empty(spark):
    both = figures(spark, [1.0, 1.0]).unionByName(figures(spark, [9.0, 9000.0, 9.0], (None, "x", "2024-06-30", 12, "f")))
    assert sorted(r.status for r in strategy.cross_filing(both).collect()) == ["agrees"] * 4 + ["unit_error"]
    assert strategy.cross_filing(figures(spark, [])).count() == 0
    plan = strategy.cross_filing(both)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def totals(spark, values, rules=strategy.EQUATIONS, stmt="cf"):
    rows = spark.createDataFrame([(1, stmt, f, v) for f, v in values], "k int, stmt string, field string, value double")
    return {(r.field, r.source): (r.value, r.round) for r in strategy.complete_totals(rows, strategy.equations(spark, rules), ("k",)).collect()}


def test_complete_totals(spark):
    chain = totals(spark, [("cfo", 10.0), ("cfi", -3.0), ("cff", -2.0), ("opening_cash", 1.0), ("other", 4.0), ("net_change_in_cash", None)])
    assert chain[("net_change_in_cash", "net_change")] == (5.0, 1) and chain[("closing_cash", "closing")] == (6.0, 2) and chain[("other", "given")] == (4.0, 0)
    assert not any(s == "contradiction" for _, s in chain)
    back = totals(spark, [("opening_cash", 1.0), ("closing_cash", 6.0), ("cfo", 10.0), ("cff", -2.0)])
    assert back[("net_change_in_cash", "closing")] == (5.0, 1) and back[("cfi", "net_change")] == (-3.0, 1)
    off = totals(spark, [("cfo", 10.0), ("cfi", -3.0), ("cff", -2.0), ("net_change_in_cash", 7.0)])
    assert off[("net_change", "contradiction")] == (-2.0, None)
    assert totals(spark, [("cfo", 10.0)]) == {("cfo", "given"): (10.0, 0)}
    assert totals(spark, [("cfo", 10.0)], stmt="none") == {("cfo", "given"): (10.0, 0)}
    # two equations of one name's order meet at total_assets; the second then tells liabilities
    bs = totals(spark, [("total_non_current_assets", 6.0), ("total_current_assets", 4.0), ("total_equity", 3.0)], stmt="bs")
    assert bs[("total_assets", "assets")] == (10.0, 1) and bs[("total_liabilities", "balance")] == (7.0, 1)
    long_chain = [("s", f"e{9 - i}", [(f"x{i}", 1.0), ("one", 1.0), (f"x{i + 1}", -1.0)]) for i in range(9)]
    found = totals(spark, [("x0", 0.0), ("one", 1.0)], long_chain, "s")
    assert found[("x9", "e1")] == (9.0, 9)
    assert totals(spark, []) == {}


def test_letters(spark):
    cases = {1: "A", 26: "Z", 27: "AA", 52: "AZ", 53: "BA", 702: "ZZ", 703: "AAA", 18278: "ZZZ", 18279: "AAAA"}
    df = spark.createDataFrame(list(cases.items()), "n long, ref string")
    assert all(r.a == r.ref and r.b == r.n for r in df.select("*", strategy.number_letters(df.n).alias("a"), strategy.letters_number(df.ref).alias("b")).collect())
    rows = [(1, "Y"), (2, None), (3, "A+B"), (4, "AB"), (5, "AB"), (6, "a"), (7, ""), (8, "C"), (9, "D")]
    got = strategy.ref_gaps(spark.createDataFrame([("f", *r) for r in rows], "file string, row int, ref string"), ("file",), ("row",)).collect()
    assert [(r.ref, r.next_ref, r.kind, r.missing) for r in sorted(got, key=lambda r: r.row)] == [("Y", "AB", "gap", ["Z", "AA"]), ("AB", "AB", "repeat", []), ("AB", "C", "back", [])]


def test_regimes(spark):
    schema = "ticker string, section string, period_end date, months int, field string, value double"

    def year(y, q, ticker="A"):
        ends = [(y - 1, 9, 30), (y - 1, 12, 31), (y, 3, 31)]
        return [(ticker, "x", date(*e), 3 * (i + 1), "revenue_net", None if v is None else float(v)) for i, (e, v) in enumerate(zip(ends, q, strict=True))]

    rows = [*year(2001, (100, 250, 400)), *year(2002, (100, 210, 300)), *year(2003, (100, 60, 50)), *year(2004, (100, 80, 40)), *year(2005, (100, None, 80)), *year(2002, (-5, -9, 0), "B")]
    values = spark.createDataFrame(rows, schema)
    regimes = strategy.reporting_regimes(values)
    assert {(r.ticker, r.fiscal_year): r.regime for r in regimes.collect()} == {("A", 2001): "cumulative", ("A", 2002): "cumulative", ("A", 2003): "discrete", ("A", 2004): "discrete", ("A", 2005): "discrete", ("B", 2002): "cumulative"}
    out = {(r.ticker, r.period_end.year + (r.period_end.month > 6), r.months): r.value for r in strategy.reaccumulated(values, regimes).collect()}
    assert [out["A", 2003, m] for m in (3, 6, 9)] == [100, 160, 210] and [out["A", 2005, m] for m in (3, 6, 9)] == [100, None, None]
    assert [out["A", 2001, m] for m in (3, 6, 9)] == [100, 250, 400] and len(out) == len(rows)
    # one odd year between others is no regime of its own
    one = spark.createDataFrame([*year(2001, (100, 250, 400)), *year(2002, (100, 60, 50)), *year(2003, (100, 260, 500)), *year(2004, (100, 260, 500))], schema)
    assert {r.regime for r in strategy.reporting_regimes(one).collect()} == {"cumulative"}
    assert strategy.reporting_regimes(values.limit(0)).count() == 0


def test_triage_rules_are_data(spark):
    failures = spark.createDataFrame([(1, "k"), (2, "k"), (3, "k"), (4, "k"), (5, None), (6, "other"), (6, "other")], "id int, kind string")
    measures = spark.createDataFrame([(1, "m", 10.0), (2, "m", 20.0), (3, "m", None), (4, "m", 20.0), (4, "w", -1.0), (1, "w", 5.0)], "id int, measure string, value double")
    rules = strategy.triage_rules(spark, [("k", 1, "both", "a", "yes", [("m", 20.0, None), ("w", None, 0.0)]), ("k", 2, "high", "b", "no", [("m", 20.0, 30.0)]), ("k", 3, "low", "c", "no", [("m", None, 20.0)])])
    got = strategy.triage(failures, measures, rules, ("id",))
    assert sorted((r.id, r.diagnosis or "") for r in got.collect()) == [(1, "low"), (2, "high"), (3, ""), (4, "both"), (5, ""), (6, ""), (6, "")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    more = rules.unionByName(strategy.triage_rules(spark, [("k", 9, "else", "d", "no", []), ("other", 1, "any", "e", "yes", [])]))
    assert sorted((r.id, r.diagnosis or "") for r in strategy.triage(failures, measures, more, ("id",)).collect()) == [(1, "low"), (2, "high"), (3, "else"), (4, "both"), (5, ""), (6, "any"), (6, "any")]


def test_triage_moves_measures_once(spark):
    failures = spark.createDataFrame([(1, "k"), (1, "k"), (2, "k"), (3, "none")], "id int, kind string")
    measures = spark.createDataFrame([(1, "m", 5.0), (1, "m", 25.0), (2, "m", None)], "id int, measure string, value double")
    got = strategy.triage(failures, measures, strategy.triage_rules(spark, [("k", 1, "high", "a", "yes", [("m", 20.0, None)]), ("k", 2, "rest", "b", "no", [])]), ("id",))
    assert sorted((r.id, r.diagnosis or "") for r in got.collect()) == [(1, "high"), (1, "high"), (2, "rest"), (3, "")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + got._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 3


def test_column_counts_deals_no_cells_by_header(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in catalog.queries()["column_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
