"""Checks on period values and facts. Each returns issues or a status; none collects anything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fields as fs
from ..functions.expr import off_by, unit_factor
from .periods import pick

GROUP = ("ticker", "section")
PERIOD = ("ticker", "section", "period_end", "months")


def wide(values: DataFrame, names: Sequence[str], keys: Sequence[str] = PERIOD) -> DataFrame:
    """Fields as columns; ``has_<field>`` tells null from absent."""
    aggs = [F.max(F.when(F.col("field") == n, F.col("value"))).alias(n) for n in names]
    return values.where(F.col("field").isin(*names)).groupBy(*keys).agg(*aggs, *(F.coalesce(F.bool_or(F.col("field") == n), F.lit(False)).alias(f"has_{n}") for n in names))


# Period checks


def missing_years(periods: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """Years between a group's first and last that have no period."""
    years = periods.select(*keys, F.year("period_end").alias("year")).distinct()
    grid = years.groupBy(*keys).agg(F.explode(F.sequence(F.min("year"), F.max("year"))).alias("year"))
    return grid.join(years, [*keys, "year"], "left_anti")


def monotonicity(values: DataFrame, names: Sequence[str] = ("revenue_net", "cost_of_goods_sold"), fiscal_month: Column | None = None) -> DataFrame:
    """Cumulative figures that fall from one duration of a fiscal year to the next; negatives are skipped.

    Periods whose month doesn't fit their duration are left out, as are later ones of a duration.
    """
    month = F.lit(12) if fiscal_month is None else fiscal_month
    into = F.pmod(F.month("period_end") - month - 1, F.lit(12)) + 1
    rows = values.where(F.col("field").isin(*names) & (into == F.col("months")))
    rows = rows.withColumn("fiscal_year", (F.year("period_end") + (F.month("period_end") > month).cast("int")).cast("int"))
    keys = ["ticker", "section", "fiscal_year", "field"]
    one = pick(rows, [*keys, "months"], "period_end", "value")
    w = Window.partitionBy(*keys).orderBy("months")
    before = one.withColumns({"previous": F.lag("value").over(w), "previous_months": F.lag("months").over(w)})
    return before.where("previous >= 0 AND value >= 0 AND value < previous").select(*keys, "period_end", "previous_months", "months", "previous", "value")


def tax_total(has: dict[str, Column], v: dict[str, Column]) -> Column:
    """The tax of a wide P&L row: its total; all parts of a two-tier form; the single figure; or the sum of parts."""

    def total(names: Sequence[str]) -> Column:
        some = F.coalesce(*(v[n] for n in names)).isNotNull()
        return F.when(some, sum((F.coalesce(v[n], F.lit(0.0)) for n in names), F.lit(0.0)))

    parts = ("taxation_current", "taxation_deferred", "taxation_prior", "taxation_minimum")
    two = has["taxation_income_tax_total"] | has["profit_before_income_taxes"]
    return F.when(has["taxation_total"], v["taxation_total"]).when(two, total(("taxation", *parts))).when(has["taxation"], v["taxation"]).otherwise(total(parts))


PL_FIELDS = (
    "revenue_net", "cost_of_goods_sold", "gross_profit", "profit_before_tax", "net_profit", "net_profit_continuing", "net_profit_discontinued",
    "taxation_total", "taxation_income_tax_total", "profit_before_income_taxes", "taxation", "taxation_current", "taxation_deferred", "taxation_prior",
    "taxation_minimum", *fs.PL_EXTRAS,
)


def pl_equations(values: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Broken P&L equations: gross = revenue + cost; net = before tax + tax; net = continuing + discontinued (+ extras that close the gap)."""
    df = wide(values, PL_FIELDS)
    v, has = {n: F.col(n) for n in PL_FIELDS}, {n: F.col(f"has_{n}") for n in PL_FIELDS}
    net, tax = v["net_profit"], tax_total(has, v)
    start = F.struct((v["net_profit_continuing"] + F.coalesce("net_profit_discontinued", F.lit(0.0))).alias("sum"))
    extras = F.array(*(v[n] for n in fs.PL_EXTRAS))
    nearer = lambda s, x: F.when(x.isNotNull() & (F.abs(net - s["sum"] - x) < F.abs(net - s["sum"])), s["sum"] + x).otherwise(s["sum"])
    continued = F.aggregate(extras, start, lambda s, x: F.struct(nearer(s, x).alias("sum")), lambda s: s["sum"])
    equations = (
        ("gross_profit", v["gross_profit"], v["revenue_net"] + v["cost_of_goods_sold"]),
        ("net_profit_tax", F.when(~has["net_profit_continuing"], net), v["profit_before_tax"] + F.coalesce(tax, F.lit(0.0))),
        ("net_profit_continuing", F.when(has["net_profit_continuing"], net), continued),
    )
    checks = F.array(*(F.struct(F.lit(n).alias("check"), a.alias("actual"), e.alias("expected")) for n, a, e in equations))
    rows = df.select(*PERIOD, F.explode(checks).alias("c")).select(*PERIOD, "c.*").where("actual IS NOT NULL AND expected IS NOT NULL")
    off = F.abs(F.col("actual") - F.col("expected")) / F.greatest(F.abs("actual"), F.abs("expected"), F.lit(1.0))
    return rows.withColumn("off", off).where(F.col("off") > tolerance).withColumn("severity", F.when(F.col("off") < 0.10, "warning").otherwise("error"))


def bs_equation(values: DataFrame, allowlist: DataFrame | None = None, parts_allowlist: DataFrame | None = None, tolerance: float = 0.05) -> DataFrame:
    """``status`` of every balance sheet: pass, fail or skip, with the check that decided.

    Allowlists: ticker, section, period_end; the second excuses the parts (equity and liabilities) only.
    """
    keys = ["ticker", "section", "period_end"]
    df = wide(values, ("total_assets", "total_equity_and_liabilities", "total_equity", "total_liabilities"), keys)
    for name, given in (("_ok", allowlist), ("_parts_ok", parts_allowlist)):
        df = df.withColumn(name, F.lit(False)) if given is None else df.join(given.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    ta, tel, parts = F.col("total_assets"), F.col("total_equity_and_liabilities"), F.col("total_equity") + F.col("total_liabilities")
    differ = lambda a, b: F.abs(a - b) > tolerance * F.abs(a)
    check = (
        F.when(F.col("_ok"), "pass:allowlisted")
        .when(ta.isNull() | (ta == 0), "skip:no_assets")
        .when(tel.isNotNull() & differ(ta, tel), "fail:assets")
        .when(tel.isNotNull() & parts.isNotNull() & ~F.col("_parts_ok") & (off_by(parts, tel, tel) > tolerance), "fail:parts")
        .when(tel.isNotNull(), "pass:total")
        .when(parts.isNotNull() & differ(ta, parts), "fail:assets_parts")
        .when(parts.isNotNull(), "pass:parts")
        .otherwise("skip:no_total")
    )
    return df.withColumn("_c", F.split(check, ":")).select(*keys, "total_assets", F.coalesce(tel, parts).alias("other_side"), F.col("_c")[0].alias("status"), F.col("_c")[1].alias("check"))


def cf_patterns(values: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Cash-flow equations under two presentations, each row with the activity and cash results and the smaller gaps.

    A: cfo + cfi + cff = net, start + net + adj = end; B: cfo + cfi + cff + adj = net, start + net = end.
    """
    names = ("cfo", "cfi", "cff", "net_cash_change", "cash_start", "cash_end", *fs.CF_RECONCILING)
    df = wide(values, names)
    adj = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in fs.CF_RECONCILING), F.lit(0.0))
    flows, net, start, end = F.col("cfo") + F.col("cfi") + F.col("cff"), F.col("net_cash_change"), F.col("cash_start"), F.col("cash_end")
    gap = lambda e, a: off_by(a, e, e)  # noqa: E731  relative to the expected figure
    df = df.withColumns({"a_flow": gap(flows, net), "a_cash": gap(start + net + adj, end), "b_flow": gap(flows + adj, net), "b_cash": gap(start + net, end)})
    ok = lambda n: F.coalesce(F.col(n) <= tolerance, F.lit(False))
    both = F.when(ok("a_flow") & ok("a_cash"), "A").when(ok("b_flow") & ok("b_cash"), "B")
    n = (ok("a_flow") | ok("b_flow")).cast("int") + (ok("a_cash") | ok("b_cash")).cast("int")
    checked = (flows + net).isNotNull().cast("int") + (start + net + end).isNotNull().cast("int")
    return df.select(*PERIOD, F.coalesce(both, F.lit("")).alias("pattern"), n.alias("n_passed"), checked.alias("n_checked"), F.least("a_flow", "b_flow").alias("flow_gap"), F.least("a_cash", "b_cash").alias("cash_gap"))


def cf_year_sums(values: DataFrame, names: Sequence[str] = ("cfo", "cfi", "cff"), tolerance: float = 0.05) -> DataFrame:
    """Annual flows off from the sum of four quarters of their year (same year, or the year before and a later month)."""
    keys = ["ticker", "section", "field"]
    one = pick(values.where(F.col("field").isin(*names) & F.col("value").isNotNull()), [*keys, "period_end", "months"], "value")
    year = one.where("months = 12").select(*keys, F.col("period_end").alias("year_end"), F.col("value").alias("actual"))
    quarter = one.where("months = 3").select(*keys, "period_end", F.col("value").alias("q"))
    same = (F.year("period_end") == F.year("year_end")) | ((F.year("period_end") == F.year("year_end") - 1) & (F.month("period_end") > F.month("year_end")))
    sums = year.join(quarter, keys).where(same).groupBy(*keys, "year_end", "actual").agg(F.count("*").alias("n"), F.sum("q").alias("expected")).where("n = 4")
    return sums.withColumn("off", off_by(F.col("actual"), F.col("expected"), F.col("expected"))).where(F.col("off") > tolerance).drop("n")


def outliers(values: DataFrame, names: Sequence[str], keys: Sequence[str] = GROUP, times: float = 100.0) -> DataFrame:
    """Values over ``times`` or under 1/``times`` of the median of their group's reference field.

    The reference field is the first of ``names`` with three values or more, zeros among them; a group is left out if fewer than three of those aren't zero. The median, of
    those, is exact. Values are brought to thousands first where ``unit_type`` is given.
    """
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("field"))
    scaled = F.abs("value") * unit_factor(F.col("unit_type"), F.col("field")) if "unit_type" in values.columns else F.abs("value")
    rows = values.where(F.col("field").isin(*names) & F.col("value").isNotNull()).select(*keys, "field", "period_end", "months", scaled.alias("size"), rank.alias("_r"))
    stats = rows.groupBy(*keys, "field", "_r").agg(F.count("*").alias("n"), F.count_if(F.col("size") != 0).alias("n_sized"), F.median(F.when(F.col("size") != 0, F.col("size"))).alias("median")).where("n >= 3")
    chosen = stats.groupBy(*keys).agg(F.min(F.struct("_r", "field", "median", "n_sized")).alias("c")).where("c.n_sized >= 3").select(*keys, "c.field", "c.median")
    ratio = F.col("size") / F.col("median")
    return rows.where("size <> 0").join(chosen, [*keys, "field"]).withColumn("ratio", ratio).where((F.col("ratio") > times) | (F.col("ratio") < 1 / times)).drop("_r")


def unit_context(files: DataFrame, group: str = "ticker") -> DataFrame:
    """Files of every declared unit, the group's majority unit (ties: by name), and which units are outliers."""
    counts = files.groupBy(group, F.coalesce("unit_type", F.lit("unknown")).alias("unit_type")).agg(F.count("*").alias("n_files"))
    w = Window.partitionBy(group).orderBy(F.desc("n_files"), "unit_type")
    return counts.withColumn("majority", F.first("unit_type").over(w)).withColumn("is_outlier", F.col("unit_type") != F.col("majority"))


def critical_fields(values: DataFrame, groups: dict[str, Sequence[str]], keys: Sequence[str] = PERIOD) -> DataFrame:
    """Periods without any field of a group, one row for each such group."""
    have = values.where("value IS NOT NULL").groupBy(*keys).agg(F.collect_set("field").alias("have"))
    lacks = F.array(*(F.when(~F.arrays_overlap("have", F.array(*map(F.lit, names))), F.lit(g)) for g, names in groups.items()))
    return have.select(*keys, F.explode(F.array_compact(lacks)).alias("missing"))


def invalid_units(periods: DataFrame) -> DataFrame:
    """Periods without unit, or with one that is none: their columns and ``type`` missing or invalid."""
    unit = F.lower(F.coalesce("unit_type", F.lit("")))
    kind = F.when(unit == "", "missing").when(~unit.isin(*fs.UNITS), "invalid")
    return periods.withColumn("type", kind).where("type IS NOT NULL")


def fiscal_months(periods: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """The month most 12-month periods of a group end in (ties: the one met first); 12 for groups without any."""
    ends = periods.select(*keys, "period_end", "months").distinct()
    counts = ends.where("months = 12").groupBy(*keys, F.month("period_end").alias("m")).agg(F.count("*").alias("n"), F.min("period_end").alias("first"))
    best = counts.groupBy(*keys).agg(F.max_by("m", F.struct("n", F.negative(F.unix_date("first")))).alias("fiscal_month"))
    return ends.select(*keys).distinct().join(best, list(keys), "left").withColumn("fiscal_month", F.coalesce("fiscal_month", F.lit(12)))


def income_field(industry: Column) -> Column:
    """The income that a company of this industry is judged by."""
    return F.when(F.col("industry").isNull(), "revenue_net").otherwise(F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in fs.INCOME_FIELDS.items() for x in pair)), industry), F.lit("revenue_net")))


def _issues(rows: DataFrame, check: str, kind: Column | str, severity: Column | str, **values: Column) -> DataFrame:
    """Rows of a check in the form all checks share."""
    of = lambda x: F.lit(x) if isinstance(x, str) else x
    wanted = {"period_end": "date", "months": "int", "field": "string", "expected": "double", "actual": "double"}
    cols = [(values.get(n, F.col(n) if n in rows.columns else F.lit(None))).cast(t).alias(n) for n, t in wanted.items()]
    return rows.select("ticker", "section", F.lit(check).alias("check"), of(kind).alias("type"), of(severity).alias("severity"), *cols)


def qc_pl(values: DataFrame) -> DataFrame:
    """All issues of P&L periods: (ticker, section, check, type, severity, period_end, months, field, expected, actual).

    ``values``: ticker, section, period_end, months, unit_type, field, value. Checks: missing years, falls of cumulative figures (by each
    group's own fiscal month), equations, units, critical fields, outliers. Figures are compared in thousands.
    """
    periods = values.select(*PERIOD, "unit_type").distinct()
    scaled = values.withColumn("value", F.col("value") * unit_factor(F.col("unit_type"), F.col("field")))
    falls = monotonicity(scaled.join(fiscal_months(values), list(GROUP)), fiscal_month=F.col("fiscal_month"))
    years = missing_years(values)
    # a field that is there without a value counts as there
    lacks = critical_fields(values.withColumn("value", F.lit(1.0)), {"missing_revenue": fs.PL_REVENUE, "missing_bottom_line": fs.PL_BOTTOM})
    far = outliers(values, fs.REFERENCE_FIELDS["pl"])
    found = (
        _issues(years, "column_completeness", "missing_year", "warning", period_end=F.make_date("year", F.lit(12), F.lit(31))),
        _issues(falls, "monotonicity", "cumulative_decrease", "error", expected=F.col("previous"), actual=F.col("value")),
        _issues(pl_equations(values), "semantic_equations", F.col("check"), F.col("severity")),
        _issues(invalid_units(periods), "unit_type", F.col("type"), "error"),
        _issues(lacks, "critical_fields", F.col("missing"), "error"),
        _issues(far, "cross_period_normalization", "1000x_outlier", "error", expected=F.col("median"), actual=F.col("size")),
    )
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def qc_bs(values: DataFrame, files: DataFrame, allowlist: DataFrame | None = None, parts_allowlist: DataFrame | None = None) -> DataFrame:
    """One row for each ticker: failures of the equation, units, critical fields and outliers, mixed units, missing years, and ``status``.

    ``values`` as for qc_pl (months is the same for all); ``files``: ticker, unit_type of each extraction file. Any failure fails; mixed units or a missing year warn.
    """
    periods = values.select(*PERIOD, "unit_type").distinct()
    equation = bs_equation(values, allowlist, parts_allowlist).where("status = 'fail'")
    both = critical_fields(values.withColumn("value", F.lit(1.0)), {"total_assets": ("total_assets",), "liabilities_equity": ("total_equity_and_liabilities", "total_equity", "total_liabilities")})
    count = lambda df, name: df.groupBy("ticker").agg(F.count("*").alias(name))
    mixed = unit_context(files).groupBy("ticker").agg((F.count("*") > 1).alias("mixed_units"))
    out = periods.groupBy("ticker").agg(F.count_distinct(*PERIOD).alias("n_periods"))
    parts = {"equation": equation, "units": invalid_units(periods), "critical": both.select("ticker", "section", "period_end").distinct(), "outliers": outliers(values, fs.REFERENCE_FIELDS["bs"]), "missing_years": missing_years(values)}
    for name, df in parts.items():
        out = out.join(count(df, name), "ticker", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    out = out.join(mixed, "ticker", "left").withColumn("mixed_units", F.coalesce("mixed_units", F.lit(False)))
    fails = sum((F.col(n) for n in ("equation", "units", "critical", "outliers")), F.lit(0)) > 0
    return out.withColumn("status", F.when(fails, "fail").when(F.col("mixed_units") | (F.col("missing_years") > 0), "warn").otherwise("pass"))


def qc_cf(values: DataFrame, cells: DataFrame, known_errors: DataFrame) -> DataFrame:
    """cf_patterns of every period with ``status`` and ``flag``; a period whose equations fail passes if its activities stand in its source file.

    ``values`` as for qc_pl with source_file; ``cells``: file, canonical, row_no, value of the extraction files; ``known_errors``: file. Each of
    cfo, cfi and cff that the period has must be within 2 of some column of the file's first row of that name. The flag is
    source_arithmetic_error for known files, else source_match_fallback.
    """
    checked = cf_patterns(values)
    files = values.groupBy(*PERIOD).agg(F.min("source_file").alias("file"))
    rows = cells.where(F.col("canonical").isin("cfo", "cfi", "cff"))
    first = rows.groupBy("file", "canonical").agg(F.min("row_no").alias("row_no"))
    printed = rows.join(first, ["file", "canonical", "row_no"]).groupBy("file", F.col("canonical").alias("field")).agg(F.collect_list("value").alias("columns"))
    flows = values.where(F.col("field").isin("cfo", "cfi", "cff") & F.col("value").isNotNull()).select(*PERIOD, "field", "value", F.col("source_file").alias("file"))
    near = F.coalesce(F.exists("columns", lambda v: F.abs(v - F.col("value")) < 2), F.lit(False))
    there = flows.join(printed, ["file", "field"], "left").groupBy(*PERIOD).agg(F.bool_and(near).alias("_there"))
    some = cells.select("file").distinct().withColumn("_read", F.lit(True))
    known = known_errors.select("file").distinct().withColumn("_known", F.lit(True))
    out = checked.join(files, list(PERIOD)).join(there, list(PERIOD), "left").join(some, "file", "left").join(known, "file", "left")
    fails = (F.col("pattern") == "") & (F.col("n_passed") < F.col("n_checked"))
    saved = fails & F.coalesce("_read", F.lit(False)) & F.coalesce("_there", F.lit(True))
    flag = F.when(saved, F.when(F.col("_known"), "source_arithmetic_error").otherwise("source_match_fallback"))
    return out.withColumns({"status": F.when(fails & ~saved, "fail").otherwise("pass"), "flag": flag}).drop("_there", "_read", "_known")


# Comparatives


def mismatch_category(a: Column, b: Column) -> Column:
    """``struct(category, confidence)`` of two figures that should agree."""
    x, y = F.abs(a), F.abs(b)
    low, high = F.least(x, y), F.greatest(x, y)
    ratio = F.when(low > 0, high / low)

    def kind(name: str, confidence: float) -> Column:
        return F.struct(F.lit(name).alias("category"), F.lit(confidence).alias("confidence"))

    flipped = F.signum(a) != F.signum(b)
    return (
        F.when(low == 0, kind("ZERO_VALUE", 0.5))
        .when((low <= 50) & (high > 10_000) & (ratio > 1000), kind("OCR_ERROR", 0.95))
        .when((ratio > 500) & (ratio < 2000), kind("UNIT_MISMATCH", 0.85))
        .when(ratio > 10_000, kind("OCR_ERROR", 0.80))
        .when(ratio > 2000, kind("WRONG_PAGE", 0.70))
        .when(flipped & (ratio > 10), kind("SIGN_ERROR", 0.75))
        .when(flipped, kind("RESTATEMENT", 0.30))
        .when(ratio > 2, kind("EXTRACTION_ERROR", 0.60))
        .otherwise(kind("RESTATEMENT", 0.40))
    )


def compare_comparatives(comparatives: DataFrame, standalone: DataFrame, keys: Sequence[str], critical: Sequence[str] = fs.CRITICAL) -> DataFrame:
    """Comparative figures that differ from the stand-alone figure of their period, with category and confidence.

    Both: the keys, field, unit_type, value. A figure in the same unit stands before one in the other unit, which is
    rescaled by 1000. Up to 10 % is normal; critical fields count over 15 %, others, as restatement, over 25 %.
    """
    s = standalone.select(*keys, "field", F.col("unit_type").alias("s_unit"), F.col("value").alias("s_value"))
    both = comparatives.join(s, [*keys, "field"])
    scale = F.when(F.col("unit_type") == F.col("s_unit"), 1.0).when(F.col("s_unit") == "thousands", 1000.0).otherwise(0.001)
    both = both.withColumn("_same", F.col("unit_type") == F.col("s_unit")).withColumn("standalone", F.col("s_value") * scale)
    id_ = [c for c in comparatives.columns if c != "value"]
    one = pick(both, id_, F.desc("_same"), "s_unit", "s_value")
    off = off_by(F.col("value"), F.col("standalone"), F.col("standalone"))
    is_critical = F.col("field").isin(*critical)
    found = one.withColumn("off", off).where((F.col("off") > 0.10) & ((is_critical & (F.col("off") > 0.15)) | (~is_critical & (F.col("off") > 0.25))))
    c = F.when(is_critical, mismatch_category(F.col("value"), F.col("standalone"))).otherwise(F.struct(F.lit("RESTATEMENT").alias("category"), F.lit(0.40).alias("confidence")))
    return found.withColumn("_c", c).select(*id_, "value", "standalone", "off", F.col("_c.category").alias("category"), F.col("_c.confidence").alias("confidence"))


#: Categories that call for work, by priority (fixed).
ACTIONABLE = ("OCR_ERROR", "UNIT_MISMATCH", "WRONG_PAGE", "SIGN_ERROR")


def single_currency(columns: DataFrame, file: str = "file", header: str = "col_header") -> DataFrame:
    """Columns of files in one currency, without those in US dollars; a file with both kinds goes as a whole."""
    usd = F.coalesce(F.upper(F.col(header)).rlike(r"US\$|USD"), F.lit(False))
    kinds = columns.groupBy(file).agg((F.bool_or(usd) & F.bool_or(~usd)).alias("_both"))
    return columns.join(kinds, file).where(~F.col("_both") & ~usd).drop("_both")


def comparative_report(found: DataFrame, keys: Sequence[str], examples: int = 5) -> DataFrame:
    """Files with mismatches that call for work, most pressing first: counts, primary category, and the ``examples`` largest.

    ``found``: see compare_comparatives; ``keys`` name a file's column. Order: category, number of such mismatches, keys.
    """
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ACTIONABLE)), F.col("category")), F.lit(0)), F.lit(99))
    actionable = F.col("category").isin(*ACTIONABLE)
    worst = F.slice(F.sort_array(F.collect_list(F.when(actionable, F.struct(F.col("off").alias("off"), "field"))), asc=False), 1, examples)
    out = found.groupBy(*keys).agg(F.count("*").alias("n_mismatched"), F.count_if(actionable).alias("n_actionable"), F.min_by("category", rank).alias("primary_category"), F.min(rank).alias("_rank"), worst.alias("worst"))
    return out.where("n_actionable > 0").orderBy("_rank", F.desc("n_actionable"), *keys).drop("_rank")


def top_counts(rows: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values of a column; ties by value."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


# The gate before publishing


def coverage(facts: DataFrame, expected: Sequence[str], least_periods: int = 4) -> tuple[DataFrame, DataFrame]:
    """Tickers with few periods, and periods that lack all or all but one of the expected fields."""
    few = facts.groupBy("ticker").agg(F.count_distinct("period_end", "section").alias("n_periods")).where(F.col("n_periods") < least_periods)
    have = facts.groupBy("ticker", "period_end", "section").agg(F.collect_set(F.when(F.col("canonical_field").isin(*expected), F.col("canonical_field"))).alias("have"))
    gaps = have.withColumn("missing", F.array_sort(F.array_except(F.array(*map(F.lit, expected)), "have"))).where(F.size("missing") >= len(expected) - 1)
    return few, gaps.drop("have")


def gate_facts(facts: DataFrame, row_id: str, stmt: str, keys: Sequence[str] = ("ticker", "period_end", "period_duration", "section", "canonical_field", "original_name")) -> DataFrame:
    """All issues of facts before publishing: (row_id, type, field); none means they may go. Rows are read and shuffled once."""
    w = Window.partitionBy(*keys).orderBy(row_id)
    kinds = [F.when(F.col(n).isNull(), F.struct(F.lit("missing_field").alias("type"), F.lit(n).alias("field"))) for n in fs.REQUIRED]
    plain = (F.coalesce("qc_flag", F.lit("")) == "") & F.col("value").isNotNull()
    limit = F.when(F.col("unit_type").isin("rupees", "full_rupees"), 1e13).otherwise(1e10)
    negative = (F.col("value") < 0) & (F.abs("value") > 1) & F.col("canonical_field").isin(*fs.MUST_BE_POSITIVE[stmt] or [""])
    for name, test in (("too_large", plain & (F.abs("value") > limit)), ("unexpected_negative", plain & negative), ("duplicate", F.col("_n") > 1)):
        kinds.append(F.when(test, F.struct(F.lit(name).alias("type"), F.col("canonical_field").alias("field"))))
    used = {*keys, row_id, *fs.REQUIRED, "qc_flag", "unit_type", "canonical_field"}
    rows = facts.select(*sorted(used)).withColumn("_n", F.row_number().over(w))
    return rows.select(row_id, F.inline(F.array_compact(F.array(*kinds))))


def gate_report(facts: DataFrame, row_id: str, stmt: str) -> DataFrame:
    """The gate with coverage: (subject, type, field). The subject is a row, a ticker with few periods, or a period that lacks expected fields."""
    few, gaps = coverage(facts.where("ticker IS NOT NULL"), fs.EXPECTED[stmt])
    rows = gate_facts(facts, row_id, stmt).select(F.col(row_id).cast("string").alias("subject"), "type", "field")
    few = few.select(F.col("ticker").cast("string").alias("subject"), F.lit("few_periods").alias("type"), F.col("n_periods").cast("string").alias("field"))
    gaps = gaps.select(F.concat_ws("|", "ticker", F.col("period_end").cast("string"), "section").alias("subject"), F.lit("missing_fields").alias("type"), F.array_join("missing", ",").alias("field"))
    return rows.unionByName(few).unionByName(gaps)


def summarise_issues(issues: DataFrame, group: str = "ticker") -> DataFrame:
    """Counts by group and type, by type, and in total, in one pass; ``level`` tells them apart."""
    out = issues.groupingSets([[F.col(group), F.col("type")], [F.col("type")], []], F.col(group), F.col("type")).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))
    return out
