"""Checks over several filings or records at once: agreement of filings, missing totals, reference letters, reporting regimes, triage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import fiscal_year, months_into, once

FIGURE = ("ticker", "section", "period_end", "months", "field")


# Agreement of filings


def cross_filing(figures: DataFrame, keys: Sequence[str] = FIGURE, value: str = "value", filing: str = "filing", step: float = 0.05, unit: float = 1000.0, unit_band: float = 0.1) -> DataFrame:
    """Every filing's figure of a period and field, with what the others say: ``group_size``, ``agreed`` and ``status``.

    A key's figures are sorted by sign and size and cut wherever one is over ``step`` larger than the one before: each run is a group
    of filings that agree. The group of most filings (ties: the one of the smallest figures) is the agreed one, ``agreed`` its smallest figure. A figure is ``agrees``,
    ``unit_error`` (of the agreed sign, and its group's smallest figure ``unit`` times the agreed one or a ``unit``-th of it, give or take ``unit_band``), ``differs``, or
    ``single`` where no other filing has the figure. Zeros agree with zeros only. Null figures are left out; several figures of one filing
    are as many. One shuffle by the key: no filing is joined with another.
    """
    v, size = F.col(value), F.abs(F.col(value))
    within = Window.partitionBy(*keys)
    order = within.orderBy(F.signum(value), size, filing)
    rows = figures.where(v.isNotNull() & ~F.isnan(v.cast("double")))
    before, sign_before = F.lag(size).over(order), F.lag(F.signum(value)).over(order)
    cut = before.isNull() | (sign_before != F.signum(value)) | (size > before * (1 + step))
    rows = rows.withColumn("_cut", cut.cast("int")).withColumn("_group", F.sum("_cut").over(order))
    group = Window.partitionBy(*keys, "_group")
    rows = rows.withColumns({"group_size": F.count("*").over(group), "_least": F.min(size).over(group), "_n": F.count("*").over(within)})
    best = F.max(F.struct("group_size", (-F.col("_least")).alias("least"), F.signum(value).alias("sign"), F.col("_group").alias("of"))).over(within)
    rows = rows.withColumn("_best", best).withColumn("agreed", F.abs(F.col("_best.least")) * F.col("_best.sign"))
    base = F.abs("agreed")
    ratio = F.when((F.signum(value) == F.col("_best.sign")) & (base > 0), F.greatest(F.col("_least") / F.nullif(base, F.lit(0.0)), base / F.nullif(F.col("_least"), F.lit(0.0))))
    status = F.when(F.col("_n") == 1, "single").when(F.col("_group") == F.col("_best.of"), "agrees").when(F.coalesce(ratio.between(unit * (1 - unit_band), unit * (1 + unit_band)), F.lit(False)), "unit_error").otherwise("differs")
    return rows.withColumn("status", status).drop("_cut", "_group", "_least", "_n", "_best")


# Plausibility of one file's rows


#: Value columns that a filing of a type should have: the fewest and the most.
EXPECTED_COLUMNS = {"annual": (2, 2), "quarterly": (2, 4)}


def per_share_issues(values: DataFrame, limit: float = 5000.0) -> DataFrame:
    """Per-share figures too large to be in rupees a share."""
    return values.where(F.lower("field").rlike("eps|per_share") & (F.abs("value") > limit))


def mapping_coverage(rows: DataFrame, keys: Sequence[str], least: float = 80.0) -> DataFrame:
    """Share of rows with a canonical name by key, in percent, and whether it is enough. ``rows``: keys, canonical (null and blank are none)."""
    named = F.coalesce(F.trim("canonical") != "", F.lit(False))
    rates = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_if(named).alias("n_mapped"))
    return rates.withColumn("coverage", 100 * F.col("n_mapped") / F.col("n_rows")).withColumn("enough", F.col("coverage") >= least)


def column_counts(cells: DataFrame, file: str = "file", expected: dict[str, tuple[int, int]] = EXPECTED_COLUMNS) -> DataFrame:
    """Files with ``n_columns`` and ``issues``: too_few or too_many columns for their type, uneven rows, headers without a date.

    ``cells``: file, filing_type, row_no, col_no, col_header, raw (null: the row is shorter), dated (whether the header is a date or a span). A type that isn't known has no bounds.
    """
    rows = cells.groupBy(file, "filing_type", "row_no").agg(F.count("raw").alias("_width"), F.count_distinct("col_no").alias("_columns"), F.count_if(~F.coalesce("dated", F.lit(False))).alias("_undated"))
    one = rows.groupBy(file, "filing_type").agg(F.max("_columns").alias("n_columns"), (F.min("_width") != F.max("_width")).alias("_uneven"), F.max("_undated").alias("_undated"))

    def bound(i: int) -> Column:
        out = F.lit(None).cast("int")
        for kind, b in expected.items():
            out = F.when(F.col("filing_type") == kind, b[i]).otherwise(out)
        return out

    kinds = (F.when(F.col("n_columns") < bound(0), "too_few"), F.when(F.col("n_columns") > bound(1), "too_many"), F.when(F.col("_uneven"), "uneven_rows"), F.when(F.col("_undated") > 0, "no_date"))
    return one.select(file, "filing_type", "n_columns", F.array_compact(F.array(*kinds)).alias("issues"))


# Missing totals


#: Linear equations of the statements: (statement, equation, [(field, sign)]); the signed sum is 0.
EQUATIONS = (
    ("cf", "net_change", [("cfo", 1.0), ("cfi", 1.0), ("cff", 1.0), ("net_change_in_cash", -1.0)]),
    ("cf", "closing", [("opening_cash", 1.0), ("net_change_in_cash", 1.0), ("closing_cash", -1.0)]),
    ("pl", "gross", [("revenue_net", 1.0), ("cost_of_goods_sold", 1.0), ("gross_profit", -1.0)]),
    ("pl", "net", [("profit_before_tax", 1.0), ("taxation", 1.0), ("net_profit", -1.0)]),
    ("bs", "assets", [("total_non_current_assets", 1.0), ("total_current_assets", 1.0), ("total_assets", -1.0)]),
    ("bs", "balance", [("total_equity", 1.0), ("total_liabilities", 1.0), ("total_assets", -1.0)]),
)
_TERMS = "array<struct<field:string,sign:double>>"


def equations(spark, rows: Sequence[tuple] = EQUATIONS) -> DataFrame:
    """A table of linear equations: stmt, equation, terms."""
    return spark.createDataFrame([(s, e, list(t)) for s, e, t in rows], f"stmt string, equation string, terms {_TERMS}")


def complete_totals(values: DataFrame, rules: DataFrame, keys: Sequence[str], tolerance: float = 0.005) -> DataFrame:
    """Values that equations of the statement fix, filled to the fixpoint, and equations that can't hold.

    ``values``: keys, stmt, field, value (of a field given twice the last by value stands; null is missing). ``rules``: see equations. An equation with one
    unknown fills it, which may leave another with one: all equations go round in the order of their names until nothing is new, inside the record's own row.
    Returns keys, stmt, field, value, ``source`` (``given``, or the equation that filled it) and ``round`` (0 for given); and a row with the equation as
    ``field``, source ``contradiction`` and what is left over as value, where all is known but the sum is off by over ``tolerance`` of its largest term.
    A record whose stmt no rule has keeps its values as they are.
    """
    known = F.map_from_entries(F.collect_list(F.struct("field", "value")))
    one = values.where("value IS NOT NULL AND field IS NOT NULL").groupBy(*keys, "stmt", "field").agg(F.max(F.col("value").cast("double")).alias("value"))
    records = one.groupBy(*keys, "stmt").agg(known.alias("given"))
    tables = rules.groupBy("stmt").agg(F.array_sort(F.collect_list(F.struct("equation", "terms"))).alias("rules"))
    rows = records.join(tables, "stmt", "left").withColumn("rules", F.coalesce("rules", F.array().cast(f"array<struct<equation:string,terms:{_TERMS}>>")))

    def get(values: Column, field: Column) -> Column:
        return F.try_element_at(values, field)

    def solve(state: Column, step: Column) -> Column:
        rule = step["rule"]
        missing = F.filter(rule["terms"], lambda t: get(state["values"], t["field"]).isNull())
        total = F.aggregate(rule["terms"], F.lit(0.0), lambda a, t: a + t["sign"] * F.coalesce(get(state["values"], t["field"]), F.lit(0.0)))
        field = missing[0]["field"]
        found = -total / missing[0]["sign"] + 0.0
        more = F.struct(
            F.map_concat(state["values"], F.map_from_arrays(F.array(field), F.array(found))).alias("values"),
            F.concat(state["fills"], F.array(F.struct(field.alias("field"), rule["equation"].alias("equation"), step["round"].alias("round")))).alias("fills"),
        )
        return F.when(F.size(missing) == 1, more).otherwise(state)

    # a round fills a field at least, so there are as many rounds as equations at most
    steps = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.size("rules"), F.lit(1))), lambda r: F.transform("rules", lambda x: F.struct(r.alias("round"), x.alias("rule")))))
    start = F.struct(F.col("given").alias("values"), F.array().cast("array<struct<field:string,equation:string,round:int>>").alias("fills"))
    rows = rows.withColumn("state", F.aggregate(steps, start, solve))

    def left_over(rule: Column) -> Column:
        v = F.transform(rule["terms"], lambda t: t["sign"] * get(F.col("state.values"), t["field"]))
        total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
        largest = F.array_max(F.transform(v, F.abs))
        return F.struct(rule["equation"].alias("field"), total.alias("value"), F.lit("contradiction").alias("source"), F.lit(None).cast("int").alias("round"), (F.abs(total) > tolerance * largest).alias("_off"))

    given = F.transform(F.map_entries("given"), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("value"), F.lit("given").alias("source"), F.lit(0).alias("round")))
    filled = F.transform("state.fills", lambda f: F.struct(f["field"].alias("field"), get(F.col("state.values"), f["field"]).alias("value"), f["equation"].alias("source"), f["round"].alias("round")))
    off = F.transform(F.filter(F.transform("rules", left_over), lambda x: F.coalesce(x["_off"], F.lit(False))), lambda x: F.struct(x["field"].alias("field"), x["value"].alias("value"), x["source"].alias("source"), x["round"].alias("round")))
    return rows.select(*keys, "stmt", F.explode(F.concat(given, filled, off)).alias("x")).select(*keys, "stmt", "x.*")


# Reference letters


def letters_number(ref: Column) -> Column:
    """A to Z as 1 to 26, AA as 27 and so on; null for anything but one to six capital letters."""
    chars = F.filter(F.split(ref, ""), lambda c: c != "")
    return F.when(ref.rlike("^[A-Z]{1,6}$"), F.aggregate(chars, F.lit(0).cast("long"), lambda a, c: a * 26 + F.ascii(c) - 64))


def number_letters(number: Column) -> Column:
    """The letters of a number from 1 on; see letters_number."""
    none = F.struct(number.cast("long").alias("n"), F.lit("").alias("text"))

    def step(s: Column, _: Column) -> Column:
        digit = F.pmod(s["n"] - 1, F.lit(26))
        more = F.struct(F.floor((s["n"] - 1) / 26).cast("long").alias("n"), F.concat(F.char(digit + 65), s["text"]).alias("text"))
        return F.when(s["n"] > 0, more).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(7)), none, step)["text"]


def ref_gaps(rows: DataFrame, keys: Sequence[str], order: Sequence[str], ref: str = "ref") -> DataFrame:
    """Places where a table's reference letters don't go on by one: keys, ref, next_ref, ``kind`` and the ``missing`` letters between.

    ``gap``: letters are missing (Z is followed by AA); ``repeat``: the same again; ``back``: an earlier one. Rows whose reference isn't one to six capital letters
    (a formula, none) are passed over. ``order`` should leave no ties.
    """
    lettered = rows.withColumn("_n", letters_number(F.col(ref))).where("_n IS NOT NULL")
    w = Window.partitionBy(*keys).orderBy(*order)
    after = lettered.withColumns({"_next": F.lead("_n").over(w), "next_ref": F.lead(ref).over(w)}).where("_next <> _n + 1")
    kind = F.when(F.col("_next") > F.col("_n"), "gap").when(F.col("_next") == F.col("_n"), "repeat").otherwise("back")
    missing = F.when(F.col("_next") > F.col("_n"), F.transform(F.sequence(F.col("_n") + 1, F.col("_next") - 1), number_letters)).otherwise(F.array().cast("array<string>"))
    return after.select(*keys, *order, F.col(ref).alias("ref"), "next_ref", kind.alias("kind"), missing.alias("missing"))


# Reporting regimes


def reporting_regimes(values: DataFrame, companies: DataFrame | None = None, fields: Sequence[str] = ("revenue_net",), fall: float = 0.10) -> DataFrame:
    """``(ticker, section, fiscal_year, votes, regime)``: whether a company's figures of a year are ``cumulative`` or ``discrete`` (each quarter for itself).

    Every field votes in every year that has a figure of 3 months and one of 6, or of 6 and 9: discrete if the longer one is under the shorter by over
    ``fall``, else cumulative; figures of 0 or less don't vote. A company has one regime, or one before a year and the other from it on: the split
    that most votes agree with (ties: no split, then the first year), so that a single odd year has no regime of its own. Without a majority it is cumulative.
    """
    month = F.lit(6)
    if companies is not None:
        values = values.join(companies.select("ticker", "fiscal_month"), "ticker", "left")
        month = F.coalesce("fiscal_month", F.lit(6))
    placed = values.where((months_into(F.col("period_end"), month) == F.col("months")) & F.col("months").isin(3, 6, 9))
    placed = placed.select("ticker", "section", fiscal_year(F.col("period_end"), month).alias("fiscal_year"), "months", "field", "value")
    wide = placed.groupBy("ticker", "section", "fiscal_year", "field").agg(*(F.max(F.when(F.col("months") == m, F.col("value"))).alias(f"m{m}") for m in (3, 6, 9)))

    def vote(short: str, long_: str) -> Column:
        return F.when(F.col("field").isin(*fields) & (F.col(short) > 0) & (F.col(long_) > 0), F.when(F.col(long_) < (1 - fall) * F.col(short), 1).otherwise(-1)).otherwise(0)

    years = wide.groupBy("ticker", "section", "fiscal_year").agg(F.sum(vote("m3", "m6") + vote("m6", "m9")).alias("votes"))
    company = Window.partitionBy("ticker", "section")
    # at a split before this year, all votes before count one way and the others the other way
    summed = years.withColumns({"_all": F.sum("votes").over(company), "_before": F.coalesce(F.sum("votes").over(company.orderBy("fiscal_year").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    worth = F.struct(F.abs(2 * F.col("_before") - F.col("_all")).alias("worth"), (-F.col("fiscal_year")).alias("first"), F.col("_before").alias("before"))
    split = summed.withColumn("_best", F.max(worth).over(company))
    later = F.col("_all") - 2 * F.col("_best.before")
    discrete = F.when(F.col("fiscal_year") >= -F.col("_best.first"), later > 0).otherwise(later < 0)
    return split.select("ticker", "section", "fiscal_year", "votes", F.when(discrete, "discrete").otherwise("cumulative").alias("regime"))


def reaccumulated(values: DataFrame, regimes: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """``values`` with the 3-, 6- and 9-month figures of discrete years added up to cumulative ones; others as they are.

    A discrete figure whose year lacks an earlier quarter, or has null there, becomes null. Twelve months are the year's own in both regimes.
    """
    month, columns = F.lit(6), values.columns
    if companies is not None:
        values = values.join(companies.select("ticker", "fiscal_month"), "ticker", "left")
        month = F.coalesce("fiscal_month", F.lit(6))
    into = months_into(F.col("period_end"), month)
    rows = values.withColumn("fiscal_year", fiscal_year(F.col("period_end"), month)).withColumn("_own", (into == F.col("months")) & F.col("months").isin(3, 6, 9))
    rows = rows.join(regimes.select("ticker", "section", "fiscal_year", "regime"), ["ticker", "section", "fiscal_year"], "left")
    w = Window.partitionBy("ticker", "section", "fiscal_year", "field", "_own").orderBy("months").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.count("value").over(w) * 3 == F.col("months")
    value = F.when((F.col("regime") == "discrete") & F.col("_own"), F.when(whole, F.sum("value").over(w))).otherwise(F.col("value"))
    return rows.withColumn("value", value).select(*columns)


# Triage


#: A decision table: (kind of failure, priority, diagnosis, action, autonomous, [(measure, from, below)]); an open end is null. The first that fits is taken.
TRIAGE = (
    ("formula", 1, "wrong page in manifest", "find the page, extract again", "partial", [("source_match", None, 50.0)]),
    ("formula", 2, "OCR corruption", "OCR the page again, extract again", "yes", [("source_match", 50.0, 90.0)]),
    ("formula", 3, "source document error", "allowlist", "partial", [("source_match", 90.0, None), ("source_also_wrong", 1.0, None)]),
    ("formula", 4, "extraction error", "extract again", "partial", [("source_match", 90.0, None)]),
    ("missing_total_assets", 1, "capital employed format", "derive", "yes", [("has_non_current", 1.0, None), ("has_current", 1.0, None)]),
    ("missing_total_assets", 2, "incomplete extraction", "check the next page", "partial", [("has_assets", 1.0, None)]),
    ("missing_total_assets", 3, "wrong page", "find the page", "no", []),
    ("equation", 1, "capital employed format", "skip list", "partial", [("off_percent", 50.0, None), ("capital_employed", 1.0, None)]),
    ("equation", 2, "wrong column", "extract again", "partial", [("off_percent", 50.0, None)]),
    ("equation", 3, "source document error", "allowlist", "yes", [("off_percent", 10.0, 50.0), ("source_match", 90.0, None)]),
    ("equation", 4, "extraction error", "extract again", "yes", [("off_percent", 10.0, 50.0)]),
    ("equation", 5, "rounding", "pass or allowlist", "yes", [("off_percent", None, 10.0)]),
    ("unit", 1, "mixed units", "human review", "no", []),
)
RULES = "kind string, priority int, diagnosis string, action string, autonomous string, tests array<struct<measure:string,low:double,high:double>>"


def triage_rules(spark, rows: Sequence[tuple] = TRIAGE) -> DataFrame:
    return spark.createDataFrame([(*r[:5], list(r[5])) for r in rows], RULES)


def triage(failures: DataFrame, measures: DataFrame, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``failures`` (keys, kind) with the diagnosis, action and autonomy of the first rule of their kind all of whose tests hold; null where none does.

    ``measures``: keys, measure, value. A test holds if low <= value < high; a missing or null measure fails it, and a rule without tests always fits. Of several
    values of a measure any may hold. A failure meets its key's measures and its kind's rules as lists in its own row, so that each measure is moved once.
    """
    told = measures.where("value IS NOT NULL").select(*keys, F.struct("measure", F.col("value").cast("double").alias("value")).alias("m")).groupBy(*keys).agg(F.collect_set("m").alias("_told"))
    tables = rules.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("priority", "diagnosis", "action", "autonomous", "tests"))).alias("_rules"))

    def holds(t: Column) -> Column:
        above = lambda v: t["low"].isNull() | (t["low"] <= v)
        below = lambda v: t["high"].isNull() | (v < t["high"])
        return F.exists(F.coalesce("_told", F.array().cast("array<struct<measure:string,value:double>>")), lambda m: (m["measure"] == t["measure"]) & above(m["value"]) & below(m["value"]))

    # a rule is looked for where all lists are; no list of measures is broadcast by a size that was estimated before it was made
    rows = failures.join(told.hint("merge"), list(keys), "left").join(tables, "kind", "left")
    found = rows.select(*failures.columns, once(_rule=F.get(F.filter("_rules", lambda r: F.forall(r["tests"], holds)), F.lit(0))))
    return found.select(*failures.columns, *(F.col("_rule")[c].alias(c) for c in ("priority", "diagnosis", "action", "autonomous")))
