"""Stand-alone quarters from cumulative periods, and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import fiscal_year, months_into

SLOTS = ("d1", "d2", "d3", "d4", "c6", "c9", "c12")
#: Cumulative periods that end off the quarters' months, by how many months of the year they end after; and quarters that do.
ORPHANS, STRAYS = ("o4", "o5", "o7", "o8"), ("x4", "x5", "x7", "x8")
KEYS = ("ticker", "section", "fiscal_year")


def _minus(base: Column, *subs: Column) -> Column:
    """Absent base: absent. Null base, or a subtrahend that is present with null: null. An absent subtrahend counts as 0."""
    value = base["value"]
    for s in subs:
        value = F.when(s.isNotNull() & s["value"].isNull(), None).otherwise(value - F.coalesce(s["value"], F.lit(0.0)))
    return F.when(base.isNotNull(), F.struct(base["source_file"].alias("source_file"), base["source_item"].alias("source_item"), value.alias("value"), base["end"].alias("end")))


def derive_quarters(periods: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """Quarters Q1 to Q4 of every (ticker, section, fiscal year).

    ``periods``: one row for each field of a period: ticker, section, period_end, months (3, 6, 9, 12), field,
    value, and optionally source_file and source_item; figures in one unit. ``companies``: ticker,
    fiscal_month (default 6). Returns ticker, section, fiscal_year, quarter, period_end, method, source,
    source_item, field, value.

    The method is chosen by the periods that exist, then applied to the base period's fields. Years
    without a 12-month period keep direct quarters and what 9- and 6-month periods give. A 6- or 9-month period that ends in another
    month of the second or third quarter gives that quarter at its own end, from the regular periods before it, unless a 3-month period ends there too. Of a
    period that is given twice the one of the last source_file (then the largest value) stands. All
    periods of a fiscal year meet in one shuffle; the pivot by field reuses its partitioning.
    """
    for name in ("source_file", "source_item"):
        if name not in periods.columns:
            periods = periods.withColumn(name, F.lit(None).cast("string"))
    month = F.lit(6)
    if companies is not None:
        periods = periods.join(companies.select("ticker", "fiscal_month"), "ticker", "left")
        month = F.coalesce("fiscal_month", F.lit(6))
    into = months_into(F.col("period_end"), month)
    slot = F.when((F.col("months") == 3) & (into % 3 == 0), F.concat(F.lit("d"), (into / 3).cast("int"))).when((F.col("months") == into) & F.col("months").isin(6, 9, 12), F.concat(F.lit("c"), F.col("months")))
    off = ((F.col("months") == 6) & into.isin(4, 5)) | ((F.col("months") == 9) & into.isin(7, 8))
    slot = F.coalesce(slot, F.when(off, F.concat(F.lit("o"), into)).when((F.col("months") == 3) & into.isin(4, 5, 7, 8), F.concat(F.lit("x"), into)))
    rows = periods.select("ticker", "section", fiscal_year(F.col("period_end"), month).alias("fiscal_year"), "period_end", "months", into.alias("into"), slot.alias("slot"), "field", F.struct("source_file", "source_item", "value", F.col("period_end").alias("end")).alias("v"))
    odd = rows.where("months = 3 AND into % 3 <> 0").select(*KEYS, F.concat(F.lit("Q"), ((F.col("into") + 2) / 3).cast("int")).alias("quarter"), "period_end", F.lit("direct_3M").alias("method"), F.col("v.source_file").alias("source"), F.col("v.source_item").alias("source_item"), "field", F.col("v.value").alias("value"))
    year = Window.partitionBy(*KEYS)
    flagged = rows.where("slot IS NOT NULL").select("*", *(F.max(F.col("slot") == s).over(year).alias(f"has_{s}") for s in (*SLOTS, *ORPHANS, *STRAYS)), F.max(F.last_day(F.add_months("period_end", 12 - F.col("into")))).over(year).alias("year_end"))
    has = {s: F.col(f"has_{s}") for s in (*SLOTS, *ORPHANS, *STRAYS)}
    wide = flagged.groupBy(*KEYS, "field").agg(*(F.max(F.when(F.col("slot") == s, F.col("v"))).alias(s) for s in (*SLOTS, *ORPHANS)), *(F.first(f"has_{s}").alias(f"has_{s}") for s in has), F.first("year_end").alias("year_end"))
    d1, d2, d3, d4, c6, c9, c12 = (F.col(s) for s in SLOTS)
    q2 = [(has["d2"], "direct_3M", d2), (has["c6"] & has["d1"], "6M-Q1", _minus(c6, d1)), (has["c12"] & has["c9"] & has["d1"] & has["d3"], "9M-Q1-Q3", _minus(c9, d1, d3))]
    wide = wide.withColumns({"m2": _first(q2, 1), "v2": _first(q2, 2)})
    # without a 12-month period, 9M-Q1-Q2 takes direct quarters; a derived Q2 then has a 6-month period, which goes first
    q3 = [(has["d3"], "direct_3M", d3), (has["c9"] & has["c6"], "9M-6M", _minus(c9, c6)), (has["c9"] & has["d1"] & F.col("m2").isNotNull(), "9M-Q1-Q2", _minus(c9, d1, F.col("v2")))]
    wide = wide.withColumns({"m3": _first(q3, 1), "v3": _first(q3, 2)})
    q4 = [
        (has["d4"], "direct_3M", d4),
        (has["c12"] & has["c9"], "12M-9M", _minus(c12, c9)),
        (has["c12"] & has["d1"] & F.col("m2").isNotNull() & F.col("m3").isNotNull(), "12M-Q1-Q2-Q3", _minus(c12, d1, F.col("v2"), F.col("v3"))),
        (has["c12"] & has["c6"] & F.col("m3").isNotNull(), "12M-6M-Q3", _minus(c12, c6, F.col("v3"))),
    ]
    quarters = [(F.when(has["d1"], "direct_3M"), d1), (F.col("m2"), F.col("v2")), (F.col("m3"), F.col("v3")), (_first(q4, 1), _first(q4, 2))]
    cells = [F.struct(F.lit(f"Q{i}").alias("quarter"), F.last_day(F.add_months("year_end", 3 * i - 12)).alias("period_end"), m.alias("method"), v.alias("v")) for i, (m, v) in enumerate(quarters, 1)]
    for o, x in zip(ORPHANS, STRAYS, strict=True):
        own, alone = F.col(o), has[o] & ~F.coalesce(has[x], F.lit(False))
        ladder = [(alone & has["d1"], "6M-Q1", _minus(own, d1))] if o < "o6" else [(alone & has["c6"], "9M-6M", _minus(own, c6)), (alone & has["d1"] & has["d2"], "9M-Q1-Q2", _minus(own, d1, d2))]
        cells.append(F.struct(F.lit("Q2" if o < "o6" else "Q3").alias("quarter"), own["end"].alias("period_end"), _first(ladder, 1).alias("method"), _first(ladder, 2).alias("v")))
    cells = F.array(*cells)
    long = wide.select(*KEYS, "field", F.explode(F.filter(cells, lambda c: c["method"].isNotNull() & c["v"].isNotNull())).alias("q"))
    source = F.when(F.col("q.method") == "direct_3M", F.col("q.v.source_file")).otherwise(F.concat(F.lit("derived from "), F.col("q.v.source_file")))
    out = long.select(*KEYS, "q.quarter", "q.period_end", "q.method", source.alias("source"), F.col("q.v.source_item").alias("source_item"), "field", F.col("q.v.value").alias("value"))
    return out.unionByName(odd)


def _first(ladder: list[tuple], i: int) -> Column:
    out = F.when(ladder[0][0], ladder[0][i])
    for rung in ladder[1:]:
        out = out.when(rung[0], rung[i])
    return out


def qc_derived(quarters: DataFrame, income_field: Column | str = "revenue_net", stmt: str = "pl") -> DataFrame:
    """Issues of derived (not direct) rows: negative income (pl), or activities far from the net change (cf)."""
    derived = quarters.where("method <> 'direct_3M'")
    keys = ["ticker", "section", "fiscal_year", "quarter", "method"]
    if stmt == "pl":
        field = F.lit(income_field) if isinstance(income_field, str) else income_field
        return derived.where((F.col("field") == field) & (F.col("value") < 0)).select(*keys, "field", F.lit("negative_income").alias("type"), F.lit(0.0).alias("expected"), F.col("value").alias("actual"))
    pivot = derived.where(F.col("field").isin("cfo", "cfi", "cff", "net_cash_change")).groupBy(*keys).agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in ("cfo", "cfi", "cff", "net_cash_change")))
    total = F.col("cfo") + F.col("cfi") + F.col("cff")
    gap = F.abs(total - F.col("net_cash_change"))
    return pivot.where((F.col("net_cash_change") != 0) & (gap > 1000) & (gap > 0.20 * F.abs("net_cash_change"))).select(*keys, F.lit("net_cash_change").alias("field"), F.lit("activities_differ").alias("type"), total.alias("expected"), F.col("net_cash_change").alias("actual"))


def qc_year_arithmetic(quarters: DataFrame, periods: DataFrame, companies: DataFrame | None = None, tolerance: float = 0.05, fields: tuple[str, ...] = ("revenue_net", "gross_profit", "net_profit"), zero_floor: float = 0.0, allowlist: DataFrame | None = None) -> DataFrame:
    """Years whose four quarters don't sum to the 12-month figure: off by more than ``tolerance`` of it.

    An annual 0 with a sum over ``zero_floor`` is infinitely off. ``allowlist``: ticker, fiscal_year, section.
    """
    sums = quarters.where(F.col("field").isin(*fields) & F.col("value").isNotNull()).groupBy("ticker", "section", "fiscal_year", "field").agg(F.count("*").alias("n"), F.sum("value").alias("actual")).where("n = 4")
    year = periods.where("months = 12 AND value IS NOT NULL")
    month = F.lit(6)
    if companies is not None:
        year = year.join(companies.select("ticker", "fiscal_month"), "ticker", "left")
        month = F.coalesce("fiscal_month", F.lit(6))
    year = year.where(months_into(F.col("period_end"), month) == 12).select("ticker", "section", fiscal_year(F.col("period_end"), month).alias("fiscal_year"), "field", F.col("value").alias("expected"))
    both = sums.join(year, ["ticker", "section", "fiscal_year", "field"])
    off = F.when(F.col("expected") != 0, F.abs(F.col("actual") - F.col("expected")) / F.abs("expected")).when(F.abs("actual") > zero_floor, float("inf")).otherwise(0.0)
    found = both.withColumn("off", off).where(F.col("off") > tolerance).drop("n")
    return found if allowlist is None else found.join(allowlist.select("ticker", "fiscal_year", "section"), ["ticker", "fiscal_year", "section"], "left_anti")


def in_scope(rows: DataFrame, ticker: str | None = None, year: int | None = None, annual_only: bool = False, limit: int | None = None) -> DataFrame:
    """Rows of one ticker, of one year of period ends, of 12-month periods only, or only the first so many of them, in the order of all their columns."""
    if ticker is not None:
        rows = rows.where(F.col("ticker") == ticker)
    if year is not None:
        rows = rows.where(F.year("period_end") == year)
    if annual_only:
        rows = rows.where("months = 12")
    return rows if limit is None else rows.orderBy(*rows.columns).limit(limit)
