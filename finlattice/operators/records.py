"""Compensation and multi-year tables: flattening, cleaning, and presence of values in their source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import number, once, trimmed
from .periods import latest_report

# Fixed values of the cleaning.
LARGE_ITEMS = ("total assets", "total liabilities", "revenue", "sales", "deposits", "equity", "capital")
ANALYSIS = r"horizontal analysis|vertical analysis"
PER_SHARE = r"per share|eps\b|earning.?per|dividend.?per|book value.?per|break.?up value|nav per|dps\b|bvps\b"
RATIO = r"ratio|percentage|\broa\b|\broe\b|return on|margin|yield|coverage|times|turnover|gearing|leverage|efficiency|utilization|%$"
COUNT = r"number of|no\.? of|employees|branches|shares outstanding|issued shares|paid.?up shares"
EMBEDDED_UNIT = r"(?i)\(MMCFT?\)|\(MMBTU\)|\(Each\)|\(Tons?\)|\(KM\)|\(Nos\.?\)|\(Rs\.?\s*Mn\)|\(Rs\.?\s*000\)|\(Line km\)|\(Hectares?\)|\(MW\)|\(GWH\)|\(000 Barrels\)|'000'\s*$"
OPERATIONAL = r"(?i)^gas sold|^gas purchased|^gas meters|^new connections|^lpg air mix|^mains.*transmission|^mains.*distribution|^seismic survey|^wells drilled|^production.*barrels|^cement.*dispatches|^clinker|^capacity utilization|^plant capacity"
HEADER_LABELS = ("particulars", "description", "item", "line item", "")


def flatten_tables(files: DataFrame, keys: Sequence[str], empty_dash: float | None = None) -> DataFrame:
    """Cells of the pipe tables in markdown ``files`` (keys, text): section, line_item, column, value.

    Headings and table headers hold up to the next; header-like labels and cells without number are left out. All of it happens in the file's own row: nothing is
    shuffled or sorted.
    """
    rule = lambda x: F.contains(x, F.lit("|")) & F.contains(x, F.lit("-")) & x.rlike(r"^\|?[\s:|-]*-[\s:|-]*$")
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("no"), trimmed(x).alias("line"))), lambda r: r["line"] != "")
    ruled = files.select(*keys, once(lines=F.transform(lines, lambda r: r.withField("rule", rule(r["line"])))))
    # headings, and lines above a rule, which are heads of tables: what follows up to the next one has them in force
    table = lambda r: r["line"].startswith("|") & ~r["rule"]
    above = lambda i: F.coalesce(F.get("lines", i + 1)["rule"], F.lit(False))
    marks = F.filter(F.transform("lines", lambda r, i: F.struct(i.alias("at"), F.when(r["line"].startswith("#"), r["line"]).alias("heading"), F.when(table(r) & above(i), r["line"]).alias("head"))), lambda m: m["heading"].isNotNull() | m["head"].isNotNull())
    start = F.struct(F.lit(None).cast("string").alias("heading"), F.lit(None).cast("string").alias("head"), F.array().cast("array<struct<at:int,heading:string,head:string>>").alias("out"))

    def carry(s: Column, m: Column) -> Column:
        heading, head = F.coalesce(m["heading"], s["heading"]).alias("heading"), F.coalesce(m["head"], s["head"]).alias("head")
        return F.struct(heading, head, F.array_append(s["out"], F.struct(m["at"].alias("at"), heading, head)).alias("out"))

    carried = ruled.select(*keys, "lines", once(marks=marks)).select(*keys, "lines", once(marks=F.aggregate("marks", start, carry, lambda s: s["out"])))
    end = lambda i: F.coalesce(F.get("marks", i + 1)["at"], F.size("lines"))
    parts = F.transform("marks", lambda m, i: F.struct(m["heading"].alias("heading"), m["head"].alias("head"), F.filter(F.slice("lines", m["at"] + 2, end(i) - m["at"] - 1), table).alias("rows")))
    held = carried.select(*keys, once(parts=F.filter(parts, lambda p: p["head"].isNotNull() & (F.size(p["rows"]) > 0)))).select(*keys, F.explode("parts").alias("p"))
    cells = lambda x: F.transform(F.split(F.regexp_replace(x, r"^\||\|$", ""), r"\|", -1), lambda c: trimmed(F.replace(c, F.lit("**"), F.lit(""))))
    section = F.coalesce(trimmed(F.regexp_replace("p.heading", "^#+", "")), F.lit(""))
    named = held.select(*keys, once(section=section, head=cells(F.col("p.head")), rows=F.col("p.rows"))).select(*keys, "section", "head", F.explode("rows").alias("r"))
    body = named.select(*keys, F.col("r.no").alias("line_no"), "section", "head", once(cells=cells(F.col("r.line"))))
    each = body.select(*keys, "line_no", "section", F.get("cells", F.lit(0)).alias("line_item"), "cells", F.posexplode(F.slice("head", 2, 1000)).alias("col_no", "column"))
    out = each.where(~F.lower("line_item").isin(*HEADER_LABELS)).select(*keys, "line_no", "section", "line_item", "col_no", "column", once(value=number(F.get("cells", F.col("col_no") + 1), dash=empty_dash, percent=True, spaces=True)))
    return out.where(F.col("value").isNotNull() & F.col("column").isNotNull())


def flatten_multiyear(files: DataFrame, keys: Sequence[str], report_year: str = "report_year") -> DataFrame:
    """Rows of the year columns that aren't in the future of the report, with ``data_year``."""
    year = F.regexp_extract("column", r"((?:19|20)\d{2})", 1).try_cast("int")
    return flatten_tables(files, keys).withColumn("data_year", year).where(F.col("data_year") <= F.col(report_year))


#: What headers and labels of compensation tables name: the first pattern that fits.
ROLES = (("chief_executive", r"chief executive|\bceo\b|managing director"), ("non_executive_directors", r"non.?executive"), ("directors", r"director"), ("executives", r"executive"))
MEASURES = (
    ("persons", r"number of|no\.? of|persons"), ("total", r"\btotal\b"), ("base_salary", r"remuneration|basic|salary|\bfee"), ("bonus", r"bonus|incentive"), ("housing", r"hous|rent|accommodation"),
    ("retirement", r"retire|provident|gratuity|pension"), ("other_benefits", r"other|medical|utilit|conveyance|allowance|benefit|perquisite"),
)


def named(text: Column, names: Sequence[tuple[str, str]]) -> Column:
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(None).cast("string")
    for name, pattern in reversed(names):
        out = F.when(low.rlike(pattern), name).otherwise(out)
    return out


def compensation_roles(files: DataFrame, keys: Sequence[str], roles: Sequence[tuple[str, str]] = ROLES, measures: Sequence[tuple[str, str]] = MEASURES, year: str = "year") -> DataFrame:
    """One row for each role of a filing's compensation tables, whatever their layout: keys, scope, role, ``year``, a column for each measure, unit.

    A role may head a column or a row, with the measure on the other side, and a header may carry a year beside either; without one it is the filing's (column
    ``year`` of ``files``). ``scope`` follows the section's heading. Of several lines of one measure the figures are added up (parts of benefits); only a table's last
    total, and its last number of persons, count. Cells that name no role or no measure are left out.
    """
    cells = flatten_tables(files, list(dict.fromkeys([*keys, year])), empty_dash=None)
    head, label = F.col("column"), F.col("line_item")
    by_column = named(head, roles)
    role = F.coalesce(by_column, named(label, roles))
    measure = F.when(by_column.isNotNull(), named(label, measures)).otherwise(named(head, measures))
    own = F.regexp_extract(F.concat_ws(" ", head, label), r"\b((?:19|20)\d{2})\b", 1).try_cast("int")
    section = F.lower("section")
    scope = F.when(section.contains("unconsolidated") | ~section.contains("consolidated"), "unconsolidated").otherwise("consolidated")
    told = cells.select(*keys, scope.alias("scope"), role.alias("role"), F.coalesce(own, F.col(year)).alias(year), measure.alias("_m"), "value", F.struct("line_no", "col_no").alias("_at")).where("role IS NOT NULL AND _m IS NOT NULL")
    pick = lambda m: F.max_by(F.when(F.col("_m") == m, F.col("value")), F.when(F.col("_m") == m, F.col("_at")))
    aggs = [(pick(m) if m in ("persons", "total") else F.sum(F.when(F.col("_m") == m, F.col("value")))).alias(m) for m, _ in measures]
    by = list(dict.fromkeys([*keys, year]))
    return told.groupBy(*by, "scope", "role").agg(*aggs).withColumn("unit", F.lit("thousands"))


def drop_reason(item: Column, section: Column, value: Column, excluded: Column) -> Column:
    """Why a multi-year row goes, first reason first; null for rows that stay."""
    label = F.coalesce(item, F.lit(""))
    large = F.exists(F.array(*map(F.lit, LARGE_ITEMS)), lambda w: F.contains(F.lower(label), w))
    return (
        F.when(excluded, "excluded_ticker")
        .when((label == "") | trimmed(label).rlike(r"^[\d,.\-\s()]+$"), "numeric_label")
        .when(F.lower(section).rlike(ANALYSIS), "analysis_section")
        .when((value == 100) | ((value < 500) & large), "index_value")
        .when(label.rlike(EMBEDDED_UNIT) | label.rlike(OPERATIONAL), "low_confidence")
    )


def data_type(item: Column, section: Column) -> Column:
    """per_share before ratio before count before monetary, by the words of the item and its section."""
    words = F.lower(F.concat_ws(" ", F.coalesce(item, F.lit("")), F.coalesce(section, F.lit(""))))
    return F.when(words.rlike(PER_SHARE), "per_share").when(words.rlike(RATIO), "ratio").when(words.rlike(COUNT), "count").otherwise("monetary")


def section_unit(section: Column) -> Column:
    """The unit that a section's title tells; null if none."""
    t = F.lower(F.coalesce(section, F.lit("")))
    has = lambda *words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(t, w))
    return F.when(has("million", " mn", "(mn)"), "millions").when(has("'000", "000s", "thousand", "(000)"), "000s").when(has("rupees") & ~has("000"), "Rs")


def clean_label(item: Column) -> Column:
    """Without bold and footnote marks, single spaces."""
    plain = F.regexp_replace(F.regexp_replace(item, r"\*\*", ""), "[¹²³⁴⁵⁶⁷⁸⁹⁰]+\\)", "")
    return trimmed(F.regexp_replace(F.regexp_replace(plain, r"\s*\d+\)$", ""), r"\s+", " "))


def clean_multiyear(rows: DataFrame, excluded: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Clean rows, one of each (ticker, data_year, item, type) from the latest report; and the count of rows lost for each reason.

    A missing ``unit_type`` is read off the section's title.
    """
    if "unit_type" not in rows.columns:
        rows = rows.withColumn("unit_type", F.lit(None).cast("string"))
    marked = rows.withColumn("reason", drop_reason(F.col("line_item"), F.col("section"), F.col("value"), F.coalesce(F.col("ticker").isin(*excluded or [""]), F.lit(False))))
    lost = marked.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n_rows"))
    kept = marked.where("reason IS NULL").drop("reason").withColumn("line_item", clean_label(F.col("line_item")))
    kept = kept.withColumns({"data_type": data_type(F.col("line_item"), F.col("section")), "unit_type": F.coalesce(F.nullif("unit_type", F.lit("")), section_unit(F.col("section"))), "_key": F.lower("line_item")})
    return latest_report(kept, ["ticker", "data_year", "_key", "data_type"]).drop("_key"), lost


def printed_forms(value: Column, multiyear: bool = False) -> Column:
    """Ways a figure may be printed. Whole ones: plain, with separators, and from 1000 on in thousands; others with their decimals.

    ``multiyear`` adds whole millions and percentages.
    """
    v = F.abs(value)
    n = F.floor(v)
    shown = lambda x: F.format_number(x, 0)
    whole = [n.cast("string"), shown(n), *(F.when(n >= 1000, f(F.floor(n / 1000))) for f in (lambda x: x.cast("string"), shown))]
    # format_number rounds the exact binary value, half to even
    one, two = (F.call_function("format_number", v, F.lit(f)) for f in ("0.0", "0.00"))
    plain = F.regexp_replace(v.cast("decimal(38,12)").cast("string"), "0+$", "")
    parts = [one, two, plain]
    if multiyear:
        whole.append(F.when(n >= 1_000_000, F.floor(n / 1_000_000).cast("string")))
        parts += [F.concat(plain, F.lit("%")), F.concat(one, F.lit("%"))]
    return F.array_distinct(F.array_compact(F.when(v == n, F.array(*whole)).otherwise(F.array(*parts))))


#: Printed numbers in a text, and the longest way a figure may be printed.
NUMBER_RUN, LONGEST_FORM = r"[0-9.,%]+", 44


def printed_parts(text: Column) -> Column:
    """The distinct parts of a text's printed numbers that may be a figure's form, each from a digit on."""
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({NUMBER_RUN})"), 1))
    starts = lambda r: F.filter(F.sequence(F.lit(1), F.length(r)), lambda i: F.substr(r, i, F.lit(1)).rlike("[0-9]"))
    ends = lambda r, i: F.transform(F.sequence(F.lit(1), F.least(F.length(r) - i + 1, F.lit(LONGEST_FORM))), lambda n: F.substr(r, i, n))
    return F.array_distinct(F.flatten(F.transform(runs, lambda r: F.flatten(F.transform(starts(r), lambda i: ends(r, i))))))


def value_presence(records: DataFrame, sources: DataFrame, keys: Sequence[str], multiyear: bool = False, manifest: DataFrame | None = None) -> DataFrame:
    """``records`` with ``presence``: found, missing, no_source, or no_manifest where ``manifest`` (keys, pages) is given and lists no page. ``sources``: keys, text, one row for each filing.

    A form of a figure is found where it stands in the text, as a part of a longer number too. A filing's text is read once, beside the forms that its records ask
    for: only the parts among these leave its row and meet the figures. No join may broadcast: sizes that are estimated before parts and forms are counted are far too
    small. A null value is missing.
    """
    on = list(keys)
    figures = records.where("value IS NOT NULL").select(*on, "value").distinct()
    forms = figures.select(*on, "value", F.explode(printed_forms(F.col("value"), multiyear)).alias("_form"))
    asked = forms.groupBy(*on).agg(F.collect_set("_form").alias("_asked"))
    seen = asked.join(sources.where("text IS NOT NULL").select(*on, "text").hint("merge"), on)
    parts = seen.select(*on, once(_parts=F.array_intersect("_asked", printed_parts(F.col("text"))))).select(*on, F.explode("_parts").alias("_form"))
    found = forms.join(parts.hint("merge"), [*on, "_form"], "left_semi").select(*on, "value").distinct().withColumn("_found", F.lit(True))
    read = sources.where("text IS NOT NULL").select(*on).distinct().withColumn("_read", F.lit(True))
    presence = F.when(F.col("_read").isNull(), "no_source").when(F.col("_found"), "found").otherwise("missing")
    met = records.join(read.hint("merge"), on, "left").join(found.hint("merge"), [*on, "value"], "left")
    if manifest is not None:
        listed = manifest.where(F.size("pages") > 0).select(*on).distinct().withColumn("_listed", F.lit(True))
        met, presence = met.join(listed.hint("merge"), on, "left"), F.when(F.col("_listed").isNull(), "no_manifest").otherwise(presence)
    return met.withColumn("presence", presence).select(*records.columns, "presence")


def presence_status(presence: DataFrame, key: str = "ticker") -> DataFrame:
    """Share found by key: pass from 80 %, warn from 60 %; ``problem`` where more is missing than found."""
    rates = presence.where("presence IN ('found', 'missing')").groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col("presence") == "found").alias("n_found"))
    rate = F.col("n_found") / F.col("n")
    return rates.withColumns({"status": F.when(rate >= 0.8, "pass").when(rate >= 0.6, "warn").otherwise("fail"), "problem": F.col("n") > 2 * F.col("n_found")})


def reproducible_sample(rows: DataFrame, key: str, n: int = 500, seed: int = 42) -> DataFrame:
    """``n`` rows that depend on their keys and the seed only: the first by a hash of both. Null keys come last; equal keys are ordered by all columns."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return rows.orderBy(F.col(key).isNull(), order, key, *(c for c in rows.columns if c != key)).limit(n)


#: Letters of the runs that an index of lines knows, and the labels up to which a key's lines are searched without one.
GRAM, FEW = 4, 500


def grams(text: Column) -> Column:
    """Distinct runs of GRAM letters; none in shorter texts."""
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.substr(text, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def label_hits(labels: DataFrame, lines: DataFrame, key: str, few: int = FEW) -> DataFrame:
    """Labels with the lines of their key that contain them, whatever the case.

    Labels and lines of a key meet, up to ``few`` labels, and the lines are searched: no line is taken apart, and work grows with the lines. In a key of more labels a line that
    contains a label contains all its runs of four letters: each label meets the lines that have the run of it that is rarest in its key's labels. Labels of under
    four letters have no run and meet all lines of their key. A line is read once either way.
    """
    l = F.lower("label")
    named = labels.where(F.col(key).isNotNull() & F.col("label").isNotNull()).select(key, "label").distinct()
    # few keys have many labels: at most one for each ``few`` labels
    many = F.broadcast(named.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > few).select(key, F.lit(True).alias("_many")))
    asked = named.join(many, key).where(F.length(l) >= GRAM).select(key, "label", F.explode(grams(l)).alias("_g"))
    rarity = asked.groupBy(key, "_g").agg(F.count("*").alias("_n"))
    rarest = asked.join(rarity, [key, "_g"]).groupBy(key, "label").agg(F.min(F.struct("_n", "_g")).alias("_r")).select(key, "label", F.col("_r._g").alias("_g"))
    # the empty run stands for all lines
    direct = named.join(many, key, "left").where(F.col("_many").isNull() | (F.length(l) < GRAM)).select(key, "label", F.lit("").alias("_g"))
    runs = F.when(F.col("_many"), F.concat(F.array(F.lit("")), grams(F.lower("line")))).otherwise(F.array(F.lit("")))
    placed = lines.where("line IS NOT NULL").join(many, key, "left").select(key, "line_no", "line", F.explode(runs).alias("_g"))
    return direct.unionByName(rarest).hint("merge").join(placed, [key, "_g"]).where(F.contains(F.lower("line"), l)).select(key, "label", "line_no", "line")


def best_label_row(labels: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """For each label the source line that fits best: 100 if its first cell is the label, 50 with a figure of four digits, -20 if in part only.

    ``lines``: key, line_no (a line's own in its key), line.
    """
    l, c = F.lower("label"), F.lower(trimmed(F.regexp_extract("line", r"^\|?\s*([^|]*)", 1)))
    hits = label_hits(labels, lines, key)
    extra = [x for x in labels.columns if x not in (key, "label")]
    hits = hits.join(labels, [key, "label"]) if extra else hits
    score = F.when(c == l, 100).otherwise(-20) + F.when(F.col("line").rlike(r"\d[\d,]{3,}"), 50).otherwise(0)
    w = Window.partitionBy(key, "label").orderBy(F.desc("score"), "line_no")
    return hits.withColumn("score", score).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


# Key balance-sheet fields by how plainly filings print them (fixed values).
PLAIN_FIELDS = ("property_equipment", "cash_and_equivalents", "receivables", "inventory", "payables", "short_term_debt")
INTRICATE_FIELDS = ("total_assets", "total_equity_and_liabilities", "share_capital", "reserves", "long_term_debt")


def statement_lines(pages: DataFrame, key: str) -> DataFrame:
    """``(key, line_no, line)`` of each filing's real statement pages, or of all its pages if none is one; ``pages``: key, page, text.

    A page is a real one by its title, its unit or a table figure with separators, unless it shows a composition in percent.
    """
    low = F.lower("text")
    real = (F.contains(low, F.lit("statement of financial position")) | F.contains(low, F.lit("rupees in")) | F.col("text").rlike(r"\|\s*\d{1,3}(?:,\d{3})+\s*\|")) & ~(F.contains(low, F.lit("composition")) & F.contains("text", F.lit("%")))
    marked = pages.where("text IS NOT NULL").select(key, "page", "text", real.alias("_real"))
    some = marked.groupBy(key).agg(F.bool_or("_real").alias("_some"))
    kept = marked.join(some, key).where(F.col("_real") | ~F.col("_some"))
    return kept.select(key, "page", F.posexplode(F.split("text", "\n")).alias("_n", "line")).select(key, F.struct("page", "_n").alias("line_no"), "line")


def line_figures(line: Column) -> Column:
    """Sizes of the whole figures after a table line's label: 0 (a dash is one), and those of 100 and more, as smaller ones are notes."""
    cells = F.filter(F.split(line, r"\|"), lambda c, i: i >= 2)
    sizes = F.transform(cells, lambda c: F.regexp_replace(F.regexp_replace(c, r"[-(]", "0"), r"\D", "").try_cast("long"))
    return F.filter(sizes, lambda v: (v == 0) | (v >= 100))


def qc_label_match(rows: DataFrame, pages: DataFrame, key: str = "file") -> DataFrame:
    """Key balance-sheet rows with ``plain`` and ``status``: matched, mismatched, not_found, or no_source for filings without pages.

    ``rows``: key, row_no, source_item, canonical, value (of the first column; null counts as 0); ``pages``: key, page, text. A row matches if the
    source line that fits its label best holds the size of its value, or no figure where that is 0.
    """
    named = lambda names: F.exists(F.array(*map(F.lit, names)), lambda n: F.contains(F.lower("canonical"), n))
    wanted = rows.where(named((*PLAIN_FIELDS, *INTRICATE_FIELDS))).select(key, "row_no", "canonical", trimmed(F.regexp_replace("source_item", r"\*\*", "")).alias("label"), F.coalesce(F.abs("value"), F.lit(0.0)).alias("size"), named(PLAIN_FIELDS).alias("plain"))
    lines = statement_lines(pages, key).withColumn("line", F.regexp_replace("line", r"\*\*", "")).where(F.contains("line", F.lit("|")))
    best = best_label_row(wanted.where("label <> ''").select(key, "label").distinct(), lines, key).select(key, "label", line_figures(F.col("line")).alias("_figures"))
    read = pages.where("text IS NOT NULL").select(key).distinct().withColumn("_read", F.lit(True))
    met = wanted.join(best, [key, "label"], "left").join(read, key, "left")
    same = F.exists("_figures", lambda v: v == F.col("size")) | ((F.col("size") == 0) & (F.size("_figures") == 0))
    status = F.when(F.col("_read").isNull(), "no_source").when(F.col("_figures").isNull(), "not_found").when(same, "matched").otherwise("mismatched")
    return met.select(key, "row_no", "canonical", "plain", status.alias("status"))


def source_balance(rows: DataFrame, key: str = "file", tolerance: float = 5.0) -> DataFrame:
    """Filings with both totals: ``diff_pct`` of equity and liabilities, and whether they balance; of several rows of a total the last counts."""
    name = F.lower("canonical")
    other = F.contains(name, F.lit("total_equity_and_liabilities"))
    assets = F.contains(name, F.lit("total_assets")) & ~F.contains(name, F.lit("total_equity"))
    last = lambda test: F.max_by(F.when(test, F.coalesce(F.abs("value"), F.lit(0.0))), F.when(test, F.col("row_no")))
    both = rows.groupBy(key).agg(last(assets).alias("total_assets"), last(other).alias("other_side")).where("total_assets <> 0 AND other_side <> 0")
    off = 100 * F.abs(F.col("total_assets") - F.col("other_side")) / F.col("other_side")
    return both.withColumns({"diff_pct": F.round(off, 1), "balanced": off <= tolerance})


def filing_gaps(filings: DataFrame, companies: DataFrame, years: Sequence[int]) -> DataFrame:
    """Quarter ends that should have been filed: before the latest month filed in their year, not the fiscal year end, and not there.

    ``filings``: ticker, period_end of quarterly filings; ``companies``: ticker, fiscal_month. A fiscal month that isn't given is inferred:
    June if any September or December quarter was filed, else December if a June one was, else June.
    """
    months = F.collect_set(F.month("period_end"))
    inferred = F.when(F.arrays_overlap("months", F.array(F.lit(9), F.lit(12))), 6).when(F.array_contains("months", 6), 12).otherwise(6)
    fiscal = filings.groupBy("ticker").agg(months.alias("months")).join(companies.select("ticker", "fiscal_month"), "ticker", "left").select("ticker", F.coalesce("fiscal_month", inferred).alias("fiscal_month"))
    have = filings.where(F.year("period_end").isin(*years)).groupBy("ticker", F.year("period_end").alias("year")).agg(months.alias("months"))
    lacks = F.array_except(F.array(*map(F.lit, (3, 6, 9, 12))), "months")
    each = have.select("ticker", "year", F.array_max("months").alias("latest"), F.explode(lacks).alias("month")).where("month < latest").join(fiscal, "ticker").where("month <> fiscal_month")
    return each.select("ticker", F.last_day(F.make_date("year", "month", F.lit(1))).alias("period_end"))
