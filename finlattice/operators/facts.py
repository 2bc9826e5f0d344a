"""From quarters and periods to the long fact table, and page documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import number, once, period_header, unit_factor
from .periods import dedupe_balance_rows

#: Columns of a published fact, in order.
COLUMNS = (
    "ticker", "company_name", "industry", "unit_type", "period_type", "period_end", "period_duration", "fiscal_year", "section", "statement_type",
    "canonical_field", "original_name", "value", "method", "source_file", "source_pages", "source_url", "qc_flag",
)


def qc_flag(value: Column, method: Column, non_negative: Column, reason: Column, failed: Column | None = None) -> Column:
    """derivation_anomaly, unexpected_negative or (balance sheets) qc_flagged, with the reason; a reason alone is allowlisted."""
    kind = F.when(non_negative & (value < 0), F.when(F.coalesce(method, F.lit("direct")).isin("", "direct", "direct_3M"), "unexpected_negative").otherwise("derivation_anomaly"))
    if failed is not None:
        kind = kind.when(failed, "qc_flagged")
    return F.when(kind.isNotNull(), F.concat_ws(": ", kind, reason)).when(reason.isNotNull(), F.concat(F.lit("allowlisted: "), reason)).otherwise("")


def enrich(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Company name and industry; empty if unknown."""
    dim = companies.select("ticker", F.col("company_name").alias("_n"), F.col("industry").alias("_i"))
    return rows.join(dim, "ticker", "left").withColumns({"company_name": F.coalesce("_n", F.lit("")), "industry": F.coalesce("_i", F.lit(""))}).drop("_n", "_i")


def attach_pages(rows: DataFrame, manifest: DataFrame, keys: tuple[str, ...] = ("ticker", "period_key", "section", "stmt")) -> DataFrame:
    """Sorted source pages from the manifest's rows; an empty list where it has none."""
    pages = manifest.groupBy(*keys).agg(F.sort_array(F.collect_set("page")).alias("source_pages"))
    return rows.join(pages, list(keys), "left").withColumn("source_pages", F.coalesce("source_pages", F.array().cast("array<int>")))


def with_sources(rows: DataFrame, stmt: str, manifest: DataFrame | None, base_url: str) -> DataFrame:
    """``source_pages`` and ``source_url`` by the file that ``source_file`` names; empty where it names none.

    ``manifest``: ticker, period_key, section, stmt, page.
    """
    part = lambda i: F.regexp_extract(F.coalesce("source_file", F.lit("")), r"([A-Z0-9]+)_(annual|quarterly)_([\d-]+)_(\w+?)(?:\.md)?$", i)
    kind, period = part(2), part(3)
    url = F.concat_ws("/", F.lit(base_url), part(1), F.substring(period, 1, 4), F.concat_ws("_", part(1), F.initcap(kind), period))
    rows = rows.withColumns({"_t": part(1), "_p": F.concat_ws("_", kind, period), "_s": part(4), "source_url": F.when(kind != "", url).otherwise("")})
    if manifest is None:
        return rows.withColumn("source_pages", F.array().cast("array<int>")).drop("_t", "_p", "_s")
    m = manifest.where(F.lower("stmt") == stmt).select(F.col("ticker").alias("_t"), F.col("period_key").alias("_p"), F.col("section").alias("_s"), "page")
    return attach_pages(rows, m, ("_t", "_p", "_s")).drop("_t", "_p", "_s")


def with_flags(rows: DataFrame, non_negative: tuple[str, ...], allowlist: DataFrame | None, failed: DataFrame | None = None) -> DataFrame:
    """``qc_flag`` of facts. ``allowlist``: ticker, fiscal_year, section, reason; ``failed``: ticker, period_end, section of balance sheets that don't balance."""
    reason = F.lit(None).cast("string")
    if allowlist is not None:
        rows = rows.join(allowlist.select("ticker", "fiscal_year", "section", F.col("reason").alias("_reason")), ["ticker", "fiscal_year", "section"], "left")
        reason = F.col("_reason")
    if failed is not None:
        keys = ["ticker", "period_end", "section"]
        rows = rows.join(failed.select(*keys).distinct().withColumn("_failed", F.lit(True)), keys, "left")
    flag = qc_flag(F.col("value"), F.col("method"), F.col("canonical_field").isin(*non_negative or [""]), reason, None if failed is None else F.coalesce("_failed", F.lit(False)))
    return rows.withColumn("qc_flag", flag).drop("_reason", "_failed")


def first_labels(periods: DataFrame, order: str = "source_file") -> DataFrame:
    """The first label of each (ticker, section, field) that isn't empty, by ``order``."""
    given = periods.where("source_item <> ''")
    return given.groupBy("ticker", "section", "field").agg(F.min_by("source_item", F.struct(order, "source_item")).alias("label"))


def flat_factor(unit: Column, field: Column, unscaled: str = "eps|per_share") -> Column:
    """What makes a published figure thousands; full_rupees, which only the checks know, and fields named like ``unscaled`` stay as they are."""
    return F.when(F.lower(field).rlike(unscaled), 1.0).otherwise(unit_factor(F.when(F.lower(unit) != "full_rupees", unit)))


def flatten_facts(quarters: DataFrame, periods: DataFrame, companies: DataFrame, stmt: str, non_negative: tuple[str, ...] = (), allowlist: DataFrame | None = None, manifest: DataFrame | None = None, base_url: str = "") -> DataFrame:
    """Facts of a flow statement: derived 3-month rows, and cumulative ones as reported; null values are dropped.

    ``allowlist``: ticker, fiscal_year, section, reason; ``manifest``: see with_sources.
    """
    three = quarters.select("ticker", "section", "fiscal_year", "period_end", F.lit("3M").alias("period_duration"), "method", F.col("source").alias("source_file"), "source_item", "field", "value")
    direct = periods.where(F.col("months").isin(6, 9, 12)).select("ticker", "section", "fiscal_year", "period_end", F.concat("months", F.lit("M")).alias("period_duration"), F.lit("direct").alias("method"), "source_file", "source_item", "field", (F.col("value") * flat_factor(F.col("unit_type"), F.col("field"), "eps")).alias("value"))
    rows = enrich(three.unionByName(direct).where("value IS NOT NULL"), companies).withColumns({
        "unit_type": F.lit("thousands"), "period_type": F.when(F.col("period_duration") == "12M", "annual").otherwise("quarterly"), "statement_type": F.lit(stmt),
        "canonical_field": F.col("field"), "original_name": F.coalesce("source_item", "field"),
    })
    return with_flags(with_sources(rows, stmt, manifest, base_url), non_negative, allowlist).select(*COLUMNS)


def flatten_bs(cells: DataFrame, companies: DataFrame, non_negative: tuple[str, ...] = (), allowlist: DataFrame | None = None, failed: DataFrame | None = None, manifest: DataFrame | None = None, base_url: str = "") -> DataFrame:
    """Balance-sheet facts straight from the cells of extraction files.

    ``cells``: file, ticker, filing_type, filing_period, section, unit_type, row_no, source_item, canonical, col_no, col_header, raw; ``companies``: ticker,
    company_name, industry, fiscal_month (12 if unknown). Columns without a date, names that are none, and cells without
    a figure give nothing. Of one item's rows for a date, those of the filing's own period stand before comparatives, annual
    before quarterly, then the first read.
    """
    # a header without a digit has no date
    dated = cells.where(valid_canonical(F.col("canonical")) & F.col("col_header").rlike("[0-9]"))
    rows = dated.select("*", once(_head=period_header(F.col("col_header")), _raw=number(F.col("raw"), spaces=True))).where(F.col("_head.period_end").isNotNull() & F.col("_raw").isNotNull())
    rows = rows.withColumns({"period_end": F.col("_head.period_end"), "period_duration": F.coalesce(F.concat("_head.months", F.lit("M")), F.lit("PIT"))})
    rows = enrich(rows, companies).join(companies.select("ticker", F.col("fiscal_month").alias("_fm")), "ticker", "left")
    late = (F.col("filing_type") != "annual") & (F.month("period_end") > F.coalesce("_fm", F.lit(12)))
    rows = rows.select(
        "ticker", "company_name", "industry", F.lit("thousands").alias("unit_type"), F.col("filing_type").alias("period_type"), "period_end", "period_duration", (F.year("period_end") + late.cast("int")).cast("int").alias("fiscal_year"), "section",
        F.lit("balance_sheet").alias("statement_type"), F.col("canonical").alias("canonical_field"), F.col("source_item").alias("original_name"), (F.col("_raw") * flat_factor(F.col("unit_type"), F.col("canonical"))).alias("value"),
        F.lit("").alias("method"), F.concat("file", F.lit(".md")).alias("source_file"),
        F.when(F.col("filing_type") == "annual", F.col("filing_period") == F.year("period_end").cast("string")).otherwise(F.col("filing_period") == F.col("period_end").cast("string")).alias("is_primary"),
        (F.col("filing_type") == "annual").alias("is_annual"), F.struct("file", "row_no", "col_no").alias("read_order"),
    )
    one = dedupe_balance_rows(rows, ["ticker", "period_end", "section", "canonical_field", "original_name"])
    return with_flags(with_sources(one, "bs", manifest, base_url), non_negative, allowlist, failed).select(*COLUMNS)


def valid_canonical(name: Column) -> Column:
    """Not empty, no leading digit, no = , or space, not one or two capitals, at most 60 characters."""
    return F.coalesce((name != "") & ~name.rlike(r"^\d") & ~name.rlike("[=, ]") & ~name.rlike("^[A-Z]{1,2}$") & (F.length(name) <= 60), F.lit(False))


def skip_filings(rows: DataFrame, patterns: DataFrame, *columns: str) -> DataFrame:
    """Without rows whose file (or another column) holds a pattern listed for their ticker."""
    p = patterns.select(F.col("ticker").alias("_t"), "pattern")
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.col(c), F.col("pattern")), F.lit(False))
    return rows.join(p, (F.col("ticker") == F.col("_t")) & hit, "left_anti")


def compile_documents(pages: DataFrame, skip: DataFrame, classified: DataFrame, companies: DataFrame) -> DataFrame:
    """Page documents: pages not skipped, with industry, filing parts, summary and tags.

    ``pages``: ticker, year, filing, page, path, text; ``skip``: path; ``classified``: relative_path, summary, section_tags.
    """
    left = pages.join(skip.select("path").distinct(), "path", "left_anti")
    tags = classified.select(F.col("relative_path").alias("path"), "summary", "section_tags")
    kind = F.when(F.lower("filing").contains("annual"), "annual").otherwise("quarterly")
    period = F.coalesce(F.nullif(F.regexp_extract("filing", r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), F.regexp_extract("filing", r"(\d{4})", 1))
    return enrich(left.join(tags, "path", "left"), companies.select("ticker", "company_name", "industry")).select(
        "ticker", "industry", kind.alias("filing_type"), period.alias("filing_period"), F.substring(period, 1, 4).try_cast("int").alias("filing_year"), "section_tags", F.col("page").alias("pg"), F.regexp_replace("path", r"\.md$", ".jpg").alias("jpg_path"), F.coalesce("summary", F.lit("")).alias("summary"), "text"
    )
