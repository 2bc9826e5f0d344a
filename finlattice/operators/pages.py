"""Page checks: skip lists, corruption, structure, repair routing, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import trimmed

# Fixed patterns of printed tables.
CONCATENATED = r"\d{1,3}(?:,\d{3})+\s+\d{1,3}(?:,\d{3})+"
NUMBER_LINE = r"^\s*\|?\s*[\d,\.\(\)\-\$]+\s*\|?\s*$"
LARGE_NUMBER = r"\d{1,3}(?:,\d{3}){2,}"


def lines_of(text: Column, strip: bool) -> Column:
    """Non-blank lines."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(F.transform(lines, trimmed), lambda x: x != "") if strip else F.filter(lines, lambda x: trimmed(x) != "")


def longest_run(lines: Column) -> Column:
    """Length of the longest run of equal neighbours, in the row."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(s["last"] == x, s["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(lines, start, step, lambda s: s["best"])


def unique_ratio(lines: Column) -> Column:
    return F.size(F.array_distinct(lines)) / F.size(lines)


def ascii_ratio(text: Column) -> Column:
    t = trimmed(F.coalesce(text, F.lit("")))
    return F.when(t == "", 1.0).otherwise(F.length(F.regexp_replace(t, r"[^\x00-\x7F]", "")) / F.length(t))


def skip_list(pages: DataFrame, corrupted: DataFrame, filing: str = "filing", page: str = "page", least_ascii: float = 0.85) -> DataFrame:
    """Pages to leave out, with the first reason that holds: corrupted, edge (first and last two of a filing), urdu."""
    small = pages.select(filing, page, (ascii_ratio(F.col("text")) < least_ascii).alias("_foreign"))
    # bounds are minima and maxima that combine before the shuffle, so a filing of very many pages isn't gathered
    bounds = pages.groupBy(filing).agg(F.min(page).alias("_low"), F.max(page).alias("_high"))
    known = corrupted.select(filing, page).distinct().withColumn("_bad", F.lit(True))
    marked = small.join(known, [filing, page], "left").join(bounds, filing, "left")
    edge = (F.col(page) <= F.col("_low") + 1) | (F.col(page) >= F.col("_high") - 1)
    reason = F.when(F.col("_bad"), "corrupted").when(edge, "edge").when(F.col("_foreign"), "urdu")
    return marked.select(filing, page, reason.alias("reason")).where("reason IS NOT NULL")


def page_corruption(pages: DataFrame, after_repair: bool = False) -> DataFrame:
    """``pages`` with ``corruption``: repeated_lines, low_unique_ratio, separator_line, data_missing, or null for clean ones."""
    df = pages.withColumn("_lines", lines_of(F.col("text"), strip=False))
    lines = F.col("_lines")
    separators = F.exists(lines, lambda x: (F.length(x) > 2000) & (F.length(x) - F.length(F.regexp_replace(x, r"[|\-_=]", "")) > 0.5 * F.length(x)))
    found = F.when(F.size(lines) < 10, None).when(longest_run(lines) >= 12, "repeated_lines").when(unique_ratio(lines) < 0.25, "low_unique_ratio").when(separators, "separator_line")
    if not after_repair:
        found = found.when(F.col("text").contains("[DATA MISSING]"), "data_missing")
    return df.withColumn("corruption", found).drop("_lines")


def page_structure(pages: DataFrame) -> DataFrame:
    """``pages`` with n_concatenated, max_run, unique_ratio, n_orphans and ``status`` pass, warn or fail."""
    df = pages.withColumn("_lines", lines_of(F.col("text"), strip=True))
    lines, enough = F.col("_lines"), F.size("_lines") >= 10
    df = df.withColumns({
        "n_concatenated": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(CONCATENATED)),
        "max_run": F.when(enough, longest_run(lines)).otherwise(0),
        "unique_ratio": F.when(enough, unique_ratio(lines)).otherwise(1.0),
        "n_orphans": F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(NUMBER_LINE) & x.rlike(LARGE_NUMBER))),
    })
    fail = (F.col("n_concatenated") >= 10) | (F.col("max_run") >= 8) | (F.col("unique_ratio") < 0.30)
    warn = (F.col("n_concatenated") >= 3) | (F.col("n_orphans") >= 5)
    return df.withColumn("status", F.when(fail, "fail").when(warn, "warn").otherwise("pass")).drop("_lines")


def normalise_score(score: Column) -> Column:
    s = F.lower(F.trim(F.coalesce(score, F.lit(""))))
    return F.when(s.isin("fix", "fix_flash", "minor"), "Fix").when(s.isin("reocr", "fix_pro", "severe", "bad"), "ReOCR").otherwise("OK")


def normalise_tags(tags: Column, known: list[str]) -> Column:
    """Tags in lower case, known ones only, confidence within [0, 1] (bad: 0.5) at two decimals."""
    clean = F.transform(tags, lambda t: F.struct(F.lower(F.trim(t["tag"])).alias("tag"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t["confidence"].try_cast("double"), F.lit(0.5)))), 2).alias("confidence")))
    return F.filter(clean, lambda t: t["tag"].isin(*known))


def route_repairs(pages: DataFrame) -> DataFrame:
    """Page count of every score; rows without path are left out, unknown scores are counted as such."""
    score = F.when(F.col("extraction_score").isin("OK", "Fix", "ReOCR"), F.col("extraction_score")).otherwise("unknown")
    return pages.where("relative_path <> ''").groupBy(score.alias("score")).agg(F.count("*").alias("n_pages"))


def extraction_manifest(tagged: DataFrame, filing: list[str], least: float = 0.5) -> DataFrame:
    """Sorted pages of every filing and tag; ``tagged``: the filing's keys, page, section_tags."""
    tags = tagged.select(*filing, "page", F.explode(F.filter("section_tags", lambda t: t["confidence"] >= least)).alias("t"))
    return tags.groupBy(*filing, F.col("t.tag").alias("tag")).agg(F.sort_array(F.collect_set("page")).alias("pages"))


def filing_manifest(tagged: DataFrame, repaired: DataFrame, filing: list[str], least: float = 0.5) -> DataFrame:
    """One row for each filing: its page count, sorted pages of every tag, and sorted repaired pages.

    ``tagged``: the filing's keys, page, section_tags; ``repaired``: the filing's keys, page. A page that is listed twice counts once.
    """
    counts = tagged.groupBy(*filing).agg(F.count_distinct("page").alias("n_pages"))
    tags = extraction_manifest(tagged, filing, least).groupBy(*filing).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("tag", "pages")))).alias("pages"))
    fixed = repaired.groupBy(*filing).agg(F.sort_array(F.collect_set("page")).alias("repaired_pages"))
    none = F.array().cast(fixed.schema["repaired_pages"].dataType)
    return counts.join(tags, filing, "left").join(fixed, filing, "left").withColumn("repaired_pages", F.coalesce("repaired_pages", none))


#: Kinds of filings that a manifest's statistics count, by the tag that makes them.
COUNTED_TAGS = {"filings_with_statements": "statement", "filings_with_multi_year": "multi_year", "filings_with_ceo_comp": "ceo_comp"}


def manifest_stats(tagged: DataFrame, filing: list[str], least: float = 0.5) -> DataFrame:
    """Totals of a manifest as rows (stat, tag, n): total_filings, total_pages_classified (a row each), the filings with each of COUNTED_TAGS, and pages_by_tag.

    ``tagged``: the filing's keys, page, section_tags. One pass: a filing is one row before anything is counted.
    """
    tags = F.transform(F.filter(F.coalesce("section_tags", F.array().cast(tagged.schema["section_tags"].dataType)), lambda t: t["confidence"] >= least), lambda t: t["tag"])
    whole = tagged.select(*filing, tags.alias("tags")).groupBy(*filing).agg(F.count("*").alias("n_rows"), *(F.bool_or(F.array_contains("tags", t)).alias(s) for s, t in COUNTED_TAGS.items()))
    by_tag = tagged.select(*filing, "page", F.explode(F.array_distinct(tags)).alias("tag")).groupBy(*filing, "tag").agg(F.count_distinct("page").alias("n"))
    kinds = (F.struct(F.lit(s).alias("stat"), F.col(s).cast("long").alias("n")) for s in COUNTED_TAGS)
    counted = F.array(F.struct(F.lit("total_filings").alias("stat"), F.lit(1).cast("long").alias("n")), F.struct(F.lit("total_pages_classified").alias("stat"), F.col("n_rows").alias("n")), *kinds)
    totals = whole.select(F.inline(counted)).groupBy("stat").agg(F.sum("n").alias("n")).select("stat", F.lit(None).cast("string").alias("tag"), "n")
    return totals.unionByName(by_tag.groupBy("tag").agg(F.sum("n").alias("n")).select(F.lit("pages_by_tag").alias("stat"), "tag", "n"))


def statement_manifests(manifest: DataFrame) -> DataFrame:
    """``(ticker, filing_type, period, kind, pages)``: statement pages of every filing, multi-year and compensation pages of annual ones that have any.

    ``manifest``: filing (``TICKER_Annual_2024``, ``TICKER_Quarterly_2024-03-31``), pages (tag to pages). Filings of another name are left out.
    """
    part = lambda i: F.regexp_extract("filing", r"^(.+)_(?i:(annual|quarterly))_(\d{4}(?:-\d{2}-\d{2})?)$", i)
    rows = manifest.select(part(1).alias("ticker"), F.lower(part(2)).alias("filing_type"), part(3).alias("period"), "pages").where("ticker <> ''")
    none = F.array().cast("array<bigint>")
    of = lambda tag: F.coalesce(F.array_sort(F.array_distinct(F.try_element_at("pages", F.lit(tag)))).cast("array<bigint>"), none)
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), of(k).alias("pages")) for k in ("statement", "multi_year", "ceo_comp")))
    wanted = F.filter(kinds, lambda k: (k["kind"] == "statement") | ((F.col("filing_type") == "annual") & (F.size(k["pages"]) > 0)))
    return rows.select("ticker", "filing_type", "period", F.inline(wanted))
