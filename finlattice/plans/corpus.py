"""Page, delta and market queries on documents, labels and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import delta, market, pages
from .catalog import query


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select(F.col("source").alias("filing"), F.col("doc_id").alias("page"), "text")


_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
SKIP_SQL = rf"""
WITH p AS (SELECT source AS filing, doc_id AS page, {_TRIM.format("text")} AS t, min(doc_id) OVER (PARTITION BY source) AS lo, max(doc_id) OVER (PARTITION BY source) AS hi FROM documents),
r AS (SELECT filing, page, CASE WHEN page % 101 = 0 THEN 'corrupted' WHEN page <= lo + 1 OR page >= hi - 1 THEN 'edge' WHEN t <> '' AND length(regexp_replace(t, '[^\x00-\x7F]', '', 'g')) / length(t) < 0.85 THEN 'urdu' END AS reason FROM p)
SELECT * FROM r WHERE reason IS NOT NULL
"""


@query("skip_list", SKIP_SQL)
def skip_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir)
    return pages.skip_list(p, p.where("page % 101 = 0"))


_LINES = r"""
WITH d AS (SELECT doc_id AS page, text, list_filter({0}, lambda x: regexp_replace(x, '\s+', '', 'g') <> '') AS l FROM documents),
e AS (SELECT page, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM d),
f AS (SELECT *, i - row_number() OVER (PARTITION BY page, x ORDER BY i) AS island FROM e),
g AS (SELECT page, max(n) AS run FROM (SELECT page, x, island, count(*) AS n FROM f GROUP BY ALL) GROUP BY page),
h AS (SELECT d.page, d.text, len(l) AS n, coalesce(run, 0) AS run, len(list_distinct(l)) / len(l) AS ratio, l FROM d LEFT JOIN g USING (page))
"""
CORRUPT_SQL = _LINES.format(r"string_split(text, chr(10))") + r"""
SELECT page, CASE WHEN n < 10 THEN NULL WHEN run >= 12 THEN 'repeated_lines' WHEN ratio < 0.25 THEN 'low_unique_ratio' WHEN len(list_filter(l, lambda x: length(x) > 2000 AND length(x) - length(regexp_replace(x, '[|\-_=]', '', 'g')) > 0.5 * length(x))) > 0 THEN 'separator_line' WHEN contains(text, '[DATA MISSING]') THEN 'data_missing' END AS corruption FROM h
"""


@query("page_corruption", CORRUPT_SQL)
def corruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_corruption(_pages(spark, sf_dir)).select("page", "corruption")


STRUCTURE_SQL = _LINES.format(rf"list_transform(string_split(text, chr(10)), lambda x: {_TRIM.format('x')})") + r"""
, k AS (SELECT *, len(regexp_extract_all(text, '\d{1,3}(?:,\d{3})+\s+\d{1,3}(?:,\d{3})+')) AS cc, CASE WHEN n >= 10 THEN run ELSE 0 END AS r, CASE WHEN n >= 10 THEN ratio ELSE 1.0 END AS u,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\s*\|?\s*[\d,\.\(\)\-\$]+\s*\|?\s*$') AND regexp_matches(x, '\d{1,3}(?:,\d{3}){2,}'))) AS orphans FROM h)
SELECT page, CAST(r AS INTEGER) AS max_run, round(u, 4) AS unique_ratio, CAST(cc AS INTEGER) AS n_concatenated, CAST(orphans AS INTEGER) AS n_orphans, CASE WHEN cc >= 10 OR r >= 8 OR u < 0.30 THEN 'fail' WHEN cc >= 3 OR orphans >= 5 THEN 'warn' ELSE 'pass' END AS status FROM k
"""


@query("page_structure", STRUCTURE_SQL)
def structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_structure(_pages(spark, sf_dir)).select("page", "max_run", F.round("unique_ratio", 4).alias("unique_ratio"), "n_concatenated", "n_orphans", "status")


SPLIT_SQL = "SELECT doc_id AS page, CASE WHEN doc_id % 5 = 0 THEN 'skip' WHEN doc_id % 3 = 0 THEN 'corrupted' ELSE 'ready' END AS state FROM documents"


@query("split_ready", SPLIT_SQL)
def split_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir).select("page")
    return delta.split_ready(p, p.where("page % 5 = 0"), p.where("page % 3 = 0"), "page")


DELTA_SQL = """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE source END AS source, md5(text) AS h FROM documents),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, h ORDER BY doc_id) AS n FROM d WHERE doc_id % 3 <> 0) WHERE n = 1)
SELECT c.doc_id, c.source FROM c WHERE NOT EXISTS (SELECT 1 FROM d p WHERE p.doc_id % 3 = 0 AND p.source IS NOT DISTINCT FROM c.source AND p.h = c.h)
"""


@query("delta_documents", DELTA_SQL)
def delta_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("source")).alias("source"), F.md5(F.col("text").cast("binary")).alias("h"))
    return delta.delta(d.where("doc_id % 3 <> 0"), d.where("doc_id % 3 = 0"), ("source", "h"), ("doc_id",)).select("doc_id", "source")


UNFINISHED_SQL = """
SELECT doc_id FROM documents WHERE doc_id % 2 = 1 OR doc_id % 10 = 0
"""


@query("unfinished_items", UNFINISHED_SQL)
def unfinished(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    ledger = d.where("doc_id % 2 = 0").withColumn("h", F.when(F.col("doc_id") % 10 == 0, F.lit("old")).otherwise(F.col("h")))
    return delta.unfinished(d, ledger, ("doc_id",), "h").select("doc_id")


ROUTE_SQL = """
SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'OK' WHEN quality = 0 AND toxic = 0 THEN 'Fix' ELSE 'ReOCR' END AS score, count(*) AS n_pages FROM labels GROUP BY 1
"""


@query("route_repairs", ROUTE_SQL)
def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").when(F.col("toxic") == 0, " Fix_Flash").otherwise("severe")
    rows = _t(spark, sf_dir, "labels").select(F.concat(F.lit("p/"), "doc_id").alias("relative_path"), pages.normalise_score(word).alias("extraction_score"))
    return pages.route_repairs(rows)


MANIFEST_SQL = """
WITH t AS (SELECT source AS filing, doc_id AS page, unnest([CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END]) AS tag FROM documents JOIN labels USING (doc_id))
SELECT filing, tag, array_to_string(list_sort(list(page)), ',') AS pages FROM t WHERE tag IS NOT NULL GROUP BY ALL
"""


@query("extraction_manifest", MANIFEST_SQL)
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").select(F.col("source").alias("filing"), F.col("doc_id").alias("page")).join(_t(spark, sf_dir, "labels").withColumnRenamed("doc_id", "page"), "page")
    tags = F.array(F.struct(F.lit(" GOOD").alias("tag"), F.col("quality").cast("string").alias("confidence")), F.struct(F.lit("toxic").alias("tag"), F.col("toxic").cast("string").alias("confidence")), F.struct(F.lit("odd").alias("tag"), F.lit("1").alias("confidence")))
    rows = d.withColumn("section_tags", pages.normalise_tags(tags, ["good", "toxic"]))
    return pages.extraction_manifest(rows, ["filing"]).withColumn("pages", F.array_join("pages", ","))


RANGE_SQL = """
WITH c AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, arg_max(value, (ts, event_id)) AS closing_price FROM events GROUP BY ALL)
SELECT *, max(closing_price) OVER (PARTITION BY symbol ORDER BY date ROWS 251 PRECEDING) AS high_52w, min(closing_price) OVER (PARTITION BY symbol ORDER BY date ROWS 251 PRECEDING) AS low_52w,
  max(closing_price) OVER (PARTITION BY symbol ORDER BY date ROWS 6 PRECEDING) AS high_7, min(closing_price) OVER (PARTITION BY symbol ORDER BY date ROWS 6 PRECEDING) AS low_7 FROM c
"""


@query("range_52w", RANGE_SQL)
def range_52w(spark: SparkSession, sf_dir: str) -> DataFrame:
    close = _t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("closing_price"))
    return market.rolling_range(market.rolling_range(close), 7, names=("high_7", "low_7"))


MARKET_SQL = """
WITH p AS (SELECT event_id, user_id AS symbol, ts AS date, value AS closing_price FROM events WHERE event_type = 'purchase'),
i AS (SELECT user_id AS symbol, ts AS date, arg_min(value - 20, event_id) AS ltm_income FROM events WHERE event_type = 'signup' GROUP BY ALL),
d AS (SELECT user_id AS symbol, ts AS date, arg_min(-value, event_id) AS ltm_dividends FROM events WHERE event_type = 'error' GROUP BY ALL),
a AS (SELECT p.*, i.ltm_income FROM p ASOF LEFT JOIN i ON p.symbol = i.symbol AND p.date >= i.date),
b AS (SELECT a.*, d.ltm_dividends, CASE WHEN closing_price > 0 THEN closing_price * (a.symbol + 1) END AS market_cap FROM a ASOF LEFT JOIN d ON a.symbol = d.symbol AND a.date >= d.date)
SELECT event_id, round(market_cap, 2) AS market_cap, round(CASE WHEN ltm_income > 0 THEN market_cap / ltm_income END, 4) AS pe_ratio, round(CASE WHEN ltm_dividends <> 0 AND market_cap > 0 THEN 100 * abs(ltm_dividends) / market_cap END, 4) AS dividend_yield FROM b
"""


@query("market_metrics", MARKET_SQL)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("symbol"), F.col("ts").alias("date"), "event_type", "value")
    of = lambda kind, expr, name: e.where(F.col("event_type") == kind).groupBy("symbol", "date").agg(F.min_by(F.expr(expr), "event_id").alias(name))
    prices = e.where("event_type = 'purchase'").select("event_id", "symbol", "date", F.col("value").alias("closing_price"))
    shares = e.select("symbol").distinct().withColumn("shares", F.col("symbol") + 1)
    out = market.market_metrics(prices, shares, of("signup", "value - 20", "ltm_income"), of("error", "-value", "ltm_dividends"))
    return out.select("event_id", F.round("market_cap", 2).alias("market_cap"), F.round("pe_ratio", 4).alias("pe_ratio"), F.round("dividend_yield", 4).alias("dividend_yield"))


UPSERT_SQL = """
SELECT user_id AS symbol, ts AS date, event_id, CASE WHEN event_id % 3 = 0 THEN value + 1 ELSE value END AS value FROM events
"""


@query("upsert", UPSERT_SQL)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select(F.col("user_id").alias("symbol"), F.col("ts").alias("date"), "event_id", "value")
    return delta.upsert(e.where("event_id % 2 = 0 OR event_id % 3 <> 0"), e.where("event_id % 3 = 0").withColumn("value", F.col("value") + 1), ("symbol", "date", "event_id"))


UPDATE_SQL = "SELECT event_id, value, CASE WHEN event_id % 4 = 0 AND event_id % 8 <> 0 THEN value * 2 ELSE 0.5 END AS high_52w FROM events"


@query("update_columns", UPDATE_SQL)
def update(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select("event_id", "value", F.lit(0.5).alias("high_52w"))
    new = e.where("event_id % 4 = 0").select("event_id", F.when(F.col("event_id") % 8 != 0, F.col("value") * 2).alias("high_52w"))
    return delta.update_columns(e, new, ("event_id",), ("high_52w",))


MERGE_SQL = "SELECT DISTINCT source FROM documents"


@query("merge_lists", MERGE_SQL)
def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    return delta.merge_lists(d.where("doc_id % 2 = 0").select("source"), d.where("doc_id % 2 = 1").select("source"), d.select("source"))
