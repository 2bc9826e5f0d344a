"""Queries on multi-year tables, presence in sources, balance sheets, coverage and page documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts, periods, qc, records
from .catalog import query
from .statements import _FACTS, _long, _t, _year_sums, rendered

MULTI_SQL = r"""
WITH r AS (SELECT o_custkey % 50 AS k, year(o_orderdate) AS y, o_orderkey AS i, CASE WHEN o_orderkey % 13 = 0 THEN 100 WHEN o_orderkey % 17 = 0 THEN 120 ELSE o_totalprice END AS v,
  CASE o_custkey % 5 WHEN 0 THEN 'Vertical Analysis' WHEN 1 THEN 'Key ratios' WHEN 2 THEN 'Summary (Rupees in million)' WHEN 3 THEN 'Summary in Rupees' ELSE 'Six years' END AS section,
  ['Sales revenue', 'Earnings  per share²)', '1,234 (5)', '**Current assets** 4)', 'Number of employees', 'Net profit', '', 'Gas sold (MMCF)', 'Deposits', 'Cement dispatches'][1 + o_orderkey % 10] AS label FROM orders),
t AS (SELECT *, lower(label) AS low FROM r),
f AS (SELECT * FROM t WHERE k <> 7 AND label <> '' AND NOT regexp_matches(label, '^[\d,.\-\s()]+$') AND section <> 'Vertical Analysis' AND v <> 100
  AND NOT (v < 500 AND (contains(low, 'revenue') OR contains(low, 'sales') OR contains(low, 'deposits') OR contains(low, 'total assets') OR contains(low, 'equity') OR contains(low, 'capital')))
  AND NOT (contains(low, '(mmcf)') OR starts_with(low, 'gas sold') OR regexp_matches(low, '^cement.*dispatches'))),
c AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(replace(label, '**', ''), '[¹²³]+\)', '', 'g'), '\s*\d+\)$', ''), '\s+', ' ', 'g')) AS item FROM f),
d AS (SELECT *, CASE WHEN contains(low, 'per share') THEN 'per_share' WHEN contains(lower(section), 'ratio') THEN 'ratio' WHEN contains(low, 'number of') THEN 'count' ELSE 'monetary' END AS data_type,
  CASE WHEN contains(section, 'million') THEN 'millions' WHEN contains(section, 'Rupees') THEN 'Rs' END AS unit_type FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY k, y, lower(item), data_type ORDER BY y + i % 3 DESC, i) AS n FROM d)
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS data_year, item AS line_item, data_type, unit_type, i AS read_order FROM n WHERE n = 1
"""
LOST_SQL = MULTI_SQL[: MULTI_SQL.index("f AS (")] + r"""
x AS (SELECT CASE WHEN k = 7 THEN 'excluded_ticker' WHEN label = '' OR regexp_matches(label, '^[\d,.\-\s()]+$') THEN 'numeric_label' WHEN section = 'Vertical Analysis' THEN 'analysis_section'
  WHEN v = 100 OR v < 500 AND (contains(low, 'revenue') OR contains(low, 'sales') OR contains(low, 'deposits')) THEN 'index_value' WHEN contains(low, 'gas sold') OR contains(low, 'dispatches') THEN 'low_confidence' END AS reason FROM t)
SELECT reason, count(*) AS n_rows FROM x WHERE reason IS NOT NULL GROUP BY 1
"""


def _multiyear(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    i, k = F.col("o_orderkey"), F.col("o_custkey")
    labels = ("Sales revenue", "Earnings  per share²)", "1,234 (5)", "**Current assets** 4)", "Number of employees", "Net profit", "", "Gas sold (MMCF)", "Deposits", "Cement dispatches")
    sections = ("Vertical Analysis", "Key ratios", "Summary (Rupees in million)", "Summary in Rupees", "Six years")
    value = F.when(i % 13 == 0, 100.0).when(i % 17 == 0, 120.0).otherwise(F.col("o_totalprice"))
    rows = _t(spark, sf_dir, "orders").select(
        (k % 50).cast("string").alias("ticker"), F.year("o_orderdate").alias("data_year"), (F.year("o_orderdate") + i % 3).alias("report_year"), i.alias("read_order"),
        F.get(F.array(*map(F.lit, sections)), (k % 5).cast("int")).alias("section"), F.get(F.array(*map(F.lit, labels)), (i % 10).cast("int")).alias("line_item"), value.alias("value"),
    )
    return records.clean_multiyear(rows, ("7",))


@query("clean_multiyear", MULTI_SQL)
def clean_multiyear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _multiyear(spark, sf_dir)[0].select("ticker", "data_year", "line_item", "data_type", "unit_type", "read_order")


@query("multiyear_rows_lost", LOST_SQL)
def multiyear_rows_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _multiyear(spark, sf_dir)[1]


PRESENCE_SQL = """
WITH v AS (SELECT o_custkey AS k, o_orderkey AS i, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders),
s AS (SELECT k, string_agg(CASE i % 3 WHEN 0 THEN format('{:,}', v) WHEN 1 THEN CAST(v AS VARCHAR) ELSE v || '.25' END, ' ') AS text FROM v WHERE k % 10 <> 0 GROUP BY k),
r AS (SELECT k, i, CASE i % 5 WHEN 0 THEN v + 7000 WHEN 1 THEN v % 1000 WHEN 2 THEN v + 0.25 ELSE v END AS x FROM v),
n AS (SELECT k, i, x, CAST(floor(x) AS BIGINT) AS n FROM r)
SELECT n.k AS filing, i AS o_orderkey, CASE WHEN text IS NULL THEN 'no_source'
  WHEN x = n AND (contains(text, CAST(n AS VARCHAR)) OR contains(text, format('{:,}', n)) OR (n >= 1000 AND (contains(text, CAST(n // 1000 AS VARCHAR)) OR contains(text, format('{:,}', n // 1000))))) THEN 'found'
  WHEN x <> n AND (contains(text, n || '.2') OR contains(text, n || '.25')) THEN 'found' ELSE 'missing' END AS presence
FROM n LEFT JOIN s USING (k)
"""


@query("value_presence", PRESENCE_SQL)
def value_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, i = F.floor("o_totalprice"), F.col("o_orderkey")
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("filing"), "o_orderkey", v.alias("v"))
    shown = F.when(i % 3 == 0, F.format_number("v", 0)).when(i % 3 == 1, F.col("v").cast("string")).otherwise(F.concat("v", F.lit(".25")))
    sources = o.where("filing % 10 <> 0").groupBy("filing").agg(F.array_join(F.collect_list(shown), " ").alias("text"))
    value = F.when(i % 5 == 0, F.col("v") + 7000).when(i % 5 == 1, F.col("v") % 1000).when(i % 5 == 2, F.col("v") + 0.25).otherwise(F.col("v"))
    return records.value_presence(o.select("filing", "o_orderkey", value.cast("double").alias("value")), sources, ["filing"]).select("filing", "o_orderkey", "presence")


LABEL_SQL = """
WITH l AS (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey AS k, l_linenumber AS i, CAST(round(l_extendedprice) AS BIGINT) AS v FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey),
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i) + 3 AS line_no FROM l),
t AS (SELECT k, sum(CASE WHEN i % 3 = 0 THEN -v ELSE v END) AS s, count(*) + 4 AS line_no FROM l GROUP BY k)
SELECT 'F' || k AS file, 'Item 1' AS label, CAST(line_no AS INTEGER) AS line_no, CASE WHEN v >= 1000 THEN 150 ELSE 100 END AS score FROM n WHERE i = 1
UNION ALL SELECT 'F' || k, 'line_2', CAST(line_no AS INTEGER), CASE WHEN v >= 1000 THEN 30 ELSE -20 END FROM n WHERE i = 2
UNION ALL SELECT 'F' || k, 'total', CAST(line_no AS INTEGER), CASE WHEN abs(s) >= 1000 OR (k % 5 = 0 AND abs(s + 200000) >= 1000) THEN 150 ELSE 100 END FROM t
"""


@query("best_label_row", LABEL_SQL)
def best_label_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = rendered(spark, sf_dir)
    lines = files.select("file", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    labels = files.select("file", F.explode(F.array(F.lit("Item 1"), F.lit("line_2"), F.lit("total"))).alias("label"))
    return records.best_label_row(labels, lines, "file").select("file", "label", "line_no", "score")


SUMS_SQL = """
WITH q AS (SELECT c_nationkey * 100 + o_custkey % 10 AS k, year(o_orderdate) AS y, quarter(o_orderdate) AS q, sum(floor(o_totalprice)) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
a AS (SELECT k, y, count(*) AS n, CAST(sum(v) AS DOUBLE) AS s FROM q GROUP BY k, y)
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year, s AS expected, 2 * s AS actual FROM a WHERE n = 4 AND k % 4 = 0
"""


@query("cf_year_sums", SUMS_SQL)
def cf_year_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_nationkey") * 100 + F.col("o_custkey") % 10
    o = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(k.alias("k"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), F.floor("o_totalprice").cast("double").alias("v"))
    quarters = o.groupBy("k", "y", "q").agg(F.sum("v").alias("value")).select("k", F.last_day(F.make_date("y", F.col("q") * 3, F.lit(1))).alias("period_end"), F.lit(3).alias("months"), "value")
    years = o.groupBy("k", "y").agg(F.sum("v").alias("v")).select("k", F.make_date("y", F.lit(12), F.lit(31)).alias("period_end"), F.lit(12).alias("months"), (F.col("v") * F.when(F.col("k") % 4 == 0, 2.0).otherwise(1.0)).alias("value"))
    rows = quarters.unionByName(years).select(F.col("k").cast("string").alias("ticker"), F.lit("c").alias("section"), F.lit("cfo").alias("field"), "period_end", "months", "value")
    return qc.cf_year_sums(rows).select("ticker", F.year("year_end").alias("year"), "expected", "actual")


REPAIR_SQL = f"""{_FACTS},
w AS (SELECT *, k % 5 AS m FROM v)
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year, s AS total_assets, 0.5 * s AS total_equity, s AS total_equity_and_liabilities,
  CASE m WHEN 0 THEN '' WHEN 1 THEN '[Derived: NCA + CA]' WHEN 2 THEN '[Derived: TE + TL]' WHEN 3 THEN '[Corrected: TE + TL, was ]' ELSE '[Derived: TCL + TNCL] [Derived: TA = TEL]' END AS repairs
FROM w
"""


@query("repair_bs_totals", REPAIR_SQL)
def repair_bs_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, m, c = F.col("s"), F.col("k") % 5, F.lit(None).cast("double")
    given = {
        "subtotal_equity": F.when(m == 0, 0.5 * s), "total_equity": F.when(m != 0, 0.5 * s), "total_liabilities": F.when(m != 4, 0.5 * s), "total_current_liabilities": 0.25 * s, "total_non_current_liabilities": 0.25 * s,
        "total_assets": F.when(~m.isin(1, 4), s), "total_current_assets": F.when(m == 1, 0.5 * s), "total_non_current_assets": F.when(m == 1, F.lit(0.0)), "total_non_current_assets_sub": F.when(m == 1, 0.5 * s),
        "total_equity_and_liabilities": F.when(m == 3, 1.5 * s).when(m != 2, s), "total_liabilities_and_equity": c,
    }
    wide = _year_sums(spark, sf_dir).withColumns(given)
    out = periods.repair_bs_totals(wide)
    return out.select(F.col("k").cast("string").alias("ticker"), F.col("y").alias("year"), "total_assets", "total_equity", "total_equity_and_liabilities", F.regexp_replace(F.array_join("repairs", " "), r"was [^]]*", "was ").alias("repairs"))


CRITICAL_SQL = f"""{_FACTS}
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year, 'revenue' AS missing FROM v WHERE k % 4 = 0
UNION ALL SELECT CAST(k AS VARCHAR), CAST(y AS INTEGER), 'bottom' FROM v WHERE k % 6 = 0
"""


@query("critical_fields", CRITICAL_SQL)
def critical_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("s"), F.col("k")
    long = _long(_year_sums(spark, sf_dir), turnover=F.when((k % 4 != 0) & (k % 2 == 0), s), revenue_net=F.when(k % 2 == 1, s), net_profit=F.when(k % 6 != 0, s), gross_profit=s)
    out = qc.critical_fields(long, {"revenue": ("revenue_net", "turnover"), "bottom": ("net_profit", "profit_after_tax")})
    return out.select("ticker", F.year("period_end").alias("year"), "missing")


_FACT_ROWS = "WITH f AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) AS y, CASE o_orderkey % 4 WHEN 0 THEN 'total_assets' WHEN 1 THEN 'total_equity' WHEN 2 THEN 'total_liabilities' ELSE 'other' END AS field FROM orders)"
FEW_SQL = f"{_FACT_ROWS} SELECT k AS ticker, count(DISTINCT y) AS n_periods FROM f GROUP BY k HAVING count(DISTINCT y) < 4"
LACKS_SQL = f"""{_FACT_ROWS},
g AS (SELECT k, y, list_filter(['total_assets', 'total_equity', 'total_liabilities'], lambda x: NOT list_contains(list(field), x)) AS missing FROM f GROUP BY k, y)
SELECT k AS ticker, CAST(y AS INTEGER) AS year, array_to_string(missing, ',') AS missing FROM g WHERE len(missing) >= 2
"""


def _coverage(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = F.col("o_orderkey") % 4
    field = F.when(m == 0, "total_assets").when(m == 1, "total_equity").when(m == 2, "total_liabilities").otherwise("other")
    rows = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").alias("period_end"), F.lit("c").alias("section"), field.alias("canonical_field"))
    return qc.coverage(rows, ("total_assets", "total_equity", "total_liabilities"))


@query("coverage_few_periods", FEW_SQL)
def few_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir)[0]


@query("coverage_missing_fields", LACKS_SQL)
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir)[1].select("ticker", F.col("period_end").alias("year"), F.array_join("missing", ",").alias("missing"))


BALANCE_SQL = """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey % 3 = 0 DESC, o_orderstatus = 'F' DESC, o_orderkey) AS n FROM orders)
SELECT o_custkey AS ticker, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS read_order FROM n WHERE n = 1
"""


@query("dedupe_balance_rows", BALANCE_SQL)
def dedupe_balance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").alias("year"), (F.col("o_orderkey") % 3 == 0).alias("is_primary"), (F.col("o_orderstatus") == "F").alias("is_annual"), F.col("o_orderkey").alias("read_order"))
    return periods.dedupe_balance_rows(rows, ["ticker", "year"]).select("ticker", "year", "read_order")


DOCUMENTS_SQL = """
SELECT coalesce(source, '') AS ticker, CASE WHEN doc_id % 3 = 0 THEN '' ELSE coalesce(upper(source), '') END AS industry, CASE WHEN doc_id % 2 = 0 THEN 'annual' ELSE 'quarterly' END AS filing_type, CASE WHEN doc_id % 2 = 0 THEN '2024' ELSE '2023-09-30' END AS filing_period,
  CAST(CASE WHEN doc_id % 2 = 0 THEN 2024 ELSE 2023 END AS INTEGER) AS filing_year, CAST(doc_id AS INTEGER) AS pg, 'p/' || doc_id || '.jpg' AS jpg_path, CASE WHEN doc_id % 5 = 0 THEN 'About ' || doc_id ELSE '' END AS summary, md5(text) AS digest
FROM documents WHERE doc_id % 7 <> 0
"""


@query("compile_documents", DOCUMENTS_SQL)
def compile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = _t(spark, sf_dir, "documents"), F.col("doc_id")
    path = F.concat(F.lit("p/"), i, F.lit(".md"))
    rows = d.select(F.concat_ws("#", F.coalesce("source", F.lit("")), F.when(i % 3 == 0, "unlisted")).alias("ticker"), F.lit(2024).alias("year"), F.when(i % 2 == 0, "Annual_2024").otherwise("q_2023-09-30").alias("filing"), i.cast("int").alias("page"), path.alias("path"), "text")
    done = d.where("doc_id % 5 = 0").select(path.alias("relative_path"), F.concat(F.lit("About "), i).alias("summary"), F.array(F.lit("tag")).alias("section_tags"))
    companies = d.select(F.coalesce("source", F.lit("")).alias("ticker")).distinct().withColumns({"company_name": F.col("ticker"), "industry": F.upper("ticker")})
    out = facts.compile_documents(rows, d.where("doc_id % 7 = 0").select(path.alias("path")), done, companies)
    return out.withColumn("ticker", F.split("ticker", "#")[0]).select("ticker", "industry", "filing_type", "filing_period", "filing_year", "pg", "jpg_path", "summary", F.md5("text").alias("digest"))
