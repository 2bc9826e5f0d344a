"""Whole checks of statements, balance-sheet facts, manifests and comparatives, on orders, line items and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cells, delta, facts, market, pages, qc, quarters, records
from .catalog import query
from .statements import _FACTS, _gate, _long, _t, _year_sums, GATE_SQL, rendered

# P&L periods: a customer's year and first half, with units, gaps and outliers by rule.
_PL = """
WITH o AS (SELECT o_custkey AS k, year(o_orderdate) AS y, month(o_orderdate) <= 6 AS h1, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
g AS (SELECT k, y, CAST(sum(v) AS DOUBLE) AS s, CAST(sum(v) FILTER (h1) AS DOUBLE) AS h FROM o GROUP BY ALL),
w AS (SELECT k, y, s, h, CASE WHEN k % 19 = 0 AND y = 1996 THEN 1000 * s ELSE s END AS rev FROM g),
l AS (
  SELECT k, y, 12 AS m, 'revenue_net' AS field, rev AS value FROM w WHERE k % 13 <> 0
  UNION ALL SELECT k, y, 12, 'cost_of_goods_sold', -0.6 * s FROM w
  UNION ALL SELECT k, y, 12, 'gross_profit', CASE WHEN k % 7 = 0 THEN 0.43 * s ELSE 0.4 * s END FROM w
  UNION ALL SELECT k, y, 12, 'net_profit', 0.3 * s FROM w WHERE k % 17 <> 0
  UNION ALL SELECT k, y, 6, 'revenue_net', CASE WHEN k % 5 = 0 THEN 10 * h ELSE h END FROM w WHERE h IS NOT NULL AND k % 13 <> 0
  UNION ALL SELECT k, y, 6, 'net_profit', 0.3 * h FROM w WHERE h IS NOT NULL),
u AS (SELECT l.*, CASE k % 11 WHEN 0 THEN 'rupees' WHEN 1 THEN 'bogus' WHEN 2 THEN NULL ELSE 'thousands' END AS unit, value * CASE WHEN k % 11 = 0 THEN 0.001 ELSE 1 END AS norm FROM l)
"""
QC_PL_SQL = _PL + """,
p AS (SELECT DISTINCT k, y, m, unit FROM u),
span AS (SELECT k, unnest(range(min(y), max(y) + 1)) AS y FROM p GROUP BY k),
c AS (SELECT k, y, m, bool_or(field = 'revenue_net') AS r, bool_or(field = 'net_profit') AS b FROM u GROUP BY ALL),
e AS (SELECT k, y, max(value) FILTER (field = 'gross_profit') AS a, max(value) FILTER (field = 'revenue_net') + max(value) FILTER (field = 'cost_of_goods_sold') AS x FROM u WHERE m = 12 GROUP BY ALL),
f AS (SELECT a.k, a.y, a.norm AS x, b.norm AS a FROM u a JOIN u b USING (k, y, field) WHERE field = 'revenue_net' AND a.m = 6 AND b.m = 12 AND b.norm < a.norm),
n AS (SELECT k, field, count(*) AS n, median(abs(norm)) AS med FROM u WHERE field IN ('revenue_net', 'net_profit', 'gross_profit') AND value <> 0 GROUP BY ALL HAVING count(*) >= 3),
r AS (SELECT k, arg_min((field, med), CASE field WHEN 'revenue_net' THEN 1 WHEN 'net_profit' THEN 2 ELSE 3 END) AS z FROM n GROUP BY k),
i AS (
  SELECT k, y, NULL AS m, 'missing_year' AS type, NULL AS actual FROM span ANTI JOIN p USING (k, y)
  UNION ALL SELECT k, y, 12, 'cumulative_decrease', a FROM f
  UNION ALL SELECT k, y, 12, 'gross_profit', a FROM e WHERE abs(a - x) / greatest(abs(a), abs(x), 1) > 0.05
  UNION ALL SELECT k, y, m, CASE WHEN unit IS NULL THEN 'missing' ELSE 'invalid' END, NULL FROM p WHERE unit IS NULL OR unit = 'bogus'
  UNION ALL SELECT k, y, m, 'missing_revenue', NULL FROM c WHERE NOT r
  UNION ALL SELECT k, y, m, 'missing_bottom_line', NULL FROM c WHERE NOT b
  UNION ALL SELECT u.k, y, m, '1000x_outlier', abs(norm) FROM u JOIN r ON u.k = r.k AND u.field = z[1] WHERE value <> 0 AND (abs(norm) / z[2] > 100 OR abs(norm) / z[2] < 0.01))
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS months, type, round(actual, 1) AS actual FROM i
"""


def _pl(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s, h = F.col("k"), F.col("s"), F.col("h")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    g = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y")).agg(F.sum(price).cast("double").alias("s"), F.sum(F.when(F.month("o_orderdate") <= 6, price)).cast("double").alias("h"))
    rev = F.when((k % 19 == 0) & (F.col("y") == 1996), 1000 * s).otherwise(s)
    rows = [
        (12, "revenue_net", F.when(k % 13 != 0, rev)), (12, "cost_of_goods_sold", -0.6 * s), (12, "gross_profit", F.when(k % 7 == 0, 0.43 * s).otherwise(0.4 * s)), (12, "net_profit", F.when(k % 17 != 0, 0.3 * s)),
        (6, "revenue_net", F.when(k % 13 != 0, F.when(k % 5 == 0, 10 * h).otherwise(h))), (6, "net_profit", 0.3 * h),
    ]
    each = F.array(*(F.struct(F.lit(m).alias("months"), F.last_day(F.make_date("y", F.lit(m), F.lit(1))).alias("period_end"), F.lit(f).alias("field"), v.alias("value")) for m, f, v in rows))
    unit = F.when(k % 11 == 0, "rupees").when(k % 11 == 1, "bogus").when(k % 11 != 2, "thousands")
    return g.select(k.cast("string").alias("ticker"), F.lit("consolidated").alias("section"), unit.alias("unit_type"), F.inline(F.filter(each, lambda x: x["value"].isNotNull())))


@query("qc_pl", QC_PL_SQL)
def qc_pl(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = qc.qc_pl(_pl(spark, sf_dir)).where("check <> 'semantic_equations' OR type = 'gross_profit'")
    return out.select("ticker", F.year("period_end").alias("year"), F.when(F.col("check") != "column_completeness", F.col("months")).alias("months"), "type", F.round("actual", 1).alias("actual"))


MONTHS_SQL = """
WITH d AS (SELECT DISTINCT o_custkey % 40 AS k, CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS e FROM orders WHERE o_orderkey % 3 = 0),
c AS (SELECT k, month(e) AS m, count(*) AS n, min(e) AS f FROM d GROUP BY ALL),
a AS (SELECT DISTINCT o_custkey % 40 AS k FROM orders)
SELECT CAST(a.k AS VARCHAR) AS ticker, CAST(coalesce((SELECT m FROM c WHERE c.k = a.k ORDER BY n DESC, f LIMIT 1), 12) AS INTEGER) AS fiscal_month FROM a
"""


@query("fiscal_months", MONTHS_SQL)
def fiscal_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).cast("string").alias("ticker"), F.lit("c").alias("section"), F.last_day("o_orderdate").alias("period_end"), F.when(F.col("o_orderkey") % 3 == 0, 12).otherwise(3).alias("months"))
    return qc.fiscal_months(rows).select("ticker", "fiscal_month")


QC_BS_SQL = f"""{_FACTS},
w AS (SELECT *, CASE WHEN k % 11 <> 0 THEN CASE WHEN k % 23 = 0 AND y = 1997 THEN s * 5000 ELSE s END END AS ta, CASE WHEN k % 11 = 2 THEN 0.1 * s ELSE 0.4 * s END AS te, 0.6 * s AS tl, CASE WHEN k % 11 = 1 THEN 1.5 * s WHEN k % 11 <> 3 THEN s END AS tel, CASE WHEN k % 29 = 0 THEN 'bogus' ELSE 'thousands' END AS unit FROM v),
q AS (SELECT *, coalesce(ta <> 0 AND (coalesce(abs(ta - tel) / ta > 0.05, false) OR coalesce(abs(te + tl - tel) / tel > 0.05, false) OR (tel IS NULL AND abs(ta - te - tl) / ta > 0.05)), false) AS bad FROM w),
m AS (SELECT k, median(ta) AS med FROM w GROUP BY k HAVING count(ta) >= 3),
a AS (SELECT q.k, count(*) AS n_periods, count(*) FILTER (bad) AS equation, count(*) FILTER (unit = 'bogus') AS units, count(*) FILTER (ta IS NULL) AS critical, count(*) FILTER (ta / med > 100 OR ta / med < 0.01) AS outliers, max(y) - min(y) + 1 - count(*) AS missing_years FROM q LEFT JOIN m USING (k) GROUP BY q.k)
SELECT CAST(k AS VARCHAR) AS ticker, n_periods, equation, units, critical, outliers, missing_years, k % 5 = 0 AS mixed_units, CASE WHEN equation + units + critical + outliers > 0 THEN 'fail' WHEN k % 5 = 0 OR missing_years > 0 THEN 'warn' ELSE 'pass' END AS status FROM a
"""


@query("qc_bs", QC_BS_SQL)
def qc_bs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _year_sums(spark, sf_dir)
    s, k, m = F.col("s"), F.col("k"), F.col("k") % 11
    far = (k % 23 == 0) & (F.col("y") == 1997)
    long = _long(sums, total_assets=F.when(m != 0, F.when(far, s * 5000).otherwise(s)), total_equity=F.when(m == 2, 0.1 * s).otherwise(0.4 * s), total_liabilities=0.6 * s, total_equity_and_liabilities=F.when(m == 1, 1.5 * s).when(m != 3, s))
    long = long.withColumn("unit_type", F.when(F.col("ticker").cast("long") % 29 == 0, "bogus").otherwise("thousands"))
    files = sums.select(k.cast("string").alias("ticker"), F.explode(F.when(k % 5 == 0, F.array(F.lit("rupees"), F.lit("thousands"))).otherwise(F.array(F.lit("thousands")))).alias("unit_type"))
    return qc.qc_bs(long, files)


QC_CF_SQL = f"""{_FACTS},
w AS (SELECT k, y, 0.5 * s AS flows, 0.2 * s AS adj, s AS start, CASE k % 4 WHEN 0 THEN 0.5 * s WHEN 1 THEN 0.7 * s WHEN 2 THEN 0.5 * s ELSE 2 * s END AS net, CASE k % 4 WHEN 0 THEN 1.7 * s WHEN 1 THEN 1.7 * s ELSE 9 * s END AS fin FROM v),
c AS (SELECT *, abs(net - flows) <= 0.05 * abs(flows) AS af, abs(fin - start - net - adj) <= 0.05 * abs(start + net + adj) AS ac, abs(net - flows - adj) <= 0.05 * abs(flows + adj) AS bf, abs(fin - start - net) <= 0.05 * abs(start + net) AS bc FROM w),
f AS (SELECT *, NOT (af AND ac) AND NOT (bf AND bc) AND NOT ((af OR bf) AND (ac OR bc)) AS fails, k % 3 <> 0 AND k % 10 <> 7 AS there FROM c)
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year, CASE WHEN fails AND NOT there THEN 'fail' ELSE 'pass' END AS status, CASE WHEN fails AND there THEN CASE WHEN k % 6 = 2 THEN 'source_arithmetic_error' ELSE 'source_match_fallback' END END AS flag FROM f
"""


@query("qc_cf", QC_CF_SQL)
def qc_cf(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums, s, k, m = _year_sums(spark, sf_dir), F.col("s"), F.col("k"), F.col("k") % 4
    net = F.when(m == 0, 0.5 * s).when(m == 1, 0.7 * s).when(m == 2, 0.5 * s).otherwise(2 * s)
    long = _long(sums, cfo=s, cfi=-0.4 * s, cff=-0.1 * s, net_cash_change=net, fx_adjustment=0.2 * s, cash_start=s, cash_end=F.when(m.isin(0, 1), 1.7 * s).otherwise(9 * s))
    long = long.withColumn("source_file", F.concat_ws("_", "ticker", F.year("period_end")))
    file = F.concat_ws("_", k, "y")
    flows = F.array(*(F.struct(F.lit(i).alias("row_no"), F.lit(n).alias("canonical"), (f * s).alias("v")) for i, (n, f) in enumerate((("cfo", 1.0), ("cfi", -0.4), ("cff", -0.1), ("cfo", 7.0)))))
    # a third of the files weren't read; in others a figure is another one; each file has two columns
    printed = sums.where(k % 3 != 0).select(file.alias("file"), k.alias("k"), F.inline(flows))
    two = printed.select("file", "canonical", "row_no", F.explode(F.array(F.lit(5.0), F.when((F.col("canonical") == "cfi") & (F.col("k") % 10 == 7), F.col("v") + 3).otherwise(F.col("v") + 1))).alias("value"))
    return qc.qc_cf(long, two, sums.where(k % 6 == 2).select(file.alias("file"))).select("ticker", F.year("period_end").alias("year"), "status", "flag")


BS_FLAT_SQL = r"""
WITH f AS (SELECT 'T' || o_custkey % 50 AS ticker, o_custkey % 3 = 0 AS rupees, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderkey % 2 = 0 AS annual, o_orderkey % 20 AS item, o_orderkey AS row_no, round(o_totalprice) * CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE 1 END AS v FROM orders),
g AS (SELECT *, ticker || CASE WHEN annual THEN '_annual_' || y ELSE '_quarterly_' || y || '-03-31' END || '_consolidated' AS file FROM f),
r AS (SELECT *, col, CASE WHEN col = 0 THEN make_date(y, CASE WHEN annual THEN 12 ELSE 3 END, 31) ELSE make_date(y - 1, 12, 31) END AS period_end, v * (1 + col) * CASE WHEN rupees THEN 0.001 ELSE 1 END AS value FROM g CROSS JOIN (VALUES (0), (1)) c(col) WHERE item <> 3),
n AS (SELECT *, row_number() OVER (PARTITION BY ticker, period_end, item ORDER BY CASE WHEN annual THEN year(period_end) = y ELSE period_end = make_date(y, 3, 31) END DESC, annual DESC, file, row_no, col) AS n FROM r),
m AS (SELECT 'T' || o_custkey % 50 AS ticker, CAST(year(o_orderdate) AS INTEGER) AS y, array_to_string(list_sort(list_distinct(list(o_orderkey % 7))), ',') AS pages FROM orders WHERE year(o_orderdate) % 2 = 0 GROUP BY ALL)
SELECT n.ticker, CAST(period_end AS DATE) AS period_end, CASE WHEN annual THEN 'annual' ELSE 'quarterly' END AS period_type, CAST(year(period_end) + CASE WHEN NOT annual AND month(period_end) > 6 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year, 'field_' || item AS canonical_field, round(value, 3) AS value, file || '.md' AS source_file,
  CASE WHEN annual THEN coalesce(pages, '') ELSE '' END AS source_pages, 'u/' || n.ticker || '/' || n.y || '/' || n.ticker || CASE WHEN annual THEN '_Annual_' || n.y ELSE '_Quarterly_' || n.y || '-03-31' END AS source_url, CASE WHEN item = 5 AND value < 0 THEN 'unexpected_negative' ELSE '' END AS qc_flag
FROM n LEFT JOIN m ON n.ticker = m.ticker AND n.y = m.y WHERE n = 1
"""


@query("flatten_bs", BS_FLAT_SQL)
def flatten_bs(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, y = F.col("o_orderkey"), F.year("o_orderdate")
    ticker, annual = F.concat(F.lit("T"), F.col("o_custkey") % 50), i % 2 == 0
    period = F.when(annual, y.cast("string")).otherwise(F.concat(y, F.lit("-03-31")))
    shown = lambda x: F.when(i % 7 == 0, F.concat(F.lit("("), F.format_number(x, 0), F.lit(")"))).otherwise(F.format_number(x, 0))
    v = F.round("o_totalprice")
    cols = F.array(F.struct(F.lit(0).alias("col_no"), F.concat(F.when(annual, "31 Dec ").otherwise("March 31, "), y).alias("col_header"), shown(v).alias("raw")), F.struct(F.lit(1).alias("col_no"), F.concat(F.lit("31 Dec "), y - 1, F.lit(" (Audited)")).alias("col_header"), shown(2 * v).alias("raw")), F.struct(F.lit(2).alias("col_no"), F.lit("Note").alias("col_header"), F.lit("7").alias("raw")))
    item = i % 20
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    # few bytes, but much to parse
    rows = o.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey").select(
        F.concat_ws("_", ticker, F.when(annual, "annual").otherwise("quarterly"), period, F.lit("consolidated")).alias("file"), ticker.alias("ticker"), F.when(annual, "annual").otherwise("quarterly").alias("filing_type"), period.alias("filing_period"), F.lit("consolidated").alias("section"),
        F.when(F.col("o_custkey") % 3 == 0, "rupees").otherwise("thousands").alias("unit_type"), i.alias("row_no"), F.concat(F.lit("Item "), item).alias("source_item"), F.when(item == 3, "A=B").otherwise(F.concat(F.lit("field_"), item)).alias("canonical"), F.inline(cols),
    )
    companies = o.select(ticker.alias("ticker"), F.lit("c").alias("company_name"), F.lit("i").alias("industry"), F.lit(6).alias("fiscal_month")).distinct()
    manifest = o.where(y % 2 == 0).select(ticker.alias("ticker"), F.concat(F.lit("annual_"), y).alias("period_key"), F.lit("consolidated").alias("section"), F.lit("BS").alias("stmt"), (i % 7).cast("int").alias("page"))
    out = facts.flatten_bs(rows, companies, ("field_5",), manifest=manifest, base_url="u")
    return out.select("ticker", "period_end", "period_type", "fiscal_year", "canonical_field", F.round("value", 3).alias("value"), "source_file", F.array_join("source_pages", ",").alias("source_pages"), "source_url", "qc_flag")


REPORT_SQL = f"""
WITH g AS ({GATE_SQL}),
f AS (SELECT CAST(CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey END AS VARCHAR) AS ticker FROM lineitem)
SELECT row_id AS subject, type, field FROM g
UNION ALL SELECT DISTINCT ticker, 'few_periods', '1' FROM f WHERE ticker IS NOT NULL
UNION ALL SELECT DISTINCT ticker || '|2020-12-31|c', 'missing_fields', 'gross_profit,net_profit,profit_before_tax' FROM f WHERE ticker IS NOT NULL
"""


@query("gate_report", REPORT_SQL)
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir, qc.gate_report)


FILINGS_SQL = """
WITH t AS (SELECT source AS filing, doc_id, quality, toxic, doc_id % 9 = 0 AS fixed FROM documents JOIN labels USING (doc_id))
SELECT filing, count(DISTINCT doc_id) AS n_pages, array_to_string(list_sort(list(doc_id) FILTER (quality = 1)), ',') AS good, array_to_string(coalesce(list_sort(list(doc_id) FILTER (fixed)), []), ',') AS repaired FROM t GROUP BY filing
"""


@query("filing_manifest", FILINGS_SQL)
def filing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").select(F.col("source").alias("filing"), F.col("doc_id").alias("page")).join(_t(spark, sf_dir, "labels").withColumnRenamed("doc_id", "page"), "page")
    rows = d.withColumn("section_tags", F.array(F.struct(F.lit("good").alias("tag"), F.col("quality").cast("double").alias("confidence"))))
    out = pages.filing_manifest(rows, rows.where("page % 9 = 0"), ["filing"])
    return out.select("filing", "n_pages", F.array_join(F.try_element_at("pages", F.lit("good")), ",").alias("good"), F.array_join("repaired_pages", ",").alias("repaired"))


SPLIT_MANIFEST_SQL = """
WITH f AS (SELECT o_custkey AS k, year(o_orderdate) AS y, o_custkey % 2 = 0 AS annual, list_sort(list_distinct(list(o_orderkey % 11) FILTER (o_orderkey % 3 = 0))) AS s, list_sort(list_distinct(list(o_orderkey % 11) FILTER (o_orderkey % 3 = 1))) AS m FROM orders GROUP BY ALL)
SELECT 'C' || k AS ticker, CASE WHEN annual THEN 'annual' ELSE 'quarterly' END AS filing_type, y || CASE WHEN annual THEN '' ELSE '-03-31' END AS period, 'statement' AS kind, array_to_string(coalesce(s, []), ',') AS pages FROM f
UNION ALL SELECT 'C' || k, 'annual', CAST(y AS VARCHAR), 'multi_year', array_to_string(m, ',') FROM f WHERE annual AND m IS NOT NULL
"""


@query("statement_manifests", SPLIT_MANIFEST_SQL)
def statement_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, y, i = F.col("o_custkey"), F.year("o_orderdate"), F.col("o_orderkey")
    filing = F.when(k % 2 == 0, F.concat(F.lit("C"), k, F.lit("_Annual_"), y)).otherwise(F.concat(F.lit("C"), k, F.lit("_Quarterly_"), y, F.lit("-03-31")))
    tag = F.when(i % 3 == 0, "statement").when(i % 3 == 1, "multi_year").otherwise("other")
    lists = _t(spark, sf_dir, "orders").groupBy(filing.alias("filing"), tag.alias("tag")).agg(F.collect_list(i % 11).alias("pages"))
    manifest = lists.groupBy("filing").agg(F.map_from_entries(F.collect_list(F.struct("tag", "pages"))).alias("pages"))
    return pages.statement_manifests(manifest).withColumn("pages", F.array_join("pages", ","))


COMPARATIVE_SQL = f"""{_FACTS},
x AS (SELECT k, y, CASE k % 5 WHEN 0 THEN 1000.0 WHEN 1 THEN 3000.0 WHEN 2 THEN -20.0 WHEN 3 THEN 5.0 ELSE 1.0 END AS f FROM v WHERE k % 13 <> 0),
c AS (SELECT *, CASE WHEN f = 1000 THEN 'UNIT_MISMATCH' WHEN f = 3000 THEN 'WRONG_PAGE' WHEN f = -20 THEN 'SIGN_ERROR' END AS category FROM x),
g AS (SELECT k, count(*) AS n, min(category) AS category FROM c WHERE category IS NOT NULL GROUP BY k)
SELECT 'F' || k AS file, n AS n_mismatched, n AS n_actionable, category AS primary_category, least(n, 5) AS n_worst FROM g
"""


@query("comparative_report", COMPARATIVE_SQL)
def comparative_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k, m = F.col("s"), F.col("k"), F.col("k") % 5
    factor = F.when(m == 0, 1000.0).when(m == 1, 3000.0).when(m == 2, -20.0).when(m == 3, 5.0).otherwise(1.0)
    base = _year_sums(spark, sf_dir).select(F.concat(F.lit("F"), k).alias("file"), k.alias("k"), F.col("y").alias("year"), F.lit("net_profit").alias("field"), F.lit("thousands").alias("unit_type"), "s", (s * factor).alias("c"))
    # files of every thirteenth customer have columns in two currencies
    headers = base.select("file", "year", F.explode(F.when(F.col("k") % 13 == 0, F.array(F.lit("12M Dec 2020 (US$)"), F.lit("12M Dec 2020"))).otherwise(F.array(F.lit("12M Dec 2020")))).alias("col_header"))
    one = qc.single_currency(headers).select("file", "year").distinct()
    comp = base.join(one, ["file", "year"]).select("file", "year", "field", "unit_type", F.col("c").alias("value"))
    found = qc.compare_comparatives(comp, base.select("file", "year", "field", "unit_type", F.col("s").alias("value")), ("file", "year"))
    return qc.comparative_report(found, ["file"]).select("file", "n_mismatched", "n_actionable", "primary_category", F.size("worst").cast("long").alias("n_worst"))


LTM_SQL = """
WITH e AS (SELECT user_id AS k, event_id AS i, CAST(ts AS DATE) AS d, value FROM events),
m AS (SELECT *, CASE i % 4 WHEN 0 THEN d WHEN 1 THEN make_date(year(d), 12, 31) WHEN 2 THEN make_date(year(d), month(d), 28) END AS date FROM e WHERE i % 5 <> 0)
SELECT k AS symbol, CAST(date AS DATE) AS date, round(arg_min(value * CASE WHEN i % 3 = 0 THEN 1 ELSE 1000 END, i), 3) AS ltm FROM m WHERE date IS NOT NULL GROUP BY ALL
"""


@query("ltm_values", LTM_SQL)
def ltm_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, d = F.col("event_id"), F.to_date("ts")
    month = F.get(F.array(*map(F.lit, "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split())), F.month(d) - 1)
    text = F.when(i % 4 == 0, d.cast("string")).when(i % 4 == 1, F.year(d).cast("string")).when(i % 4 == 2, F.concat_ws("-", F.year(d), month)).otherwise("FY twenty")
    rows = _t(spark, sf_dir, "events").select(F.col("user_id").alias("ticker"), F.when(i % 2 == 0, "ltm").otherwise("annual").alias("period_type"), F.when(i % 5 == 0, "unconsolidated").otherwise("consolidated").alias("section"), text.alias("period_end"), F.lit("net_profit").alias("key_metric"), "value", F.when(i % 3 == 0, "rupees").when(i % 3 == 1, "000s").alias("unit_type"), i.alias("read_order"))
    return market.ltm_values(rows, "net_profit", "ltm").select("symbol", "date", F.round("ltm", 3).alias("ltm"))


STATUS_SQL = """
WITH l AS (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey AS k, l_linenumber AS i, CAST(round(l_extendedprice) AS BIGINT) AS v FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey),
t AS (SELECT k, sum(CASE WHEN i % 3 = 0 THEN -v ELSE v END) AS s FROM l GROUP BY k),
n AS (SELECT DISTINCT k, abs(v) AS v FROM (SELECT k, v FROM l UNION ALL SELECT k, s FROM t UNION ALL SELECT k, s + 200000 FROM t WHERE k % 5 = 0) WHERE abs(v) > 1000),
m AS (SELECT n.k, n.v, bool_or(abs(n.v - l.v) / l.v <= 0.005) AS e, bool_or(n.v / l.v BETWEEN 990.0000001 AND 1009.9999999 OR n.v / l.v BETWEEN 0.000990001 AND 0.00100999) AS x FROM n JOIN l USING (k) WHERE k % 3 <> 0 GROUP BY ALL),
r AS (SELECT k, avg(CAST(coalesce(e, false) AS INTEGER)) AS rate, bool_or(coalesce(x, false) AND NOT coalesce(e, false)) AS x FROM m GROUP BY k),
b AS (SELECT k, (k % 5 = 0 AND 200000 > 0.05 * abs(s + 200000)) AS bad FROM t)
SELECT 'F' || b.k AS file, CAST(2 AS BIGINT) AS n_formulas, CAST(bad AS BIGINT) AS n_failed, CASE WHEN rate IS NULL THEN 'skip' WHEN x OR rate < 0.8 THEN 'warn' ELSE 'pass' END AS source, CASE WHEN bad THEN 'fail' ELSE 'pass' END AS status, CASE WHEN bad THEN 'fail' ELSE 'pass' END AS qc_status FROM b LEFT JOIN r USING (k)
"""


@query("file_status", STATUS_SQL)
def file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the source texts of two thirds of the files: their lines' figures, without the total
    lines = F.array_join(F.filter(F.split("text", "\n"), lambda x: x.startswith("| Item")), "\n")
    cut = F.transform(F.split(lines, "\n"), lambda x: F.concat(F.lit("sold for "), F.element_at(F.split(x, r"\|"), -2), F.lit(" or so")))
    source = F.when(F.substring("file", 2, 20).cast("long") % 3 != 0, F.array_join(cut, "\n"))
    return cells.check_files(rendered(spark, sf_dir).withColumn("source", source))


THIN_SQL = """
WITH c AS (SELECT o_custkey % 30 AS k, o_orderkey % 4 AS c, o_custkey % 7 = 0 OR o_orderkey % 4 > 0 OR o_orderkey % 16 = 0 AS filled FROM orders)
SELECT CAST(k AS VARCHAR) AS file, CAST(c AS INTEGER) AS col_no, count(*) AS n_cells, count(*) FILTER (filled) AS n_filled FROM c GROUP BY ALL HAVING count(*) FILTER (filled) < 0.38 * count(*)
"""


@query("column_structure", THIN_SQL)
def column_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, k = F.col("o_orderkey"), F.col("o_custkey")
    rows = _t(spark, sf_dir, "orders").select((k % 30).cast("string").alias("file"), (i % 4).cast("int").alias("col_no"), F.lit("h").alias("col_header"), F.when((k % 7 == 0) | (i % 4 > 0) | (i % 16 == 0), 1.0).alias("value"))
    return cells.column_structure(rows, 0.38).select("file", "col_no", "n_cells", "n_filled")


SKIPPED_SQL = """
SELECT o_orderkey FROM orders WHERE NOT (o_custkey % 3 = 0 AND contains('filing_' || year(o_orderdate) || '_' || month(o_orderdate), '_1996_1')) AND NOT (o_custkey % 10 = 4 AND contains(o_orderpriority, 'URGENT'))
"""


@query("skip_filings", SKIPPED_SQL)
def skip_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("ticker"), F.concat_ws("_", F.lit("filing"), F.year("o_orderdate"), F.month("o_orderdate")).alias("source_file"), F.col("o_orderpriority").alias("filing_period"))
    patterns = o.where("ticker % 3 = 0").select("ticker", F.lit("_1996_1").alias("pattern")).unionByName(o.where("ticker % 10 = 4").select("ticker", F.lit("URGENT").alias("pattern"))).distinct()
    return facts.skip_filings(o, patterns, "source_file", "filing_period").select("o_orderkey")


NAMES_SQL = r"""
WITH n AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '' WHEN 1 THEN p_partkey || '_x' WHEN 2 THEN 'a=' || p_partkey WHEN 3 THEN 'a,' || p_partkey WHEN 4 THEN 'AB' WHEN 5 THEN repeat('x', CAST(50 + p_partkey % 20 AS INTEGER)) WHEN 6 THEN p_name ELSE 'field_' || p_partkey END AS name FROM part)
SELECT p_partkey FROM n WHERE name <> '' AND NOT regexp_matches(name, '^[0-9]|[=, ]|^[A-Z]{1,2}$') AND length(name) <= 60
"""


@query("valid_names", NAMES_SQL)
def valid_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(k % 8 == 0, "").when(k % 8 == 1, F.concat(k, F.lit("_x"))).when(k % 8 == 2, F.concat(F.lit("a="), k)).when(k % 8 == 3, F.concat(F.lit("a,"), k)).when(k % 8 == 4, "AB").when(k % 8 == 5, F.expr("repeat('x', cast(50 + p_partkey % 20 as int))")).when(k % 8 == 6, F.col("p_name")).otherwise(F.concat(F.lit("field_"), k))
    return _t(spark, sf_dir, "part").where(facts.valid_canonical(name)).select("p_partkey")


LISTED_SQL = "SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'error')"


@query("listed_items", LISTED_SQL)
def listed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return delta.listed(e, e.where("event_type = 'error'"), ("user_id",)).select("event_id")


DERIVED_SQL = """
WITH d AS (SELECT l_orderkey AS k, l_linenumber % 4 + 1 AS q, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM lineitem GROUP BY ALL)
SELECT CAST(k AS VARCHAR) AS ticker, 'Q' || q AS quarter, 'negative_income' AS type, round(-v, 2) AS actual FROM d WHERE k % 3 = 0 AND q <> 1
UNION ALL SELECT CAST(k AS VARCHAR), 'Q' || q, 'activities_differ', round(2 * v, 2) FROM d WHERE k % 4 = 0 AND q <> 1 AND v > 1000
"""


@query("qc_derived", DERIVED_SQL)
def qc_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_linenumber") % 4 + 1
    d = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), q.alias("q")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("v"))
    k, v = F.col("k"), F.col("v")
    fields = F.array(*(F.struct(F.lit(n).alias("field"), x.alias("value")) for n, x in (("revenue_net", F.when(k % 3 == 0, -v).otherwise(v)), ("cfo", v), ("cfi", 2 * v), ("cff", -2 * v), ("net_cash_change", F.when(k % 4 == 0, 2 * v).otherwise(v)))))
    rows = d.select(k.cast("string").alias("ticker"), F.lit("c").alias("section"), F.lit(2020).alias("fiscal_year"), F.concat(F.lit("Q"), "q").alias("quarter"), F.when(F.col("q") == 1, "direct_3M").otherwise("12M-9M").alias("method"), F.inline(fields))
    out = quarters.qc_derived(rows).unionByName(quarters.qc_derived(rows, stmt="cf"))
    return out.select("ticker", "quarter", "type", F.round("actual", 2).alias("actual"))


TABLES_SQL = """
WITH l AS (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey AS k, l_linenumber AS i, CAST(round(l_extendedprice) AS BIGINT) AS v FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey)
SELECT 'F' || k AS file, 'CONSOLIDATED' AS section, 'Item ' || i AS line_item, CAST(y AS INTEGER) AS data_year, CAST(v AS DOUBLE) AS value FROM l CROSS JOIN (VALUES (2024), (2023)) c(y) WHERE k % 2 = 0 OR y = 2023
UNION ALL SELECT 'F' || k, 'CONSOLIDATED', 'Total', CAST(y AS INTEGER), CAST(sum(CASE WHEN i % 3 = 0 THEN -v ELSE v END) + CASE WHEN y = 2023 AND k % 5 = 0 THEN 200000 ELSE 0 END AS DOUBLE) FROM l CROSS JOIN (VALUES (2024), (2023)) c(y) WHERE k % 2 = 0 OR y = 2023 GROUP BY k, y
"""


@query("flatten_multiyear", TABLES_SQL)
def flatten_multiyear(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = rendered(spark, sf_dir).withColumn("report_year", F.when(F.substring("file", 2, 20).cast("long") % 2 == 0, 2024).otherwise(2023))
    out = records.flatten_multiyear(files, ["file", "report_year"])
    return out.select("file", "section", "line_item", "data_year", "value")


ASSETS_SQL = """
WITH l AS (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey AS k, l_linenumber AS i, CAST(round(l_extendedprice) AS DOUBLE) AS v FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey),
t AS (SELECT k, sum(v) AS s FROM l GROUP BY k)
SELECT 'F' || k AS file, CASE k % 3 WHEN 1 THEN s * 2 ELSE s * 1.5 END AS ta, CASE k % 3 WHEN 1 THEN s ELSE s * 3 END AS tel, CASE WHEN k % 3 = 1 THEN s END AS corrected FROM t WHERE k % 3 <> 0
"""


@query("repair_total_assets", ASSETS_SQL)
def repair_total_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.periods import pick

    first = pick(_t(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"), "l_extendedprice", "l_partkey", "l_suppkey")
    rows = first.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("row_no"), F.round("l_extendedprice").alias("value"), F.lit("A").alias("ref"), F.lit("leaf").alias("canonical"))
    s, m = F.col("s"), F.col("k") % 3
    totals = rows.groupBy("k").agg(F.sum("value").alias("s"))
    ends = F.array(F.struct(F.lit(90).alias("row_no"), F.when(m == 0, s).when(m == 1, s * 2).otherwise(s * 1.5).alias("value"), F.lit("Z=A").alias("ref"), F.lit("total_assets").alias("canonical")), F.struct(F.lit(95).alias("row_no"), F.when(m == 2, s * 3).otherwise(s).alias("value"), F.lit("").alias("ref"), F.lit("total_equity_and_liabilities").alias("canonical")), F.struct(F.lit(50).alias("row_no"), s.alias("value"), F.lit("Y=A").alias("ref"), F.lit("subtotal").alias("canonical")))
    both = rows.unionByName(totals.select("k", F.inline(ends))).select(F.concat(F.lit("F"), "k").alias("file"), F.lit(0).alias("col_no"), "row_no", "canonical", "ref", "value")
    return cells.repair_total_assets(both).select("file", "ta", "tel", "corrected")


PRESENT_SQL = """
WITH r AS (SELECT o_custkey % 40 AS k, CASE WHEN o_orderkey % 10 = 0 THEN 'no_source' WHEN o_orderkey % (2 + o_custkey % 40 % 6) = 0 THEN 'missing' ELSE 'found' END AS p FROM orders),
g AS (SELECT k, count(*) AS n, count(*) FILTER (p = 'found') AS f FROM r WHERE p <> 'no_source' GROUP BY k)
SELECT k AS ticker, n, f AS n_found, CASE WHEN f / n >= 0.8 THEN 'pass' WHEN f / n >= 0.6 THEN 'warn' ELSE 'fail' END AS status, n - f > f AS problem FROM g
"""


@query("presence_status", PRESENT_SQL)
def presence_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, k = F.col("o_orderkey"), F.col("o_custkey") % 40
    p = F.when(i % 10 == 0, "no_source").when(i % (2 + k % 6) == 0, "missing").otherwise("found")
    return records.presence_status(_t(spark, sf_dir, "orders").select(k.alias("ticker"), p.alias("presence")))


LABEL_MATCH_SQL = """
WITH o AS (SELECT o_custkey AS f, o_orderkey AS i, o_orderkey % 7 <> 0 AS printed, o_orderkey % 3 <> 2 AS real FROM orders),
g AS (SELECT f, bool_or(printed) AS read, bool_or(printed AND real) AS has_real FROM o GROUP BY f)
SELECT f AS file, i AS row_no, i % 4 <= 1 AS plain, CASE WHEN NOT read THEN 'no_source' WHEN NOT printed OR (has_real AND NOT real) THEN 'not_found' WHEN i % 5 = 0 THEN 'mismatched' ELSE 'matched' END AS status FROM o JOIN g USING (f) WHERE i % 4 <> 3
"""


def _balance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    names = F.get(F.array(*map(F.lit, ("cash_and_equivalents", "Receivables_net", "total_assets", "other"))), (i % 4).cast("int"))
    return _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file"), i.alias("row_no"), F.concat(F.lit("**Item "), i, F.lit("x**")).alias("source_item"), names.alias("canonical"), F.floor("o_totalprice").cast("double").alias("value"))


@query("qc_label_match", LABEL_MATCH_SQL)
def qc_label_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, i = _balance_rows(spark, sf_dir), F.col("row_no")
    shown = F.format_number(F.when(i % 5 == 0, F.col("value") + 1).otherwise(F.col("value")), 0)
    line = F.concat(F.lit("| item "), i, F.lit("X | 4 | "), F.when(i % 2 == 0, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown), F.lit(" | 99 |"))
    # every third page shows a composition; its lines count only where a filing has no other page
    pages = rows.where(i % 7 != 0).groupBy("file", (i % 3).alias("page")).agg(F.concat_ws("\n", F.sort_array(F.collect_list(line))).alias("text"))
    pages = pages.withColumn("text", F.concat(F.when(F.col("page") == 2, "Composition in %\n").otherwise("Rupees in thousand\n"), "text"))
    return records.qc_label_match(rows, pages).select("file", "row_no", "plain", "status")


SOURCE_BALANCE_SQL = """
WITH t AS (SELECT o_custkey AS f, arg_max(floor(o_totalprice), o_orderkey) FILTER (o_orderkey % 2 = 0) AS a, arg_max(floor(o_totalprice), o_orderkey) FILTER (o_orderkey % 2 = 1) AS b FROM orders GROUP BY 1)
SELECT f AS file, CAST(a AS DOUBLE) AS total_assets, CAST(b AS DOUBLE) AS other_side, abs(a - b) / b <= 0.05 AS balanced FROM t WHERE a IS NOT NULL AND b IS NOT NULL
"""


@query("source_balance", SOURCE_BALANCE_SQL)
def source_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _balance_rows(spark, sf_dir).withColumn("canonical", F.when(F.col("row_no") % 2 == 0, "total_assets").otherwise("total_equity_and_liabilities"))
    return records.source_balance(rows).select("file", "total_assets", "other_side", "balanced")


TOP_SQL = f"WITH g AS ({GATE_SQL}) SELECT split_part(row_id, '_', 4) AS part, count(*) AS n FROM g GROUP BY 1 ORDER BY n DESC, part LIMIT 10"


@query("top_issue_parts", TOP_SQL)
def top_issue_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.top_counts(_gate(spark, sf_dir).select(F.split("row_id", "_")[3].alias("part")), "part")


LABELS_SQL = """
WITH l AS (SELECT l_suppkey AS k, l_returnflag AS field, CASE WHEN l_linestatus = 'O' THEN '' ELSE l_shipdate::DATE::VARCHAR END AS label, lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS f FROM lineitem)
SELECT k AS ticker, field, arg_min(label, (f, label)) AS label FROM l WHERE label <> '' GROUP BY ALL
"""


@query("first_labels", LABELS_SQL)
def first_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("ticker"), F.lit("c").alias("section"), F.col("l_returnflag").alias("field"), F.when(F.col("l_linestatus") == "O", "").otherwise(F.to_date("l_shipdate").cast("string")).alias("source_item"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("source_file"))
    return facts.first_labels(rows).select("ticker", "field", "label")


INCOME_SQL = """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'net_interest_income' WHEN 'MACHINERY' THEN 'net_premium' ELSE 'revenue_net' END AS income FROM customer
"""


@query("income_field", INCOME_SQL)
def income_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("c_mktsegment")
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.when(s == "BUILDING", "Banking").when(s == "MACHINERY", "Insurance").when(s == "FURNITURE", "Cement").alias("industry"))
    return rows.select("c_custkey", qc.income_field(F.col("industry")).alias("income"))


SCOPE_SQL = "SELECT o_orderkey FROM orders WHERE o_custkey % 10 = 3 AND year(o_orderdate) = 1997 AND o_orderkey % 2 = 0"


@query("in_scope", SCOPE_SQL)
def in_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 10).cast("string").alias("ticker"), F.to_date("o_orderdate").alias("period_end"), F.when(F.col("o_orderkey") % 2 == 0, 12).otherwise(3).alias("months"))
    return quarters.in_scope(rows, "3", 1997, annual_only=True).select("o_orderkey")
