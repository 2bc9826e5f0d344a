"""Statement queries: quarters, sources, checks and facts on orders, customers and line items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import number, once
from ..operators import cells, facts, periods, qc, quarters
from .catalog import dealt, query


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's nation as ticker and market segment as section."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).select("*", F.col("c_nationkey").alias("n"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"))


#: Which periods of a year are kept, by (nation + 3 * year) mod 8, so that every method occurs.
KEPT = ("d1 c6 c9 c12", "d1 d2 d3 c12", "d1 d3 c9 c12", "d1 d2 c9 c12", "c6 d3 c12", "d1 c6 c9", "d1 d2 c9", "d1 d2 d3 d4 c12")
METHODS = (
    "direct_3M 6M-Q1 9M-6M 12M-9M", "direct_3M direct_3M direct_3M 12M-Q1-Q2-Q3", "direct_3M 9M-Q1-Q3 direct_3M 12M-9M", "direct_3M direct_3M 9M-Q1-Q2 12M-9M",
    "- - direct_3M 12M-6M-Q3", "direct_3M 6M-Q1 9M-6M -", "direct_3M direct_3M 9M-Q1-Q2 -", "direct_3M direct_3M direct_3M direct_3M",
)


def cumulative(spark: SparkSession, sf_dir: str, thin: bool = True) -> DataFrame:
    """3-, 6-, 9- and 12-month sums of orders and their number, some periods left out."""
    spans = {"d1": (1, 1), "d2": (2, 2), "d3": (3, 3), "d4": (4, 4), "c6": (1, 2), "c9": (1, 3), "c12": (1, 4)}
    price = F.col("o_totalprice").cast("decimal(18,2)")
    aggs = [f(F.when(F.col("q").between(a, b), x)).cast("double").alias(f"{s}_{n}") for s, (a, b) in spans.items() for n, f, x in (("revenue_net", F.sum, price), ("n_orders", F.count, F.lit(1)))]
    year = _orders(spark, sf_dir).groupBy(F.col("n").cast("string").alias("ticker"), F.col("c_mktsegment").alias("section"), "n", "y").agg(*aggs)
    all_ = F.array(*(F.struct(F.lit(s).alias("slot"), F.lit(3 * (b - a + 1)).alias("months"), F.last_day(F.make_date("y", F.lit(3 * b), F.lit(1))).alias("period_end"), F.lit(n).alias("field"), F.col(f"{s}_{n}").alias("value")) for s, (a, b) in spans.items() for n in ("revenue_net", "n_orders")))
    kept = F.get(F.array(*(F.array(*map(F.lit, k.split())) for k in KEPT)), F.pmod(F.col("n") + 3 * F.col("y"), F.lit(8)).cast("int"))
    rows = year.select("ticker", "section", "n", "y", F.explode(F.filter(all_, lambda p: F.array_contains(kept, p["slot"])) if thin else all_).alias("p")).select("ticker", "section", "n", "y", "p.*")
    return rows.withColumn("source_file", F.concat_ws("_", "ticker", "slot", "y"))


_YEAR = "WITH o AS (SELECT c_nationkey AS n, c_mktsegment AS section, year(o_orderdate) AS y, quarter(o_orderdate) AS q, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders JOIN customer ON o_custkey = c_custkey)"
_METHOD_ROWS = ", ".join(f"({p}, {q}, '{m}')" for p, row in enumerate(METHODS) for q, m in enumerate(row.split(), 1) if m != "-")

DERIVE_SQL = f"""{_YEAR},
g AS (SELECT n, section, y FROM o GROUP BY ALL),
m(p, q, method) AS (VALUES {_METHOD_ROWS}),
s AS (SELECT n, section, y, q, sum(price) AS revenue_net, count(*) AS n_orders FROM o GROUP BY ALL),
x AS (SELECT g.*, m.q, m.method FROM g JOIN m ON (g.n + 3 * g.y) % 8 = m.p),
v AS (SELECT x.*, f.field, CASE WHEN f.field = 'n_orders' THEN coalesce(s.n_orders, 0) ELSE CAST(s.revenue_net AS DOUBLE) END AS value FROM x CROSS JOIN (VALUES ('revenue_net'), ('n_orders')) f(field) LEFT JOIN s USING (n, section, y, q))
SELECT CAST(n AS VARCHAR) AS ticker, section, CAST(y AS INTEGER) AS fiscal_year, 'Q' || q AS quarter, method, field, round(coalesce(value, 0), 2) AS value FROM v
"""


@query("derive_quarters", DERIVE_SQL)
def derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("ticker"), F.lit(12).alias("fiscal_month"))
    out = quarters.derive_quarters(cumulative(spark, sf_dir).withColumn("value", F.coalesce("value", F.lit(0.0))), companies)
    return out.select("ticker", "section", "fiscal_year", "quarter", "method", "field", F.round("value", 2).alias("value"))


YEAR_SQL = f"""{_YEAR},
s AS (SELECT n, section, y, sum(price) AS total, count(DISTINCT q) AS nq FROM o GROUP BY ALL)
SELECT CAST(n AS VARCHAR) AS ticker, section, CAST(y AS INTEGER) AS fiscal_year, round(CAST(total AS DOUBLE), 2) AS actual, round(CAST(total AS DOUBLE) * 1.2, 2) AS expected
FROM s WHERE (n + y) % 5 = 0 AND nq = 4
"""


@query("qc_year_arithmetic", YEAR_SQL)
def year_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("ticker"), F.lit(12).alias("fiscal_month"))
    rows = cumulative(spark, sf_dir, thin=False)
    rows = rows.withColumn("value", F.when((F.col("months") == 12) & (F.pmod(F.col("n") + F.col("y"), F.lit(5)) == 0), F.col("value") * 1.2).otherwise(F.col("value")))
    direct = quarters.derive_quarters(rows.where("months = 3"), companies)
    out = quarters.qc_year_arithmetic(direct, rows, companies, fields=("revenue_net",))
    return out.select("ticker", "section", "fiscal_year", F.round("actual", 2).alias("actual"), F.round("expected", 2).alias("expected"))


BEST_SQL = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, source_type FROM (
  SELECT *, CASE WHEN cur THEN 'primary' WHEN n = 1 THEN 'prior_year' ELSE 'prior_year_fallback' END AS source_type,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CASE WHEN cur AND ok THEN 0 WHEN ok THEN 1 WHEN cur THEN 2 ELSE 3 END, score DESC, l_shipdate DESC, file) AS r
  FROM (SELECT *, l_returnflag <> 'R' AS cur, l_linestatus = 'F' AS ok, CAST(round(l_discount * 100) AS INTEGER) AS score, l_suppkey || '_' || l_partkey || '_' || l_quantity::INTEGER AS file, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)) WHERE r = 1
"""


@query("select_best_source", BEST_SQL)
def best_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", (F.col("l_returnflag") != "R").alias("current"), (F.col("l_linestatus") == "F").alias("qc_pass"), F.round(F.col("l_discount") * 100).cast("int").alias("score"), F.col("l_shipdate").alias("filing_date"), F.concat_ws("_", "l_suppkey", "l_partkey", F.col("l_quantity").cast("int")).alias("source_file"))
    return periods.select_best_source(li, ("l_orderkey", "l_linenumber")).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "source_type")


BALANCES_SQL = """
WITH c AS (SELECT l_partkey AS k, CAST(month(l_shipdate) AS INTEGER) AS m, l_returnflag <> 'R' AS cur, CASE WHEN l_linenumber <> 3 THEN l_linestatus = 'F' ELSE false END AS ok, l_orderkey || '_' || l_linenumber || '_' || l_suppkey || '_' || l_quantity::INTEGER AS file FROM lineitem),
n AS (SELECT *, count(*) OVER (PARTITION BY k, m) AS n, row_number() OVER (PARTITION BY k, m ORDER BY NOT ok, NOT cur, file) AS passed, row_number() OVER (PARTITION BY k, m ORDER BY NOT cur, file) AS any_one, bool_or(ok) OVER (PARTITION BY k, m) AS any_ok FROM c)
SELECT k AS l_partkey, m AS month, file AS source_file, CASE WHEN cur THEN 'primary' WHEN n > 1 AND any_ok THEN 'prior_year_fallback' ELSE 'prior_year' END AS source_type FROM n WHERE CASE WHEN any_ok THEN passed ELSE any_one END = 1
"""


@query("select_best_balance", BALANCES_SQL)
def best_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.when(F.col("l_linenumber") != 3, F.col("l_linestatus") == "F")
    li = _t(spark, sf_dir, "lineitem").select("l_partkey", F.month("l_shipdate").alias("month"), (F.col("l_returnflag") != "R").alias("current"), ok.alias("qc_pass"), F.concat_ws("_", "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").cast("int")).alias("source_file"))
    return periods.select_best_balance(li, ("l_partkey", "month")).select("l_partkey", "month", "source_file", "source_type")


REPEATS_SQL = """
SELECT l_orderkey, l_linenumber, row_id, first_row FROM (
  SELECT l_orderkey, l_linenumber, row_id, row_number() OVER w AS n, first_value(row_id) OVER w AS first_row
  FROM (SELECT CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey, l_linenumber, l_suppkey || '|' || l_partkey || '|' || l_extendedprice::DECIMAL(12,2) || '|' || l_shipdate::DATE AS row_id FROM lineitem)
  WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY row_id)) WHERE n > 1
"""


@query("repeated_rows", REPEATS_SQL)
def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("l_orderkey") % 11 != 0, F.col("l_orderkey"))
    rows = _t(spark, sf_dir, "lineitem").select(key.alias("l_orderkey"), "l_linenumber", F.concat_ws("|", "l_suppkey", "l_partkey", F.col("l_extendedprice").cast("decimal(12,2)"), F.to_date("l_shipdate")).alias("row_id"))
    return periods.repeats(rows, ("l_orderkey", "l_linenumber"), "row_id")


# Wide statements: sums of a customer's year stand for fields; a rule on the keys breaks some.

_FACTS = "WITH v AS (SELECT o_custkey AS k, year(o_orderdate) AS y, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s, count(*) AS n FROM orders GROUP BY ALL)"


def _year_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("s"), F.count("*").alias("n"))


def _long(df: DataFrame, **fields: Column) -> DataFrame:
    """Fields as rows of period values; null columns stay absent."""
    cells_ = F.array(*(F.struct(F.lit(f).alias("field"), v.cast("double").alias("value")) for f, v in fields.items()))
    return df.select(F.col("k").cast("string").alias("ticker"), F.lit("consolidated").alias("section"), F.make_date("y", F.lit(12), F.lit(31)).alias("period_end"), F.lit(12).alias("months"), F.explode(F.filter(cells_, lambda c: c["value"].isNotNull())).alias("c")).select("ticker", "section", "period_end", "months", "c.*")


PL_SQL = f"""{_FACTS},
w AS (SELECT *, s AS rev, -0.6 * s AS cogs, CASE WHEN k % 7 = 0 THEN 0.43 * s ELSE 0.4 * s END AS gross, 0.3 * s AS pbt, CASE k % 3 WHEN 0 THEN -0.1 * s END AS t_total, CASE WHEN k % 3 = 1 THEN -0.06 * s END AS t_cur, CASE WHEN k % 3 = 1 THEN -0.03 * s END AS t_def FROM v),
x AS (SELECT *, pbt + coalesce(t_total, t_cur + t_def, 0) AS net0 FROM w),
z AS (SELECT *, CASE WHEN k % 5 = 0 THEN net0 * 1.5 ELSE net0 END AS net FROM x),
c AS (SELECT k, y, 'gross_profit' AS "check", gross AS actual, rev + cogs AS expected FROM z UNION ALL SELECT k, y, 'net_profit_tax', net, net0 FROM z)
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year, "check", CASE WHEN abs(actual - expected) / greatest(abs(actual), abs(expected), 1) < 0.10 THEN 'warning' ELSE 'error' END AS severity, round(actual, 1) AS actual
FROM c WHERE abs(actual - expected) / greatest(abs(actual), abs(expected), 1) > 0.05
"""


@query("qc_pl_equations", PL_SQL)
def pl_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("s"), F.col("k")
    df = _year_sums(spark, sf_dir).withColumns({"t": F.when(k % 3 == 0, -0.1 * s), "tc": F.when(k % 3 == 1, -0.06 * s), "td": F.when(k % 3 == 1, -0.03 * s)})
    net = 0.3 * s + F.coalesce(F.col("t"), F.col("tc") + F.col("td"), F.lit(0.0))
    long = _long(df, revenue_net=s, cost_of_goods_sold=-0.6 * s, gross_profit=F.when(k % 7 == 0, 0.43 * s).otherwise(0.4 * s), profit_before_tax=0.3 * s, taxation_total=F.col("t"), taxation_current=F.col("tc"), taxation_deferred=F.col("td"), net_profit=F.when(k % 5 == 0, net * 1.5).otherwise(net))
    return qc.pl_equations(long).select("ticker", F.year("period_end").alias("year"), "check", "severity", F.round("actual", 1).alias("actual"))


BS_SQL = f"""{_FACTS}
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year,
  CASE WHEN k % 11 = 0 THEN 'skip' WHEN k % 11 = 1 THEN 'fail' WHEN k % 11 = 2 THEN 'fail' WHEN k % 11 = 4 THEN 'fail' ELSE 'pass' END AS status,
  CASE WHEN k % 11 = 0 THEN 'no_assets' WHEN k % 11 = 1 THEN 'assets' WHEN k % 11 = 2 THEN 'parts' WHEN k % 11 = 3 THEN 'parts' WHEN k % 11 = 4 THEN 'assets_parts' ELSE 'total' END AS "check"
FROM v
"""


@query("qc_bs_equation", BS_SQL)
def bs_equation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, m = F.col("s"), F.col("k") % 11
    long = _long(_year_sums(spark, sf_dir), total_assets=F.when(m != 0, s), total_equity=F.when(m.isin(2, 4), 0.1 * s).otherwise(0.4 * s), total_liabilities=0.6 * s, total_equity_and_liabilities=F.when(m == 1, 1.5 * s).when(~m.isin(3, 4), s))
    return qc.bs_equation(long).select("ticker", F.year("period_end").alias("year"), "status", "check")


CF_SQL = f"""{_FACTS}
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year, CASE k % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE '' END AS pattern, CAST(CASE k % 4 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE 2 END AS INTEGER) AS n_passed FROM v
"""


@query("qc_cf_patterns", CF_SQL)
def cf_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, m = F.col("s"), F.col("k") % 4
    fx = 0.2 * s
    net = F.when(m == 0, 0.5 * s).when(m == 1, 0.5 * s + fx).when(m == 2, 0.5 * s).otherwise(2 * s)
    end = F.when(m == 0, s + net + fx).when(m == 1, s + net).otherwise(9 * s)
    long = _long(_year_sums(spark, sf_dir), cfo=s, cfi=-0.4 * s, cff=-0.1 * s, net_cash_change=net, fx_adjustment=fx, cash_start=s, cash_end=end)
    return qc.cf_patterns(long).select("ticker", F.year("period_end").alias("year"), "pattern", "n_passed")


OUTLIER_SQL = """
WITH v AS (SELECT c_nationkey AS n, c_mktsegment AS section, o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice * 1000 ELSE o_totalprice END AS value FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT n, section, median(value) AS med FROM v GROUP BY ALL HAVING count(*) >= 3)
SELECT CAST(n AS VARCHAR) AS ticker, section, o_orderkey, round(value, 2) AS size FROM v JOIN m USING (n, section) WHERE value / med > 100 OR value / med < 0.01
"""


@query("qc_cross_period", OUTLIER_SQL)
def cross_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("o_orderkey") % 97 == 0, F.col("o_totalprice") * 1000).otherwise(F.col("o_totalprice"))
    rows = _orders(spark, sf_dir).select(F.col("n").cast("string").alias("ticker"), F.col("c_mktsegment").alias("section"), F.lit("revenue_net").alias("field"), F.to_date("o_orderdate").alias("period_end"), F.col("o_orderkey").alias("months"), price.alias("value"))
    return qc.outliers(rows, ("revenue_net", "net_profit", "gross_profit")).select("ticker", "section", F.col("months").alias("o_orderkey"), F.round("size", 2).alias("size"))


COMPARE_SQL = f"""{_FACTS},
c AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'net_profit' ELSE 'other_costs' END AS field, s * CASE k % 9 WHEN 0 THEN 1.05 WHEN 1 THEN 1.3 WHEN 2 THEN 700 WHEN 3 THEN 3000 WHEN 4 THEN 20000 WHEN 5 THEN -20 WHEN 6 THEN -1.5 WHEN 7 THEN 5 ELSE 0 END AS value FROM v),
d AS (SELECT *, abs(value - s) / abs(s) AS off, abs(value) / s AS r FROM c)
SELECT CAST(k AS VARCHAR) AS ticker, CAST(y AS INTEGER) AS year, field, round(off, 4) AS off,
  CASE WHEN field = 'other_costs' THEN 'RESTATEMENT' WHEN value = 0 THEN 'ZERO_VALUE' WHEN r > 500 AND r < 2000 THEN 'UNIT_MISMATCH' WHEN r > 10000 THEN 'OCR_ERROR' WHEN r > 2000 THEN 'WRONG_PAGE' WHEN value < 0 AND r > 10 THEN 'SIGN_ERROR' WHEN value < 0 THEN 'RESTATEMENT' WHEN r > 2 THEN 'EXTRACTION_ERROR' ELSE 'RESTATEMENT' END AS category
FROM d WHERE off > CASE WHEN field = 'net_profit' THEN 0.15 ELSE 0.25 END
"""


@query("compare_comparatives", COMPARE_SQL)
def compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, m = F.col("s"), F.col("k") % 9
    factor = F.when(m == 0, 1.05).when(m == 1, 1.3).when(m == 2, 700.0).when(m == 3, 3000.0).when(m == 4, 20000.0).when(m == 5, -20.0).when(m == 6, -1.5).when(m == 7, 5.0).otherwise(0.0)
    base = _year_sums(spark, sf_dir).select(F.col("k").cast("string").alias("ticker"), F.col("y").alias("year"), F.when(F.col("k") % 2 == 0, "net_profit").otherwise("other_costs").alias("field"), "s", (s * factor).alias("c"), F.when(F.col("k") % 4 == 0, "thousands").otherwise("rupees").alias("u"))
    comp = base.select("ticker", "year", "field", F.lit("rupees").alias("unit_type"), F.col("c").alias("value"))
    alone = base.select("ticker", "year", "field", F.col("u").alias("unit_type"), F.when(F.col("u") == "thousands", s / 1000).otherwise(s).alias("value"))
    return qc.compare_comparatives(comp, alone, ("ticker", "year")).select("ticker", "year", "field", F.round("off", 4).alias("off"), "category")


MISSING_SQL = """
WITH y AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) AS y FROM orders),
g AS (SELECT k, unnest(range(min(y), max(y) + 1)) AS y FROM y GROUP BY k)
SELECT CAST(g.k AS VARCHAR) AS ticker, CAST(g.y AS INTEGER) AS year FROM g ANTI JOIN y ON g.k = y.k AND g.y = y.y
"""


@query("missing_years", MISSING_SQL)
def missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("ticker"), F.lit("").alias("section"), F.to_date("o_orderdate").alias("period_end"))
    return qc.missing_years(rows).select("ticker", "year")


MONO_SQL = f"""{_YEAR},
s AS (SELECT n, section, y, m, sum(price) FILTER (q * 3 <= m) AS total FROM o CROSS JOIN (VALUES (3), (6), (9), (12)) d(m) GROUP BY n, section, y, m),
p AS (SELECT *, CAST(total AS DOUBLE) * CASE WHEN m = 9 AND (n + y) % 4 = 0 THEN 0.01 ELSE 1 END AS value FROM s),
l AS (SELECT *, lag(value) OVER w AS previous, lag(m) OVER w AS pm FROM p WHERE value IS NOT NULL WINDOW w AS (PARTITION BY n, section, y ORDER BY m))
SELECT CAST(n AS VARCHAR) AS ticker, section, CAST(y AS INTEGER) AS fiscal_year, CAST(pm AS INTEGER) AS previous_months, CAST(m AS INTEGER) AS months, round(CAST(value AS DOUBLE), 2) AS value FROM l WHERE value < previous
"""


@query("qc_monotonicity", MONO_SQL)
def monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cumulative(spark, sf_dir, thin=False).where("field = 'revenue_net' AND slot IN ('d1', 'c6', 'c9', 'c12') AND value IS NOT NULL")
    rows = rows.withColumn("value", F.when((F.col("months") == 9) & (F.pmod(F.col("n") + F.col("y"), F.lit(4)) == 0), F.col("value") * 0.01).otherwise(F.col("value")))
    return qc.monotonicity(rows, ("revenue_net",)).select("ticker", "section", "fiscal_year", "previous_months", "months", F.round("value", 2).alias("value"))


GAPS_SQL = """
WITH h AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders),
i AS (SELECT k, CASE WHEN k % 3 = 0 AND count(*) FILTER (m IN (9, 12)) = 0 AND count(*) FILTER (m = 6) > 0 THEN 12 WHEN k % 3 = 0 THEN 6 WHEN k % 2 = 0 THEN 6 ELSE 12 END AS fm FROM h GROUP BY k),
l AS (SELECT k, y, max(m) AS latest FROM h WHERE y IN (1999, 2000) GROUP BY ALL),
g AS (SELECT l.*, q, fm FROM l JOIN i USING (k) CROSS JOIN (VALUES (3), (6), (9), (12)) c(q) WHERE q < latest AND q <> fm)
SELECT CAST(g.k AS VARCHAR) AS ticker, last_day(make_date(g.y, q, 1)) AS period_end FROM g ANTI JOIN h ON g.k = h.k AND g.y = h.y AND g.q = h.m
"""


@query("filing_gaps", GAPS_SQL)
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.records import filing_gaps

    rows = _t(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("ticker"), F.to_date("o_orderdate").alias("period_end"))
    companies = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("ticker"), F.when(F.col("c_custkey") % 3 != 0, F.when(F.col("c_custkey") % 2 == 0, 6).otherwise(12)).alias("fiscal_month"))
    return filing_gaps(rows, companies, (1999, 2000))


GATE_SQL = """
WITH f AS (SELECT l_orderkey || '_' || l_linenumber || '_' || l_suppkey || '_' || l_partkey || '_' || l_shipdate::DATE AS row_id, CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_orderkey END AS ticker, l_linenumber AS d,
  CASE WHEN l_partkey % 40 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN -l_extendedprice WHEN l_partkey % 43 = 0 THEN l_extendedprice * 1e7 ELSE l_extendedprice END AS value FROM lineitem)
SELECT row_id, 'missing_field' AS type, 'ticker' AS field FROM f WHERE ticker IS NULL
UNION ALL SELECT row_id, 'missing_field', 'value' FROM f WHERE value IS NULL
UNION ALL SELECT row_id, 'too_large', 'revenue_net' FROM f WHERE abs(value) > 1e10
UNION ALL SELECT row_id, 'unexpected_negative', 'revenue_net' FROM f WHERE value < 0 AND abs(value) > 1
UNION ALL SELECT row_id, 'duplicate', 'revenue_net' FROM (SELECT row_id, row_number() OVER (PARTITION BY ticker, d ORDER BY row_id) AS n FROM f) WHERE n > 1
"""


def _gate(spark: SparkSession, sf_dir: str, gate: Callable[..., DataFrame] = qc.gate_facts) -> DataFrame:
    part, price = F.col("l_partkey"), F.col("l_extendedprice")
    value = F.when(part % 40 == 0, None).when(part % 41 == 0, -price).when(part % 43 == 0, price * 1e7).otherwise(price)
    rows = _t(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.to_date("l_shipdate")).alias("row_id"), F.when(F.col("l_orderkey") % 50 != 0, F.col("l_orderkey")).cast("string").alias("ticker"), F.lit("2020-12-31").alias("period_end"), F.col("l_linenumber").alias("period_duration"), F.lit("c").alias("section"),
        F.lit("revenue_net").alias("canonical_field"), F.lit("r").alias("original_name"), F.lit("pl").alias("statement_type"), F.lit("thousands").alias("unit_type"), F.lit("").alias("qc_flag"), value.alias("value"),
    )
    return gate(rows, "row_id", "pl")


@query("gate_facts", GATE_SQL)
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir)


SUMMARY_SQL = f"""
WITH i AS ({GATE_SQL}), j AS (SELECT split_part(row_id, '_', 2) AS line, type FROM i)
SELECT line, type, count(*) AS n, CAST(grouping(line, type) AS INTEGER) AS level FROM j GROUP BY GROUPING SETS ((line, type), (type), ())
"""


@query("issue_summary", SUMMARY_SQL)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.summarise_issues(_gate(spark, sf_dir).select(F.split("row_id", "_")[1].alias("line"), "type"), "line")


UNITS_SQL = """
WITH c AS (SELECT o_custkey % 100 AS ticker, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE o_orderpriority END AS unit_type, count(*) AS n_files FROM orders GROUP BY ALL),
m AS (SELECT *, first_value(unit_type) OVER (PARTITION BY ticker ORDER BY n_files DESC, unit_type) AS majority FROM c)
SELECT *, unit_type <> majority AS is_outlier FROM m
"""


@query("unit_context", UNITS_SQL)
def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("ticker"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("unit_type"))
    return qc.unit_context(rows)


NUMBERS_SQL = """
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 0.0 WHEN 2 THEN round(c_acctbal, 2) WHEN 3 THEN -abs(round(c_acctbal, 2)) WHEN 4 THEN round(c_acctbal, 2) ELSE NULL END AS value FROM customer
"""


@query("number_text", NUMBERS_SQL)
def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, k = F.round("c_acctbal", 2), F.col("c_custkey") % 6
    shown = F.format_number(F.abs(v), 2)
    text = F.when(k == 0, " N/A").when(k == 1, "—").when(k == 2, F.when(v < 0, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown)).when(k == 3, F.concat(F.lit("**$ "), shown, F.lit("-**"))).when(k == 4, F.when(v < 0, F.concat(F.lit("-"), shown)).otherwise(shown)).otherwise(F.concat(shown, F.lit("d")))
    return _t(spark, sf_dir, "customer").select("c_custkey", cells.qc_number(text).alias("value"))


FORMULA_SQL = """
WITH l AS (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey AS k, l_linenumber AS i, CAST(round(l_extendedprice) AS BIGINT) AS v FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey),
t AS (SELECT k, sum(CASE WHEN i % 3 = 0 THEN -v ELSE v END) AS s FROM l GROUP BY k)
SELECT 'F' || k AS file, CAST(col AS INTEGER) AS col_no, CAST(s AS DOUBLE) AS expected, CAST(CASE WHEN k % 5 = 0 AND col = 1 THEN s + 200000 ELSE s END AS DOUBLE) AS actual, abs(CASE WHEN k % 5 = 0 AND col = 1 THEN 200000 ELSE 0 END) <= 0.05 * abs(CASE WHEN k % 5 = 0 AND col = 1 THEN s + 200000 ELSE s END) AS ok
FROM t CROSS JOIN (VALUES (0), (1)) c(col)
"""


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipe table for each order: its lines, and a total whose formula adds them, every third one negative."""
    # dealt out by order once: few bytes, but much to render and to parse
    lines = dealt(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey"), "l_orderkey")
    first = periods.pick(lines, ("l_orderkey", "l_linenumber"), "l_extendedprice", "l_partkey", "l_suppkey")
    rows = first.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), F.round("l_extendedprice").cast("bigint").alias("v"))
    letter = F.chr(64 + F.col("i"))
    shown = F.format_number("v", 0)
    line = F.concat(F.lit("| Item "), F.col("i"), F.lit(" | **line_"), F.col("i"), F.lit("** | "), letter, F.lit(" | "), shown, F.lit(" | "), shown, F.lit(" |"))
    signed = F.when(F.col("i") % 3 == 0, -F.col("v")).otherwise(F.col("v"))
    g = rows.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("i", line.alias("line"), F.concat(F.when(F.col("i") % 3 == 0, "-").otherwise("+"), letter).alias("term")))).alias("ls"), F.sum(signed).alias("s"))
    num = lambda x: F.when(x < 0, F.concat(F.lit("("), F.format_number(-x, 0), F.lit(")"))).otherwise(F.format_number(x, 0))
    total = F.concat(F.lit("| Total | total | Z="), F.array_join(F.transform("ls", lambda x: x["term"]), ""), F.lit(" | "), num(F.col("s")), F.lit(" | "), num(F.when(F.col("k") % 5 == 0, F.col("s") + 200000).otherwise(F.col("s"))), F.lit(" |"))
    head = F.lit("UNIT_TYPE: thousands\n## CONSOLIDATED\n| Source Item | Canonical | Ref | 12M Dec 2024 | 12M Dec 2023 |\n|:---|:---|:---|---:|---:|\n")
    return g.select(F.concat(F.lit("F"), F.col("k")).alias("file"), once(text=F.concat(head, F.array_join(F.transform("ls", lambda x: x["line"]), "\n"), F.lit("\n"), total)))


@query("qc_formulas", FORMULA_SQL)
def formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.table_formulas(rendered(spark, sf_dir)).select("file", "col_no", "expected", "actual", "ok")


CELLS_SQL = """
WITH l AS (SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey AS k, l_linenumber AS i, CAST(round(l_extendedprice) AS BIGINT) AS v FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey)
SELECT 'F' || k AS file, 'Item ' || i AS source_item, 'line_' || i AS canonical, chr(CAST(64 + i AS INTEGER)) AS ref, h AS col_header, CAST(v AS DOUBLE) AS value, 'thousands' AS unit_type FROM l CROSS JOIN (VALUES ('12M Dec 2024'), ('12M Dec 2023')) c(h)
"""


@query("extraction_cells", CELLS_SQL)
def extraction_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = cells.parse_cells(rendered(spark, sf_dir)).where("canonical <> 'total'")
    return parsed.select("file", "source_item", "canonical", "ref", "col_header", cells.qc_number(F.col("raw")).alias("value"), "unit_type")


MATCH_SQL = """
WITH v AS (SELECT DISTINCT o_custkey AS k, abs(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.004 WHEN 2 THEN 1000.0 ELSE 1.3 END) AS value FROM orders WHERE abs(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.004 WHEN 2 THEN 1000.0 ELSE 1.3 END) > 1000),
s AS (SELECT DISTINCT o_custkey AS k, o_totalprice AS source FROM orders),
j AS (SELECT v.k, v.value, bool_or(abs(value - source) / source <= 0.005) AS e, bool_or((value / source > 990 AND value / source < 1010) OR (value / source > 0.00099 AND value / source < 0.00101)) AS t FROM v LEFT JOIN s USING (k) GROUP BY ALL)
SELECT k AS file, round(value, 2) AS value, CASE WHEN e THEN 'exact' WHEN t THEN 'thousand' ELSE 'none' END AS match FROM j
"""


@query("match_source", MATCH_SQL)
def match_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, m = _t(spark, sf_dir, "orders"), F.col("o_orderkey") % 4
    value = F.col("o_totalprice") * F.when(m == 0, 1.0).when(m == 1, 1.004).when(m == 2, 1000.0).otherwise(1.3)
    v = o.select(F.col("o_custkey").alias("file"), value.alias("value"))
    return cells.match_source(v, o.select(F.col("o_custkey").alias("file"), F.col("o_totalprice").alias("number"))).select("file", F.round("value", 2).alias("value"), "match")


FLAT_SQL = f"""{_YEAR},
s AS (SELECT n, section, y, sum(price) AS total FROM o GROUP BY n, section, y),
v AS (SELECT *, CAST(total AS DOUBLE) * CASE WHEN n % 6 = 0 THEN -1 ELSE 1 END AS value FROM s)
SELECT CAST(n AS VARCHAR) AS ticker, n_name AS company_name, section, CAST(y AS INTEGER) AS fiscal_year, 'annual' AS period_type, round(value / CASE WHEN n % 5 = 3 THEN 1 ELSE 1000 END, 3) AS value,
  CASE WHEN n % 6 = 0 AND y = 1997 THEN 'unexpected_negative: known' WHEN n % 6 = 0 THEN 'unexpected_negative' WHEN y = 1997 THEN 'allowlisted: known' ELSE '' END AS qc_flag,
  CASE WHEN y % 2 = 0 THEN array_to_string([n % 5, n % 5 + 7], ',') ELSE '' END AS source_pages, 'u/' || n || '/' || y || '/' || n || '_Annual_' || y AS source_url
FROM v JOIN nation ON n = n_nationkey
"""


@query("flatten_facts", FLAT_SQL)
def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cumulative(spark, sf_dir, thin=False).where("months = 12 AND field = 'revenue_net'").select("ticker", "section", F.col("y").alias("fiscal_year"), "period_end", "months", F.when(F.col("n") % 5 == 3, "full_rupees").otherwise("rupees").alias("unit_type"), F.concat_ws("_", "ticker", F.lit("annual"), "y", "section").alias("source_file"), F.lit(None).cast("string").alias("source_item"), "field", F.when(F.col("n") % 6 == 0, -F.col("value")).otherwise(F.col("value")).alias("value"))
    none = rows.where(F.lit(False)).select("ticker", "section", "fiscal_year", "period_end", F.lit("").alias("method"), F.lit("").alias("source"), "source_item", "field", "value")
    companies = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("ticker"), F.col("n_name").alias("company_name"), F.lit("x").alias("industry"))
    allow = rows.where("fiscal_year = 1997").select("ticker", "fiscal_year", "section", F.lit("known").alias("reason")).distinct()
    of = rows.where("fiscal_year % 2 = 0").select("ticker", F.concat(F.lit("annual_"), "fiscal_year").alias("period_key"), "section", F.lit("PL").alias("stmt"), (F.col("ticker").cast("int") % 5).alias("page"))
    manifest = of.unionByName(of.withColumn("page", F.col("page") + 7))
    out = facts.flatten_facts(none, rows, companies, "pl", ("revenue_net",), allow, manifest, "u")
    return out.select("ticker", "company_name", "section", "fiscal_year", "period_type", F.round("value", 3).alias("value"), "qc_flag", F.array_join("source_pages", ",").alias("source_pages"), "source_url")


OFF_SQL = f"""{_YEAR.replace("quarter(o_orderdate) AS q", "quarter(o_orderdate) AS q, month(o_orderdate) AS m")},
s AS (SELECT n, section, y, sum(price) FILTER (q = 1) AS q1, sum(price) FILTER (q = 2) AS q2, coalesce(sum(price) FILTER (q < 3), 0) AS h1, coalesce(sum(price) FILTER (m <= 8), 0) AS m8, coalesce(sum(price) FILTER (m <= 5), 0) AS m5 FROM o GROUP BY ALL),
r AS (SELECT n, section, y, 'Q1' AS quarter, make_date(y, 3, 31) AS period_end, 'direct_3M' AS method, coalesce(q1, 0) AS value FROM s
  UNION ALL SELECT n, section, y, 'Q3', make_date(y, 8, 31), CASE WHEN n % 2 = 0 THEN '9M-6M' ELSE '9M-Q1-Q2' END, CASE WHEN n % 2 = 0 THEN m8 - h1 ELSE m8 - coalesce(q1, 0) - coalesce(q2, 0) END FROM s WHERE n % 4 <> 3
  UNION ALL SELECT n, section, y, 'Q3', make_date(y, 8, 31), 'direct_3M', m8 FROM s WHERE n % 4 = 3
  UNION ALL SELECT n, section, y, 'Q2', make_date(y, 5, 31), '6M-Q1', m5 - coalesce(q1, 0) FROM s WHERE n % 3 = 0
  UNION ALL SELECT n, section, y, 'Q2', make_date(y, 6, 30), CASE WHEN n % 2 = 0 THEN '6M-Q1' ELSE 'direct_3M' END, CASE WHEN n % 2 = 0 THEN h1 - coalesce(q1, 0) ELSE coalesce(q2, 0) END FROM s)
SELECT CAST(n AS VARCHAR) AS ticker, section, CAST(y AS INTEGER) AS fiscal_year, quarter, strftime(period_end, '%Y-%m-%d') AS period_end, method, round(CAST(value AS DOUBLE), 2) AS value FROM r
"""


@query("off_calendar_quarters", OFF_SQL)
def off_calendar_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years without annual figures whose 9 months end in August, some 6 months in May; a quarter that ends in August stands for itself."""
    o, m = _orders(spark, sf_dir).withColumn("m", F.month("o_orderdate")), F.col("m")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    spans = {"q1": (m <= 3, 3, 3), "q2": (m.between(4, 6), 6, 3), "h1": (m <= 6, 6, 6), "m8": (m <= 8, 8, 9), "m5": (m <= 5, 5, 6), "x8": (m <= 8, 8, 3)}
    sums = o.groupBy(F.col("n").cast("string").alias("ticker"), F.col("c_mktsegment").alias("section"), "n", "y").agg(*(F.coalesce(F.sum(F.when(c, price)), F.lit(0)).cast("double").alias(k) for k, (c, _, _) in spans.items()))
    n = F.col("n")
    kept = {"q1": F.lit(True), "q2": n % 2 == 1, "h1": n % 2 == 0, "m8": F.lit(True), "m5": n % 3 == 0, "x8": n % 4 == 3}
    rows = F.array_compact(F.array(*(F.when(kept[k], F.struct(F.last_day(F.make_date("y", F.lit(e), F.lit(1))).alias("period_end"), F.lit(l).alias("months"), F.col(k).alias("value"))) for k, (_, e, l) in spans.items())))
    periods_ = sums.select("ticker", "section", F.lit("revenue_net").alias("field"), F.explode(rows).alias("p")).select("ticker", "section", "field", "p.*")
    companies = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("ticker"), F.lit(12).alias("fiscal_month"))
    out = quarters.derive_quarters(periods_, companies)
    return out.select("ticker", "section", "fiscal_year", "quarter", F.col("period_end").cast("string").alias("period_end"), "method", F.round("value", 2).alias("value"))


ZEROS_SQL = """
WITH v AS (SELECT o_custkey AS k, o_orderkey AS i, o_custkey % 2 = 1 AS own, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_totalprice * CASE WHEN o_orderkey % 7 = 0 THEN 1000 ELSE 1 END END AS a FROM orders),
r AS (SELECT k, i, CASE WHEN own THEN 'revenue_net' ELSE 'net_profit' END AS field, abs(a) AS size FROM v),
c AS (SELECT k, count(*) AS n, count(*) FILTER (size <> 0) AS s, median(size) FILTER (size <> 0) AS m FROM r GROUP BY k HAVING count(*) >= 3 AND count(*) FILTER (size <> 0) >= 3)
SELECT r.k AS o_custkey, r.i AS o_orderkey, r.field, round(r.size / c.m, 4) AS ratio FROM r JOIN c USING (k) WHERE r.size <> 0 AND (r.size / c.m > 100 OR r.size / c.m < 0.01)
"""


@query("unit_outliers", ZEROS_SQL)
def unit_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zeros count among the values that make a field the reference, but not towards its median."""
    i, k = F.col("o_orderkey"), F.col("o_custkey")
    value = F.when(i % 3 == 0, 0.0).otherwise(F.col("o_totalprice") * F.when(i % 7 == 0, 1000).otherwise(1))
    rows = _t(spark, sf_dir, "orders").select(k.alias("o_custkey"), F.when(k % 2 == 1, "revenue_net").otherwise("net_profit").alias("field"), F.col("o_orderkey").alias("period_end"), F.lit(12).alias("months"), value.alias("value"))
    return qc.outliers(rows, ("revenue_net", "net_profit"), ("o_custkey",)).select("o_custkey", F.col("period_end").alias("o_orderkey"), "field", F.round("ratio", 4).alias("ratio"))
