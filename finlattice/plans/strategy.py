"""Queries over several filings or records at once, on line items and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import period_header
from ..operators import market, pages, records, strategy
from ..sources import readers
from .catalog import dealt, query
from .statements import _t, _YEAR, cumulative

CROSS_SQL = """
WITH v AS (SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_discount = 0 AND l_linenumber < 3 THEN 0 WHEN l_tax >= 0.07 THEN 1000 WHEN l_linenumber = 7 THEN -1 ELSE 1 END * l_quantity AS value FROM lineitem),
o AS (SELECT *, lag(abs(value)) OVER w AS b, lag(sign(value)) OVER w AS s, l_orderkey || '_' || l_linenumber || '_' || l_suppkey AS filing FROM v WINDOW w AS (PARTITION BY l_partkey, l_returnflag ORDER BY sign(value), abs(value), l_orderkey || '_' || l_linenumber || '_' || l_suppkey)),
g AS (SELECT *, sum(CASE WHEN b IS NULL OR s <> sign(value) OR abs(value) > b * 1.05 THEN 1 ELSE 0 END) OVER (PARTITION BY l_partkey, l_returnflag ORDER BY sign(value), abs(value), filing) AS g FROM o),
c AS (SELECT l_partkey, l_returnflag, g, count(*) AS size, min(abs(value)) AS least, any_value(sign(value)) AS sign FROM g GROUP BY ALL),
t AS (SELECT l_partkey, l_returnflag, sum(size) AS n FROM c GROUP BY ALL),
a AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY size DESC, least, sign DESC, g DESC) = 1)
SELECT g.l_partkey, g.l_returnflag, g.l_orderkey, g.l_linenumber, CAST(g.value AS DOUBLE) AS value, c.size AS group_size, CAST(a.least * a.sign AS DOUBLE) AS agreed,
  CASE WHEN t.n = 1 THEN 'single' WHEN g.g = a.g THEN 'agrees' WHEN c.sign = a.sign AND a.least > 0 AND c.least > 0 AND greatest(c.least / a.least, a.least / c.least) BETWEEN 900 AND 1100 THEN 'unit_error' ELSE 'differs' END AS status
FROM g JOIN c USING (l_partkey, l_returnflag, g) JOIN t USING (l_partkey, l_returnflag) JOIN a ON a.l_partkey = g.l_partkey AND a.l_returnflag = g.l_returnflag
"""


@query("cross_filing", CROSS_SQL)
def cross_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    factor = F.when((F.col("l_discount") == 0) & (F.col("l_linenumber") < 3), 0.0).when(F.col("l_tax") >= 0.07, 1000.0).when(F.col("l_linenumber") == 7, -1.0).otherwise(1.0)
    figures = li.select("l_partkey", "l_returnflag", "l_orderkey", "l_linenumber", F.concat_ws("_", "l_orderkey", "l_linenumber", "l_suppkey").alias("filing"), (factor * F.col("l_quantity") + 0.0).alias("value"))
    return strategy.cross_filing(figures, ("l_partkey", "l_returnflag")).drop("filing").withColumn("agreed", F.col("agreed") + 0.0)


TOTALS_SQL = """
WITH a AS (SELECT o_orderkey AS k, o_orderkey % 6 AS c, CAST(round(o_totalprice) AS BIGINT) AS a FROM orders),
b AS (SELECT *, a AS cfo, -(a % 1000) AS cfi, -(a % 77) AS cff, a % 5000 AS opening FROM a),
d AS (SELECT *, cfo + cfi + cff + CASE WHEN a % 11 = 0 THEN a // 5 ELSE 0 END AS net FROM b),
g AS (SELECT k, CASE WHEN c <> 5 THEN cfo END AS cfo, CASE WHEN c NOT IN (4, 5) THEN cfi END AS cfi, cff, opening, CASE WHEN c NOT IN (1, 3, 4) THEN net END AS net, CASE WHEN c NOT IN (2, 3) THEN opening + net END AS closing FROM d),
n AS (SELECT *, coalesce(net, closing - opening, cfo + cfi + cff) AS net2, CASE WHEN net IS NOT NULL THEN 'given' WHEN closing IS NOT NULL THEN 'closing' ELSE 'net_change' END AS net_by FROM g),
f AS (SELECT *, coalesce(closing, opening + net2) AS closing2, coalesce(cfi, net2 - cfo - cff) AS cfi2, coalesce(cfo, net2 - cfi - cff) AS cfo2 FROM n),
r AS (
  SELECT k, 'cfo' AS field, cfo2 AS value, CASE WHEN cfo IS NULL THEN 'net_change' ELSE 'given' END AS source, CASE WHEN cfo IS NULL THEN 1 ELSE 0 END AS round FROM f
  UNION ALL SELECT k, 'cfi', cfi2, CASE WHEN cfi IS NULL THEN 'net_change' ELSE 'given' END, CASE WHEN cfi IS NULL THEN 1 ELSE 0 END FROM f
  UNION ALL SELECT k, 'cff', cff, 'given', 0 FROM f UNION ALL SELECT k, 'opening_cash', opening, 'given', 0 FROM f
  UNION ALL SELECT k, 'net_change_in_cash', net2, net_by, CASE WHEN net IS NULL THEN 1 ELSE 0 END FROM f
  UNION ALL SELECT k, 'closing_cash', closing2, CASE WHEN closing IS NULL THEN 'closing' ELSE 'given' END, CASE WHEN closing IS NOT NULL THEN 0 WHEN net IS NOT NULL THEN 1 ELSE 2 END FROM f
  UNION ALL SELECT k, 'net_change', cfo2 + cfi2 + cff - net2, 'contradiction', NULL FROM f WHERE abs(cfo2 + cfi2 + cff - net2) > 0.005 * greatest(abs(cfo2), abs(cfi2), abs(cff), abs(net2)))
SELECT k AS o_orderkey, field, CAST(value AS DOUBLE) AS value, source, CAST(round AS INTEGER) AS round FROM r WHERE value IS NOT NULL
"""


@query("complete_totals", TOTALS_SQL)
def complete_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, c = F.round("o_totalprice").cast("long"), F.col("o_orderkey") % 6
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", c.alias("c"), a.alias("cfo"), (-(a % 1000)).alias("cfi"), (-(a % 77)).alias("cff"), (a % 5000).alias("opening_cash"))
    net = F.col("cfo") + F.col("cfi") + F.col("cff") + F.when(F.col("cfo") % 11 == 0, F.floor(F.col("cfo") / 5)).otherwise(0)
    rows = rows.withColumn("net_change_in_cash", net).withColumn("closing_cash", F.col("opening_cash") + F.col("net_change_in_cash"))
    gone = {"cfo": (5,), "cfi": (4, 5), "cff": (), "opening_cash": (), "net_change_in_cash": (1, 3, 4), "closing_cash": (2, 3)}
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.when(~F.col("c").isin(*x) if x else F.lit(True), F.col(f).cast("double")).alias("value")) for f, x in gone.items()))
    values = rows.select("o_orderkey", F.lit("cf").alias("stmt"), F.explode(cells).alias("x")).select("o_orderkey", "stmt", "x.*")
    return strategy.complete_totals(values, strategy.equations(spark), ("o_orderkey",)).drop("stmt")


REFS_SQL = """
WITH n AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, sum(CASE WHEN l_quantity > 45 THEN 3 WHEN l_quantity < 3 THEN 0 WHEN l_quantity = 25 THEN -1 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity ROWS UNBOUNDED PRECEDING) AS n, l_quantity FROM lineitem),
p AS (SELECT *, lead(n) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) AS nxt FROM n WHERE n > 0),
t AS (SELECT i, CASE WHEN i <= 26 THEN chr(CAST(64 + i AS INTEGER)) WHEN i <= 702 THEN chr(CAST(64 + (i - 1) // 26 AS INTEGER)) || chr(CAST(65 + (i - 1) % 26 AS INTEGER))
  ELSE chr(CAST(65 + (i - 703) // 676 AS INTEGER)) || chr(CAST(65 + (i - 703) // 26 % 26 AS INTEGER)) || chr(CAST(65 + (i - 703) % 26 AS INTEGER)) END AS letters FROM range(1, 18000) x(i))
SELECT l_suppkey, l_orderkey, l_linenumber, a.letters AS ref, b.letters AS next_ref, CASE WHEN nxt > n THEN 'gap' WHEN nxt = n THEN 'repeat' ELSE 'back' END AS kind,
  coalesce((SELECT string_agg(m.letters, ' ' ORDER BY m.i) FROM t m WHERE m.i > p.n AND m.i < p.nxt), '') AS missing
FROM p JOIN t a ON a.i = n JOIN t b ON b.i = nxt WHERE nxt <> n + 1
"""


@query("ref_gaps", REFS_SQL)
def ref_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    step = F.when(F.col("l_quantity") > 45, 3).when(F.col("l_quantity") < 3, 0).when(F.col("l_quantity") == 25, -1).otherwise(1)
    n = F.sum(step).over(Window.partitionBy("l_suppkey").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = _t(spark, sf_dir, "lineitem").select("l_suppkey", *order, n.alias("n")).withColumn("ref", strategy.number_letters(F.col("n")))
    found = strategy.ref_gaps(rows, ("l_suppkey",), order)
    return found.select("l_suppkey", "l_orderkey", "l_linenumber", "ref", "next_ref", "kind", F.array_join("missing", " ").alias("missing"))


_DISCRETE = "(n % 3 = 1 OR (n % 3 = 0 AND y >= 1994 + n % 4))"
_REGIMES = f"""{_YEAR},
q AS (SELECT n, section, y, sum(price) FILTER (q = 1) AS q1, sum(price) FILTER (q = 2) AS q2, sum(price) FILTER (q = 3) AS q3, sum(price) AS total FROM o GROUP BY ALL),
m AS (SELECT n, section, y, total, CAST(q1 AS DOUBLE) AS m3, CAST(CASE WHEN {_DISCRETE} THEN q2 WHEN q1 IS NULL AND q2 IS NULL THEN NULL ELSE coalesce(q1, 0) + coalesce(q2, 0) END AS DOUBLE) AS m6,
  CAST(CASE WHEN {_DISCRETE} THEN q3 WHEN q1 IS NULL AND q2 IS NULL AND q3 IS NULL THEN NULL ELSE coalesce(q1, 0) + coalesce(q2, 0) + coalesce(q3, 0) END AS DOUBLE) AS m9 FROM q),
v AS (SELECT *, CASE WHEN m3 > 0 AND m6 > 0 THEN CASE WHEN m6 < 0.9 * m3 THEN 1 ELSE -1 END ELSE 0 END + CASE WHEN m6 > 0 AND m9 > 0 THEN CASE WHEN m9 < 0.9 * m6 THEN 1 ELSE -1 END ELSE 0 END AS votes FROM m),
s AS (SELECT *, sum(votes) OVER (PARTITION BY n, section) AS every, coalesce(sum(votes) OVER (PARTITION BY n, section ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM v),
x AS (SELECT n, section, y AS since, every - 2 * prior AS later FROM s QUALIFY row_number() OVER (PARTITION BY n, section ORDER BY abs(2 * prior - every) DESC, y) = 1),
r AS (SELECT s.*, CASE WHEN (y >= since AND later > 0) OR (y < since AND later < 0) THEN 'discrete' ELSE 'cumulative' END AS regime FROM s JOIN x USING (n, section))
"""
REGIME_SQL = f"{_REGIMES} SELECT CAST(n AS VARCHAR) AS ticker, section, CAST(y AS INTEGER) AS fiscal_year, votes, regime FROM r"
REACC_SQL = f"""{_REGIMES},
l AS (SELECT n, section, y, 3 AS months, m3 AS value FROM r
  UNION ALL SELECT n, section, y, 6, CASE WHEN regime = 'discrete' THEN m3 + m6 ELSE m6 END FROM r UNION ALL SELECT n, section, y, 9, CASE WHEN regime = 'discrete' THEN m3 + m6 + m9 ELSE m9 END FROM r
  UNION ALL SELECT n, section, y, 12, CAST(total AS DOUBLE) FROM r)
SELECT CAST(n AS VARCHAR) AS ticker, section, CAST(y AS INTEGER) AS year, months, round(value, 2) AS value FROM l
"""


def _reported(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cumulative revenue, but of some companies or years each quarter for itself, and the companies."""
    rows = cumulative(spark, sf_dir, thin=False).where("field = 'revenue_net'")
    discrete = F.expr(_DISCRETE)
    slot = F.element_at(F.split("source_file", "_"), 2)
    rows = rows.withColumn("slot", slot).where(F.when(F.col("slot").isin("d1", "c12"), True).when(discrete, F.col("slot").isin("d2", "d3")).otherwise(F.col("slot").isin("c6", "c9")))
    rows = rows.withColumn("months", F.when(F.col("slot") == "d2", 6).when(F.col("slot") == "d3", 9).otherwise(F.col("months")))
    companies = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("ticker"), F.lit(12).alias("fiscal_month"))
    return rows.select("ticker", "section", "y", "period_end", "months", "field", "value"), companies


@query("reporting_regimes", REGIME_SQL)
def reporting_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strategy.reporting_regimes(*_reported(spark, sf_dir))


@query("reaccumulated", REACC_SQL)
def reaccumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, companies = _reported(spark, sf_dir)
    out = strategy.reaccumulated(rows, strategy.reporting_regimes(rows, companies), companies)
    return out.select("ticker", "section", F.col("y").alias("year"), "months", F.round("value", 2).alias("value"))


TRIAGE_SQL = """
WITH f AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'formula' WHEN 1 THEN 'missing_total_assets' WHEN 2 THEN 'equation' WHEN 3 THEN 'unit' ELSE 'other' END AS kind,
  CASE WHEN o_custkey % 7 > 0 THEN CAST(round(o_totalprice) AS BIGINT) % 101 END AS m, CAST(round(o_totalprice) AS BIGINT) % 90 AS off, o_custkey % 2 = 1 AS x, o_custkey % 3 = 1 AS y, o_custkey % 5 > 1 AS z FROM orders),
p AS (SELECT o_orderkey, kind, CASE kind
  WHEN 'formula' THEN CASE WHEN m < 50 THEN 1 WHEN m < 90 THEN 2 WHEN m >= 90 AND x THEN 3 WHEN m >= 90 THEN 4 END
  WHEN 'missing_total_assets' THEN CASE WHEN x AND y THEN 1 WHEN z THEN 2 ELSE 3 END
  WHEN 'equation' THEN CASE WHEN off >= 50 AND y THEN 1 WHEN off >= 50 THEN 2 WHEN off >= 10 AND m >= 90 THEN 3 WHEN off >= 10 THEN 4 ELSE 5 END WHEN 'unit' THEN 1 END AS priority FROM f)
SELECT o_orderkey, kind, CAST(priority AS INTEGER) AS priority, CASE kind || priority WHEN 'formula1' THEN 'wrong page in manifest' WHEN 'formula2' THEN 'OCR corruption' WHEN 'formula3' THEN 'source document error' WHEN 'formula4' THEN 'extraction error'
  WHEN 'missing_total_assets1' THEN 'capital employed format' WHEN 'missing_total_assets2' THEN 'incomplete extraction' WHEN 'missing_total_assets3' THEN 'wrong page' WHEN 'equation1' THEN 'capital employed format' WHEN 'equation2' THEN 'wrong column'
  WHEN 'equation3' THEN 'source document error' WHEN 'equation4' THEN 'extraction error' WHEN 'equation5' THEN 'rounding' WHEN 'unit1' THEN 'mixed units' END AS diagnosis FROM p
"""


@query("triage", TRIAGE_SQL)
def triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, kinds = _t(spark, sf_dir, "orders"), ("formula", "missing_total_assets", "equation", "unit", "other")
    price = F.round("o_totalprice").cast("long")
    failures = o.select("o_orderkey", F.element_at(F.array(*map(F.lit, kinds)), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("kind"))
    told = {
        "source_match": F.when(F.col("o_custkey") % 7 > 0, price % 101), "off_percent": price % 90, "source_also_wrong": F.col("o_custkey") % 2, "has_non_current": F.col("o_custkey") % 2,
        "has_current": (F.col("o_custkey") % 3 == 1).cast("int"), "capital_employed": (F.col("o_custkey") % 3 == 1).cast("int"), "has_assets": (F.col("o_custkey") % 5 > 1).cast("int"),
    }
    cells = F.array(*(F.struct(F.lit(n).alias("measure"), v.cast("double").alias("value")) for n, v in told.items()))
    measures = o.select("o_orderkey", F.explode(cells).alias("m")).select("o_orderkey", "m.*")
    return strategy.triage(failures, measures, strategy.triage_rules(spark), ("o_orderkey",)).select("o_orderkey", "kind", "priority", "diagnosis")


VARIANT_SQL = """
SELECT o_orderkey, 'T' || o_custkey AS ticker, o_orderpriority AS section, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS period_end, CAST(CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE 12 END AS INTEGER) AS months, f.field,
  CASE WHEN f.field = 'revenue_net' THEN CASE o_orderkey % 4 WHEN 0 THEN 'number' WHEN 1 THEN 'object' WHEN 2 THEN 'null' ELSE 'text' END ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'object' ELSE 'other' END END AS kind,
  CASE WHEN f.field = 'revenue_net' THEN CASE WHEN o_orderkey % 4 < 2 THEN o_totalprice END WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN o_custkey END AS value,
  CASE WHEN f.field = 'revenue_net' AND o_orderkey % 4 = 1 THEN o_clerk END AS source_item, CASE WHEN f.field = 'revenue_net' AND o_orderkey % 4 = 1 THEN true END AS is_calculated,
  CASE WHEN f.field = 'revenue_net' AND o_orderkey % 4 = 1 THEN '{"note":' || o_shippriority || '}' END AS more
FROM (SELECT *, 'C' || o_custkey AS o_clerk, o_orderkey % 3 AS o_shippriority FROM (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, o_totalprice FROM orders)) CROSS JOIN (VALUES ('revenue_net'), ('odd')) f(field)
"""


@query("period_variants", VARIANT_SQL)
def period_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    text = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))
    whole = text('{"value": ', price, ', "source_item": "C', F.col("o_custkey").cast("string"), '", "ref": 7, "is_calculated": true, "note": ', (i % 3).cast("string"), "}")
    revenue = F.when(i % 4 == 0, price).when(i % 4 == 1, whole).when(i % 4 == 2, "null").otherwise('"n/a"')
    odd = F.when(i % 3 == 0, F.when(i % 2 == 0, text('{"value": ', F.col("o_custkey").cast("string"), "}")).otherwise('{"value": "12"}')).otherwise("[1, 2]")
    end = F.when(i % 7 == 6, "true").otherwise(text('"', F.date_format("o_orderdate", "yyyy-MM-dd"), '"'))
    months = F.when(i % 5 == 4, '"x"').otherwise("12")
    record = text('{"ticker": "T', F.col("o_custkey").cast("string"), '", "consolidation": "', F.col("o_orderpriority"), '", "period_end": ', end, ', "duration_months": ', months, ', "values": {"revenue_net": ', revenue, ', "odd": ', odd, "}}")
    out = readers.period_variants(_t(spark, sf_dir, "orders").select("o_orderkey", record.alias("record")))
    return out.select("o_orderkey", "ticker", "section", F.col("period_end").cast("string").alias("period_end"), "months", "field", "kind", "value", "source_item", "is_calculated", "more")


ROLES_SQL = """
WITH v AS (SELECT o_custkey AS k, o_orderkey % 3 AS r, CAST(round(sum(o_totalprice)) AS BIGINT) AS base, count(*) AS persons FROM orders GROUP BY ALL)
SELECT CAST(k AS VARCHAR) AS file, CASE WHEN k % 2 = 0 THEN 'consolidated' ELSE 'unconsolidated' END AS scope, CASE r WHEN 0 THEN 'chief_executive' WHEN 1 THEN 'directors' ELSE 'executives' END AS role, CAST(2024 - k % 2 AS INTEGER) AS year,
  CAST(persons AS DOUBLE) AS persons, CAST(base AS DOUBLE) AS base_salary, CAST(base // 10 AS DOUBLE) AS bonus, CAST(base // 5 + 3 AS DOUBLE) AS other_benefits, CAST(base + base // 10 + base // 5 + 3 AS DOUBLE) AS total FROM v
"""


@query("compensation_roles", ROLES_SQL)
def compensation_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles by column, by row, and by column with years give the same facts."""
    k = F.col("o_custkey")
    v = _t(spark, sf_dir, "orders").groupBy("o_custkey", (F.col("o_orderkey") % 3).alias("r")).agg(F.round(F.sum("o_totalprice")).cast("long").alias("base"), F.count("*").alias("persons"))
    parts = {"Number of persons": F.col("persons"), "Managerial remuneration": F.col("base"), "Bonus": F.floor(F.col("base") / 10), "Utilities": F.floor(F.col("base") / 5), "Medical": F.lit(3), "Total": F.col("base") + F.floor(F.col("base") / 10) + F.floor(F.col("base") / 5) + 3}
    shown = F.array(*(F.format_number(x.cast("long"), 0) for x in parts.values()))
    name = F.when(F.col("r") == 0, "Chief Executive").when(F.col("r") == 1, "Directors").otherwise("Executives")
    one = v.select("o_custkey", F.struct("r", name.alias("name"), shown.alias("cells")).alias("x")).groupBy("o_custkey").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    year = (2024 - k % 2).cast("string")
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    rule = lambda n: F.concat(F.lit("|"), F.repeat(F.lit("---|"), n))
    labels = F.array(*map(F.lit, parts))
    heads = F.transform("xs", lambda x: x["name"])
    rows = F.transform(labels, lambda label, i: line(F.concat(F.array(label), F.transform("xs", lambda x: F.get(x["cells"], i)))))
    wide = lambda h: F.concat(F.array(line(F.concat(F.array(F.lit("Particulars")), h)), rule(F.size("xs") + 1)), rows)
    turned = F.concat(F.array(line(F.concat(F.array(F.lit("Particulars")), labels)), rule(F.lit(len(parts) + 1))), F.transform("xs", lambda x: line(F.concat(F.array(x["name"]), x["cells"]))))
    table = F.when(k % 3 == 0, wide(heads)).when(k % 3 == 1, turned).otherwise(wide(F.transform(heads, lambda h: F.concat(h, F.lit(" "), year))))
    title = F.when(k % 2 == 0, "## Consolidated").otherwise("## Unconsolidated")
    files = one.select(k.cast("string").alias("file"), F.when(k % 3 == 2, 1990).otherwise(year.cast("int")).alias("year"), F.concat_ws("\n", title, F.lit(""), F.array_join(table, "\n")).alias("text"))
    out = records.compensation_roles(files, ["file"])
    return out.select("file", "scope", "role", "year", "persons", "base_salary", "bonus", "other_benefits", "total")


@query("per_share_issues", """
SELECT o_orderkey, 'eps_basic' AS field, o_totalprice AS value FROM orders WHERE o_orderkey % 3 = 0 AND o_totalprice > 5000
UNION ALL SELECT o_orderkey, 'Dividend_per_share', -o_totalprice FROM orders WHERE o_orderkey % 3 = 1 AND o_totalprice > 5000
""")  # fmt: skip
def per_share_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    field = F.when(i % 3 == 0, "eps_basic").when(i % 3 == 1, "Dividend_per_share").otherwise("revenue_net")
    return strategy.per_share_issues(_t(spark, sf_dir, "orders").select("o_orderkey", field.alias("field"), F.when(i % 3 == 1, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("value")))


COVERAGE_SQL = """
SELECT l_suppkey, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n_rows, count(*) FILTER (l_quantity > 10 AND l_discount > 0) AS n_mapped,
  round(100.0 * count(*) FILTER (l_quantity > 10 AND l_discount > 0) / count(*), 6) AS coverage, 100 * count(*) FILTER (l_quantity > 10 AND l_discount > 0) >= 80 * count(*) AS enough FROM lineitem GROUP BY ALL
"""


@query("mapping_coverage", COVERAGE_SQL)
def mapping_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    canonical = F.when(F.col("l_quantity") > 10, F.when(F.col("l_discount") > 0, "field").otherwise(" "))
    rows = _t(spark, sf_dir, "lineitem").select("l_suppkey", F.month("l_shipdate").alias("month"), canonical.alias("canonical"))
    return strategy.mapping_coverage(rows, ("l_suppkey", "month")).withColumn("coverage", F.round("coverage", 6))


COLUMNS_SQL = """
WITH l AS (SELECT l_orderkey AS k, l_linenumber AS r, min(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY ALL),
c AS (SELECT k, r, CASE WHEN k % 3 = 0 THEN 'annual' WHEN k % 3 = 1 THEN 'quarterly' ELSE 'other' END AS filing_type, 1 + k % 6 AS n, CASE WHEN q > 45 THEN 1 ELSE 1 + k % 6 END AS width FROM l),
g AS (SELECT k, filing_type, max(n) AS n, min(width) <> max(width) AS uneven FROM c GROUP BY k, filing_type),
i AS (SELECT *, CASE WHEN filing_type <> 'other' AND n < 2 THEN 'too_few,' ELSE '' END || CASE WHEN (filing_type = 'annual' AND n > 2) OR (filing_type = 'quarterly' AND n > 4) THEN 'too_many,' ELSE '' END || CASE WHEN uneven THEN 'uneven_rows,' ELSE '' END || CASE WHEN k % 5 = 0 THEN 'no_date,' ELSE '' END AS issues FROM g)
SELECT k AS l_orderkey, filing_type, n AS n_columns, rtrim(issues, ',') AS issues FROM i
"""


@query("column_counts", COLUMNS_SQL)
def column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_orderkey")
    # dealt out by order once: no later step moves a cell
    lines = dealt(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey")
    rows = lines.groupBy("l_orderkey", F.col("l_linenumber").alias("row_no")).agg(F.min(F.col("l_quantity").cast("long")).alias("q"))
    kind = F.when(k % 3 == 0, "annual").when(k % 3 == 1, "quarterly").otherwise("other")
    cells = rows.select("l_orderkey", kind.alias("filing_type"), "row_no", "q", F.explode(F.sequence(F.lit(0).cast("long"), k % 6)).alias("col_no"))
    header = F.when((k % 5 == 0) & (F.col("col_no") == 0), "Note").otherwise(F.concat(F.lit("31 Dec "), 2024 - F.col("col_no")))
    cells = cells.select("l_orderkey", "filing_type", "row_no", "col_no", header.alias("col_header"), F.when((F.col("q") <= 45) | (F.col("col_no") == 0), "7").alias("raw"))
    heads = cells.select("col_header").distinct().withColumn("dated", period_header(F.col("col_header"))["period_end"].isNotNull())
    # seven headers; dealt out by them, the cells would be in seven tasks
    found = strategy.column_counts(cells.join(F.broadcast(heads), "col_header"), "l_orderkey")
    return found.select("l_orderkey", "filing_type", "n_columns", F.array_join("issues", ",").alias("issues"))


@query("qc_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 500")
def qc_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.reproducible_sample(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")


STATS_SQL = """
WITH d AS (SELECT source, doc_id // 20 AS f, doc_id % 20 AS page, n_chars % 3 = 0 AS st, n_chars % 5 = 0 AS my, n_chars % 41 = 0 AS cc FROM documents),
f AS (SELECT source, f, count(*) AS n, bool_or(st) AS st, bool_or(my) AS my, bool_or(cc) AS cc FROM d GROUP BY ALL)
SELECT 'total_filings' AS stat, NULL AS tag, count(*) AS n FROM f UNION ALL SELECT 'total_pages_classified', NULL, CAST(sum(n) AS BIGINT) FROM f
UNION ALL SELECT 'filings_with_statements', NULL, count(*) FILTER (st) FROM f UNION ALL SELECT 'filings_with_multi_year', NULL, count(*) FILTER (my) FROM f UNION ALL SELECT 'filings_with_ceo_comp', NULL, count(*) FILTER (cc) FROM f
UNION ALL SELECT 'pages_by_tag', 'statement', count(*) FILTER (st) FROM d HAVING count(*) FILTER (st) > 0 UNION ALL SELECT 'pages_by_tag', 'multi_year', count(*) FILTER (my) FROM d HAVING count(*) FILTER (my) > 0 UNION ALL SELECT 'pages_by_tag', 'ceo_comp', count(*) FILTER (cc) FROM d HAVING count(*) FILTER (cc) > 0
"""


@query("manifest_stats", STATS_SQL)
def manifest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    tag = lambda name, c: F.when(c, F.struct(F.lit(name).alias("tag"), F.lit(0.9).alias("confidence")))
    weak = F.struct(F.lit("bs").alias("tag"), F.lit(0.4).alias("confidence"))
    tags = F.array_compact(F.array(tag("statement", n % 3 == 0), tag("multi_year", n % 5 == 0), tag("ceo_comp", n % 41 == 0), weak))
    rows = _t(spark, sf_dir, "documents").select("source", F.floor(F.col("doc_id") / 20).alias("filing"), (F.col("doc_id") % 20).alias("page"), tags.alias("section_tags"))
    return pages.manifest_stats(rows, ["source", "filing"])


NO_MANIFEST_SQL = """
WITH o AS (SELECT o_orderkey AS i, o_custkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders),
r AS (SELECT i, k, v, CASE WHEN i % 4 = 0 THEN v + 1 ELSE v END AS value FROM o),
t AS (SELECT k, string_agg('sold for ' || format('{:,}', v) || '; ', '') AS text FROM o WHERE k % 5 > 0 GROUP BY k)
SELECT r.i AS o_orderkey, CASE WHEN r.k % 7 = 0 THEN 'no_manifest' WHEN t.text IS NULL THEN 'no_source'
  WHEN list_bool_or([contains(t.text, x) FOR x IN [CAST(value AS VARCHAR), format('{:,}', value), CASE WHEN value >= 1000 THEN CAST(value // 1000 AS VARCHAR) ELSE CAST(value AS VARCHAR) END, CASE WHEN value >= 1000 THEN format('{:,}', value // 1000) ELSE format('{:,}', value) END]]) THEN 'found' ELSE 'missing' END AS presence
FROM r LEFT JOIN t USING (k)
"""


@query("presence_by_manifest", NO_MANIFEST_SQL)
def presence_by_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.floor("o_totalprice").cast("long").alias("v"))
    rows = o.select("o_orderkey", "k", F.when(F.col("o_orderkey") % 4 == 0, F.col("v") + 1).otherwise(F.col("v")).cast("double").alias("value"))
    shown = F.concat(F.lit("sold for "), F.format_number("v", 0), F.lit("; "))
    sources = o.where("k % 5 > 0").groupBy("k").agg(F.array_join(F.collect_list(shown), "").alias("text"))
    manifest = o.select("k", F.when(F.col("k") % 7 > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("pages")).distinct()
    return records.value_presence(rows, sources, ["k"], manifest=manifest).select("o_orderkey", "presence")


VALUATION_SQL = """
WITH p AS (SELECT event_id, user_id AS symbol, CAST(ts AS DATE) AS date, value AS closing_price FROM events WHERE event_type = 'purchase'),
s AS (SELECT user_id AS symbol, event_id AS i, event_type AS t, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) ELSE make_date(year(ts), 12, 31) END AS date, value * CASE WHEN event_id % 3 = 0 THEN 1 ELSE 1000 END AS v FROM events WHERE event_id % 5 <> 0),
i AS (SELECT symbol, date, arg_min(v, i) AS income FROM s WHERE t = 'signup' GROUP BY ALL), d AS (SELECT symbol, date, arg_min(abs(v), i) AS dividends FROM s WHERE t = 'error' GROUP BY ALL),
a AS (SELECT p.*, i.income FROM p ASOF LEFT JOIN i ON p.symbol = i.symbol AND p.date >= i.date),
b AS (SELECT a.*, d.dividends, CASE WHEN closing_price > 0 THEN closing_price * (a.symbol + 1) END AS cap FROM a ASOF LEFT JOIN d ON a.symbol = d.symbol AND a.date >= d.date)
SELECT event_id, round(cap, 2) AS market_cap, round(CASE WHEN income > 0 THEN cap / income END, 4) AS pe_ratio, round(CASE WHEN dividends <> 0 AND cap > 0 THEN 100 * dividends / cap END, 4) AS dividend_yield FROM b
"""


@query("valuation", VALUATION_SQL)
def valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From statement rows to multiples: twelve-month values by date, then as of each price."""
    e, i, day = _t(spark, sf_dir, "events"), F.col("event_id"), F.to_date("ts")
    statements = e.select(
        F.col("user_id").alias("ticker"), F.lit("ltm").alias("period_type"), F.when(i % 5 == 0, "unconsolidated").otherwise("consolidated").alias("section"), F.when(i % 2 == 0, day.cast("string")).otherwise(F.year(day).cast("string")).alias("period_end"),
        F.when(F.col("event_type") == "signup", "net_profit").when(F.col("event_type") == "error", "dividends_paid").alias("key_metric"), "value", F.when(i % 3 == 0, "rupees").otherwise("thousands").alias("unit_type"), i.alias("read_order"),
    )
    prices = e.where("event_type = 'purchase'").select("event_id", F.col("user_id").alias("symbol"), day.alias("date"), F.col("value").alias("closing_price"))
    shares = e.select(F.col("user_id").alias("symbol")).distinct().withColumn("shares", F.col("symbol") + 1)
    out = market.market_metrics(prices, shares, market.ltm_values(statements, "net_profit", "ltm_income"), market.ltm_values(statements, "dividends_paid", "ltm_dividends", absolute=True))
    return out.select("event_id", F.round("market_cap", 2).alias("market_cap"), F.round("pe_ratio", 4).alias("pe_ratio"), F.round("dividend_yield", 4).alias("dividend_yield"))
