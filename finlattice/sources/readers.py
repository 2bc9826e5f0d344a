"""Readers of the domain's files; every schema is explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMPANY = "`Symbol` string, `Company Name` string, `Industry` string, `fiscal_period` string"
PERIODS = "periods array<struct<ticker:string,consolidation:string,period_end:string,duration:string,duration_months:int,unit_type:string,source_file:string,filing_date:string,values:map<string,string>>>"
MANIFEST = "map<string,map<string,map<string,map<string,array<int>>>>>"


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """Page corpus ``TICKER/YEAR/FILING/page_NNN.md``: ticker, year, filing, page, path, text; other paths and files without a byte are left out."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("uri"), F.col("value").alias("text"))
    pattern = r"([^/]+)/(\d{4})/([^/]+)/(page_(\d+)\.md)$"
    part = lambda i: F.regexp_extract("uri", pattern, i)
    rows = raw.where(F.col("uri").rlike(pattern))
    return rows.select(part(1).alias("ticker"), part(2).cast("int").alias("year"), part(3).alias("filing"), part(5).cast("int").alias("page"), F.concat_ws("/", part(1), part(2), part(3), part(4)).alias("path"), "text")


def read_extractions(spark: SparkSession, root: str) -> DataFrame:
    """Extraction files: file, ticker, filing_type, filing_period, section, text; for ``cells.parse_cells``."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.regexp_extract("_metadata.file_path", r"([^/]+)\.md$", 1).alias("file"), F.col("value").alias("text"))
    pattern = r"^([A-Z0-9]+)_(annual|quarterly)_([\d-]+)_(\w+)$"
    part = lambda i: F.regexp_extract("file", pattern, i)
    return raw.where(F.col("file").rlike(pattern)).select("file", part(1).alias("ticker"), part(2).alias("filing_type"), part(3).alias("filing_period"), part(4).alias("section"), "text")


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Companies: ticker in capitals, company_name, industry, fiscal_month (default 6), company_type."""
    raw = spark.read.schema(COMPANY).json(path, multiLine=True)
    kind = F.when(F.lower("Industry").contains("bank"), "BANK").when(F.lower("Industry").contains("insurance"), "INSURANCE").otherwise("CORPORATE")
    return raw.where("Symbol IS NOT NULL").select(F.upper("Symbol").alias("ticker"), F.col("Company Name").alias("company_name"), F.col("Industry").alias("industry"), F.coalesce(F.split("fiscal_period", "-")[0].try_cast("int"), F.lit(6)).alias("fiscal_month"), kind.alias("company_type"))


def read_periods(spark: SparkSession, path: str) -> DataFrame:
    """Period records as long values; a value may be a number or an object with value, source_item and ref."""
    raw = spark.read.schema(PERIODS).json(path, multiLine=True).select(F.explode("periods").alias("p"))
    long = raw.select("p.*", F.posexplode("p.values").alias("pos", "field", "v")).drop("values")
    plain = F.col("v").try_cast("double")
    item = F.get_json_object("v", "$.source_item")
    value = F.coalesce(plain, F.get_json_object("v", "$.value").try_cast("double"))
    return long.select("ticker", F.col("consolidation").alias("section"), F.to_date("period_end").alias("period_end"), F.col("duration_months").alias("months"), "unit_type", "source_file", F.to_date("filing_date").alias("filing_date"), "field", value.alias("value"), item.alias("source_item"))


def period_variants(records: DataFrame, column: str = "record") -> DataFrame:
    """Values of period records in JSON text, one record a row, read as VARIANT so that each keeps its own type; other columns are carried along.

    Returns ticker, section, period_end, months, unit_type, field, ``kind`` (number, object, null, text or other: what the value was), value, source_item, ref, is_calculated,
    ``more`` (fields of an object that aren't among these, as JSON; null if none). A number may stand by itself or as an object's value; a text or a truth value is no number, and a part
    of the wrong type is null. Text that isn't JSON, and records without values, give nothing.
    """
    extra = [c for c in records.columns if c != column]
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    v = records.select(*extra, F.try_parse_json(column).alias("_v")).where("_v IS NOT NULL")
    each = v.select(*extra, "_v", F.explode(get(F.col("_v"), "$.values", "map<string,variant>")).alias("field", "_x"))
    x = F.col("_x")
    of = F.schema_of_variant(x)
    number = of.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    inner = get(x, "$.value", "variant")
    kind = F.when(number, "number").when(of.startswith("OBJECT"), "object").when(x.isNull() | F.is_variant_null(x), "null").when(of == "STRING", "text").otherwise("other")
    value = F.when(number, get(x, "$", "double")).when(F.schema_of_variant(inner).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), get(inner, "$", "double"))
    text = lambda path: F.when(F.schema_of_variant(get(x, path, "variant")) == "STRING", get(x, path, "string"))
    known = F.array(*map(F.lit, ("value", "source_item", "ref", "is_calculated")))
    others = F.map_filter(F.when(of.startswith("OBJECT"), get(x, "$", "map<string,variant>")), lambda k, _: ~F.array_contains(known, k))
    top = lambda path, kind: get(F.col("_v"), path, kind)
    return each.select(
        *extra, top("$.ticker", "string").alias("ticker"), top("$.consolidation", "string").alias("section"), top("$.period_end", "string").try_cast("date").alias("period_end"), top("$.duration_months", "int").alias("months"),
        top("$.unit_type", "string").alias("unit_type"), "field", kind.alias("kind"), value.alias("value"), text("$.source_item").alias("source_item"), text("$.ref").alias("ref"),
        F.when(F.schema_of_variant(get(x, "$.is_calculated", "variant")) == "BOOLEAN", get(x, "$.is_calculated", "boolean")).alias("is_calculated"), F.when(F.size(others) > 0, F.to_json(others)).alias("more"),
    )


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; blank and corrupt ones are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def statement_pages(nested: DataFrame) -> DataFrame:
    """Manifest text (one JSON object in ``value``) as rows ticker, period_key, section, stmt, page."""
    m = nested.select(F.explode(F.from_json("value", MANIFEST)).alias("ticker", "a")).select("ticker", F.explode("a").alias("period_key", "b"))
    return m.select("ticker", "period_key", F.explode("b").alias("section", "c")).select("ticker", "period_key", "section", F.explode("c").alias("stmt", "d")).select("ticker", "period_key", "section", "stmt", F.explode("d").alias("page"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Allowlists: ticker, fiscal_year, section, reason, pattern, period, period_end; a rule with ``periods`` gives a row for each.

    The rules are a list, or stand under ``allowlist``. ``period_end`` is the date of a period: ``annual_2023``, ``quarterly_2023-03-31``, or the date alone.
    """
    fields = {"ticker": "string", "fiscal_year": "int", "consolidation": "string", "reason": "string", "period": "string", "periods": "array<string>", "pattern": "string"}
    inner = ", ".join(f"{n}: {t}" for n, t in fields.items())
    raw = spark.read.schema(", ".join((*(f"{n} {t}" for n, t in fields.items()), f"allowlist array<struct<{inner}>>"))).json(path, multiLine=True)
    rules = raw.select(F.inline(F.coalesce("allowlist", F.array(F.struct(*fields)))))
    each = F.explode_outer(F.when(F.size("periods") > 0, F.col("periods")).otherwise(F.array("period")))
    rows = rules.where("ticker IS NOT NULL").select("ticker", "fiscal_year", F.col("consolidation").alias("section"), "reason", "pattern", each.alias("period"))
    year = F.regexp_extract("period", r"^annual_(\d{4})$", 1)
    return rows.withColumn("period_end", F.when(year != "", F.make_date(year.try_cast("int"), F.lit(12), F.lit(31))).otherwise(F.try_to_date(F.regexp_replace("period", "^quarterly_", ""), "yyyy-MM-dd")))


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """Files to leave out, listed under ``exclude``: file, each once."""
    raw = spark.read.schema("exclude array<struct<file: string>>").json(path, multiLine=True)
    return raw.select(F.inline("exclude")).where("file IS NOT NULL").distinct()


def read_qc_status(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes of a check, listed under ``files``: file, qc_status (pass, no_formulas or fail); see ``cells.extraction_status`` for files without one."""
    raw = spark.read.schema("files array<struct<file: string, status: string, formulas: bigint>>").json(path, multiLine=True).select(F.inline("files"))
    status = F.when(F.col("status") == "pass", "pass").when(F.coalesce("formulas", F.lit(0)) == 0, "no_formulas").otherwise("fail")
    return raw.where("file IS NOT NULL").select("file", status.alias("qc_status"))


def read_shares(spark: SparkSession, path: str) -> DataFrame:
    """Share counts above 0: symbol in capitals, shares."""
    return spark.read.schema("symbol string, shares bigint").json(path).where("symbol IS NOT NULL AND shares > 0").select(F.upper("symbol").alias("symbol"), "shares")


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Prices with a value: symbol, date, closing_price."""
    return spark.read.schema("symbol string, date date, closing_price double").json(path).where("closing_price IS NOT NULL")
