"""Market measures: valuation as of each price date, and rolling ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import MONTHS


def as_of(left: DataFrame, right: DataFrame, key: str, date: str, value: str, order: str | None = None) -> DataFrame:
    """``left`` with the latest ``value`` of ``right`` for the same key at a date no later than its own.

    One union, one shuffle by key and a running last value, in place of a range join. Several values of one date:
    the first by ``order`` stands.
    """
    tie = F.col(order) if order else F.lit(0)
    r = right.select(key, date, F.col(value).alias("_value"), tie.cast("double").alias("_order")).where("_value IS NOT NULL")
    r = r.groupBy(key, date).agg(F.min_by("_value", "_order").alias("_value"))
    both = left.withColumns({"_value": F.lit(None).cast(r.schema["_value"].dataType), "_side": F.lit(1)}).unionByName(r.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(date, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("_last", F.last("_value", ignorenulls=True).over(w)).where("_side = 1").drop("_value", "_side").withColumnRenamed("_last", value)


def period_date(text: Column) -> Column:
    """The date of a period text: a year (its end), an ISO date, or ``2024-Mar`` (the 28th); null for others."""
    year = F.regexp_extract(text, r"^(\d{4})", 1).try_cast("int")
    month = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(text, r"^\d{4}-(\w{3})$", 1))), F.lit(0)), F.lit(12))
    return F.when(text.rlike(r"^\d{4}$"), F.make_date(year, F.lit(12), F.lit(31))).when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd")).when(text.rlike(r"^\d{4}-\w{3}$"), F.make_date(year, month.cast("int"), F.lit(28)))


def ltm_values(statements: DataFrame, metric: str, name: str, absolute: bool = False) -> DataFrame:
    """``(symbol, date, name)`` of a key metric's twelve-month values in full units, one for each date (the first by ``read_order``).

    ``statements``: ticker, period_type, section, period_end (text), key_metric, value, unit_type, read_order. Only consolidated
    rows of twelve months with a value and a date count.
    """
    rows = statements.where(F.col("period_type").isin("ltm", "annual") & (F.col("section") == "consolidated") & (F.col("key_metric") == metric) & F.col("value").isNotNull())
    full = F.col("value") * F.when(F.coalesce("unit_type", F.lit("thousands")).isin("thousands", "000s"), 1000.0).otherwise(1.0)
    dated = rows.select(F.col("ticker").alias("symbol"), period_date(F.col("period_end")).alias("date"), (F.abs(full) if absolute else full).alias(name), "read_order").where("date IS NOT NULL")
    return dated.groupBy("symbol", "date").agg(F.min_by(name, "read_order").alias(name))


def market_metrics(prices: DataFrame, shares: DataFrame, income: DataFrame, dividends: DataFrame) -> DataFrame:
    """``prices`` (symbol, date, closing_price) with market_cap, pe_ratio and dividend_yield.

    ``shares``: symbol, shares; ``income`` and ``dividends``: symbol, date, ltm_income or ltm_dividends (twelve-month sums in full units).
    """
    df = as_of(as_of(prices, income, "symbol", "date", "ltm_income"), dividends, "symbol", "date", "ltm_dividends")
    cap = F.when(F.col("closing_price") > 0, F.col("closing_price") * F.col("shares"))
    df = df.join(shares.select("symbol", "shares"), "symbol", "left").withColumn("market_cap", cap)
    return df.withColumns({
        "pe_ratio": F.when(F.col("ltm_income") > 0, F.col("market_cap") / F.col("ltm_income")),
        "dividend_yield": F.when((F.col("ltm_dividends") != 0) & (F.col("market_cap") > 0), 100 * F.abs("ltm_dividends") / F.col("market_cap")),
    })


def rolling_range(prices: DataFrame, rows: int = 252, key: str = "symbol", date: str = "date", price: str = "closing_price", names: tuple[str, str] = ("high_52w", "low_52w")) -> DataFrame:
    """Highest and lowest price of the last ``rows`` priced rows of each key, the current one included."""
    w = Window.partitionBy(key).orderBy(date).rowsBetween(1 - rows, Window.currentRow)
    return prices.where(F.col(price).isNotNull()).select("*", F.max(price).over(w).alias(names[0]), F.min(price).over(w).alias(names[1]))
