"""Which of several candidates stands: best source of a period, latest report, first of equals; and totals repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = ("ticker", "section", "period_end", "months")


def pick(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key in an order that should leave no ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def select_best_source(candidates: DataFrame, keys: Sequence[str] = PERIOD) -> DataFrame:
    """The standing candidate of each period, with its ``source_type``.

    ``candidates``: the keys, current (reported for its own period), qc_pass, score, filing_date, source_file. Current
    and passed stand before prior-year and passed, then current, then prior-year; inside a class the higher
    score, the later filing, the first file. A lone candidate is primary or prior_year by what it is; a prior-year one that
    stands before others is a fallback.
    """
    current, ok = F.col("current"), F.coalesce("qc_pass", F.lit(False))
    rank = F.when(current & ok, 0).when(~current & ok, 1).when(current, 2).otherwise(3)
    counted = candidates.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    label = F.when(current, "primary").when(F.col("_n") == 1, "prior_year").otherwise("prior_year_fallback")
    return pick(counted.withColumn("source_type", label), keys, rank, F.desc("score"), F.desc_nulls_last("filing_date"), "source_file").drop("_n")


def select_best_balance(candidates: DataFrame, keys: Sequence[str] = PERIOD) -> DataFrame:
    """The standing candidate of each balance-sheet period, with its ``source_type``.

    ``candidates``: the keys, current, qc_pass, source_file. The classes are those of select_best_source, inside a class the first file stands.
    A prior-year one is a fallback if it passed and stands before others, else prior_year.
    """
    current, ok = F.col("current"), F.coalesce("qc_pass", F.lit(False))
    rank = F.when(current & ok, 0).when(~current & ok, 1).when(current, 2).otherwise(3)
    counted = candidates.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    label = F.when(current, "primary").when(ok & (F.col("_n") > 1), "prior_year_fallback").otherwise("prior_year")
    return pick(counted.withColumn("source_type", label), keys, rank, "source_file").drop("_n")


def dedupe_balance_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Balance-sheet facts: the primary filing before comparatives, annual before quarterly, then reading order."""
    return pick(rows, keys, F.desc("is_primary"), F.desc("is_annual"), "read_order")


def latest_report(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Multi-year facts: the latest report year, then reading order."""
    return pick(rows, keys, F.desc("report_year"), "read_order")


def repeats(rows: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Every row after the first of its key, with the first one's id; null key parts are equal."""
    w = Window.partitionBy(*keys).orderBy(row_id)
    return rows.select("*", F.row_number().over(w).alias("_n"), F.first(row_id).over(w).alias("first_row")).where("_n > 1").drop("_n")


#: Totals that repair_bs_totals handles, as columns of its wide form.
BS_TOTALS = ("subtotal_equity", "total_equity", "total_liabilities_and_equity", "total_equity_and_liabilities", "total_liabilities", "total_current_liabilities", "total_non_current_liabilities", "total_assets", "total_current_assets", "total_non_current_assets", "total_non_current_assets_sub")


#: Fixed texts of the notes; the corrected one goes on with the former value.
NOTES = {"tl": "[Derived: TCL + TNCL]", "ta": "[Derived: NCA + CA]", "tel": "[Derived: TE + TL]", "wrong": "[Corrected: TE + TL, was ", "ta_tel": "[Derived: TA = TEL]"}


def repair_bs_totals(wide: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Fills and corrects balance-sheet totals, in this order, noting each but the aliases in ``repairs``.

    Aliases; liabilities and assets from their parts; equity and liabilities from equity + liabilities if missing, or
    corrected if it is off while that sum agrees with the assets; assets from equity and liabilities.
    """
    c, notes = F.col, F.array().cast("array<string>")
    df = wide.withColumn("repairs", notes)

    def put(df: DataFrame, name: str, when: Column, value: Column, note: Column | None = None) -> DataFrame:
        ok = F.coalesce(when & value.isNotNull(), F.lit(False))
        noted = {} if note is None else {"repairs": F.when(ok, F.array_append("repairs", note)).otherwise(c("repairs"))}
        return df.withColumns({**noted, name: F.when(ok, value).otherwise(c(name))})

    te, tel, tl, ta = c("total_equity"), c("total_equity_and_liabilities"), c("total_liabilities"), c("total_assets")
    df = put(df, "total_equity", te.isNull(), c("subtotal_equity"))
    df = put(df, "total_equity_and_liabilities", tel.isNull(), c("total_liabilities_and_equity"))
    df = put(df, "total_liabilities", tl.isNull(), c("total_current_liabilities") + c("total_non_current_liabilities"), F.lit(NOTES["tl"]))
    tnca = F.when(F.coalesce("total_non_current_assets", F.lit(0.0)) != 0, c("total_non_current_assets")).otherwise(c("total_non_current_assets_sub"))
    df = put(df, "total_assets", ta.isNull(), tnca + c("total_current_assets"), F.lit(NOTES["ta"]))
    df = put(df, "total_equity_and_liabilities", tel.isNull(), te + tl, F.lit(NOTES["tel"]))
    off = (te + tl > 0) & (F.abs(tel - te - tl) > tolerance * (te + tl)) & (ta > 0) & (F.abs(te + tl - ta) < tolerance * ta)
    df = put(df, "total_equity_and_liabilities", off, te + tl, F.concat(F.lit(NOTES["wrong"]), tel.cast("string"), F.lit("]")))
    return put(df, "total_assets", ta.isNull(), tel, F.lit(NOTES["ta_tel"]))
