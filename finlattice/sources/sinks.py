"""Writers: published facts and documents, partitioned outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.facts import COLUMNS

DOCUMENT_COLUMNS = ("ticker", "industry", "filing_type", "filing_period", "filing_year", "section_tags", "pg", "jpg_path", "summary", "text")
MAX_TEXT, MARKER = 50_000, "... [truncated]"


def fact_rows(facts: DataFrame) -> DataFrame:
    """The 18 columns in order; lists as JSON text, booleans as 0 and 1."""
    out = facts.select(*COLUMNS)
    flags = {n: F.col(n).cast("int") for n, t in out.dtypes if t == "boolean"}
    lists = {n: F.to_json(n) for n, t in out.dtypes if t.startswith("array")}
    return out.withColumns({**flags, **lists}) if flags or lists else out


def document_rows(documents: DataFrame) -> DataFrame:
    """The 10 columns in order; ticker in capitals, tags as JSON, texts cut at 50,000 characters with a marker (the sink's column limit)."""
    text = F.when(F.length("text") > MAX_TEXT, F.concat(F.substring("text", 1, MAX_TEXT), F.lit(MARKER))).otherwise(F.col("text"))
    return documents.withColumns({"ticker": F.upper("ticker"), "section_tags": F.to_json("section_tags"), "filing_year": F.col("filing_year").try_cast("int"), "pg": F.col("pg").try_cast("int"), "text": text}).select(*DOCUMENT_COLUMNS)


#: The order in which published rows lie.
FACT_ORDER = ("ticker", "section", "period_end", "period_duration", "canonical_field", "original_name")
DOCUMENT_ORDER = ("filing_type", "filing_period", "pg")


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "overwrite", order: tuple[str, ...] = ()) -> None:
    """Parquet by partition; with ``order``, each partition's files follow each other in it, and so do the rows of each file.

    Ranges of the order go to tasks, so that a large partition is several files and no task holds it whole.
    """
    rows = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order) if order else df
    rows.write.mode(mode).partitionBy(*by).parquet(path)


def publish_facts(facts: DataFrame, path: str) -> None:
    write_partitioned(fact_rows(facts), path, "statement_type", order=FACT_ORDER)


def publish_documents(documents: DataFrame, path: str) -> None:
    write_partitioned(document_rows(documents), path, "ticker", "filing_year", order=DOCUMENT_ORDER)
