"""Registered queries on the driver's tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) under a name, with its SQL if SQL can express it."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


#: Rows of a table in a partition, where it is dealt out.
ROWS = 250_000


def dealt(table: DataFrame, *by: str) -> DataFrame:
    """A table dealt out by a key into partitions whose number grows with its rows (Parquet files tell them without being read), so that a task's rows don't."""
    least = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartition(max(least, -(-table.count() // ROWS)), *by)


def _load() -> None:
    """The modules that register queries."""
    from . import audit, corpus, reports, statements, strategy  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
