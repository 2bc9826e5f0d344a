"""Every registered query of the filing operators against its SQL in DuckDB, on whole tables."""

import os
from decimal import Decimal

import duckdb
import pytest

from finlattice.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns: list[str], data: list[tuple]) -> list[tuple]:
    """Rows with columns by name, numbers to six digits."""
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def plain(x: object) -> str:
        number = isinstance(x, (int, float, Decimal)) and not isinstance(x, bool)
        return f"{float(x):.6g}" if number else str(x)

    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "PythonUDF" not in plan and "MapInArrow" not in plan
    got, want = df.collect(), duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    a, b = rows(df.columns, got), rows(want.columns, want.fetchall())
    assert len(a) == len(b) and len(b) > 0
    assert a == b, next((x, y) for x, y in zip(a, b) if x != y)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
