"""Stored upserts and ingestion by key and content: what is read and what is written."""

import os

import pytest
from pyspark.sql import functions as F

from finlattice.sources import stored
from finlattice.streaming import ingest as streaming
from finlattice.streaming.ingest import ingest, ingested, progress

SCHEMA = "symbol string, day int, price double, low double"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and stored.STAGING not in d}


def rows_of(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).select("symbol", "day", "price", "low").collect()), key=str)


def test_upsert_touches_its_partitions_only(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    put = lambda *rows: stored.upsert_stored(spark, path, table(*rows), ("symbol", "day"), "symbol", "price")
    assert put(("A", 1, 1.0, None), ("A", 2, 2.0, None), ("B", 1, 3.0, None), (None, 1, 9.0, None)) == 3
    before = files(path)
    assert put(("B", 1, 4.0, 0.5), ("B", 1, 3.5, None), ("C", 1, 7.0, None)) == 2
    assert rows_of(spark, path) == sorted([("A", 1, 1.0, None), ("A", 2, 2.0, None), ("B", 1, 4.0, 0.5), (None, 1, 9.0, None), ("C", 1, 7.0, None)], key=str)
    after = files(path)
    same = [f for f in before if "symbol=B" not in f]
    assert same and all(after.get(f) == before[f] for f in same) and not any("symbol=B" in f and f in after for f in before)
    assert put(("B", 1, 4.0, 0.5), ("A", 1, 1.0, None), (None, 1, 9.0, None)) == 0 and files(path) == after
    assert stored.upsert_stored(spark, path, table(("B", 1, None, None)).limit(0), ("symbol", "day"), "symbol") == 0
    assert put((None, 1, 8.0, None)) == 1 and (None, 1, 8.0, None) in rows_of(spark, path)
    assert not stored.children(spark, f"{path}/{stored.STAGING}")


def test_a_failed_run_is_finished(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    put = lambda *rows: stored.upsert_stored(spark, path, spark.createDataFrame(list(rows), SCHEMA), ("symbol", "day"), "symbol")
    put(("A", 1, 1.0, None), ("B", 1, 1.0, None))
    with monkeypatch.context() as m:
        m.setattr(stored, "_replace", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            put(("A", 1, 2.0, None))
    assert rows_of(spark, path) == [("A", 1, 1.0, None), ("B", 1, 1.0, None)]
    put(("B", 2, 5.0, None))
    assert rows_of(spark, path) == [("A", 1, 2.0, None), ("B", 1, 1.0, None), ("B", 2, 5.0, None)]
    half = f"{path}/{stored.STAGING}/000000-x"
    spark.createDataFrame([("B", 1, 77.0, None)], SCHEMA).write.parquet(half)
    os.remove(f"{half}/_SUCCESS")
    stored.recover(spark, path, "symbol")
    assert ("B", 1, 1.0, None) in rows_of(spark, path) and not os.path.exists(half)


def test_stored_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([("A", 1, 1.0, None), ("A", 2, 2.0, 1.5), ("B", 1, 3.0, None)], SCHEMA).write.partitionBy("symbol").parquet(path)
    new = lambda *rows: spark.createDataFrame(list(rows), "symbol string, day int, low double")
    change = lambda *rows: stored.update_columns_stored(spark, path, new(*rows), ("symbol", "day"), ("low",), "symbol")
    before = files(path)
    assert change(("A", 1, 0.5), ("A", 2, None), ("B", 9, 4.0), ("Z", 1, 1.0)) == 1
    assert rows_of(spark, path) == [("A", 1, 1.0, 0.5), ("A", 2, 2.0, 1.5), ("B", 1, 3.0, None)]
    after = files(path)
    assert all(after[f] == before[f] for f in before if "symbol=B" in f)
    assert change(("A", 1, 0.5)) == 0 and files(path) == after


def test_ingest_by_content(spark, tmp_path, monkeypatch):
    schema, source, target = "k long, v string", f"{tmp_path}/in", f"{tmp_path}/out"
    read = []
    ledger = streaming.ledger_rows

    def counted(s, t, buckets, schema):
        out = ledger(s, t, buckets, schema)
        read.append(0 if out is None else len(out.inputFiles()))
        return out

    monkeypatch.setattr(streaming, "ledger_rows", counted)
    run = lambda: ingest(spark, source, schema, target, f"{tmp_path}/cp", ["k"], ["v"], by_content=True)
    save = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    save([(i, "a") for i in range(2000)] + [(None, "n")])
    run()
    save([(1, "a"), (2, "b"), (None, "n"), (None, "n")])
    run()
    assert {tuple(r) for r in ingested(spark, target, schema, "skipped").collect()} == {(1, "a"), (None, "n")}
    save([(2, "a")])  # as it was at first, but not as it was last
    run()
    save([(2, "a")])
    run()
    last = {r.k: r.v for r in ingested(spark, target, schema, keys=["k"]).collect()}
    assert last[2] == "a" and last[1] == "a" and len(last) == 2001
    assert dict(map(tuple, progress(spark, target, schema).collect())) == {"done": 2003, "skipped": 3}
    # a small batch reads the ledger's partitions of its own keys, not all
    assert len([d for d in stored.children(spark, f"{target}/ledger") if d.startswith("bucket=")]) == streaming.BUCKETS
    assert read[0] == 0 and read[1] <= 3 and read[2] == read[3] == 1


def test_a_batch_tried_again(spark, tmp_path):
    schema, source, target = "k long, v string", f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(source)
    for cp in ("one", "two"):  # a lost checkpoint: the batch is run as number 0 again
        ingest(spark, source, schema, target, f"{tmp_path}/{cp}", ["k"], ["v"], by_content=True)
    assert sorted(tuple(r) for r in ingested(spark, target, schema).collect()) == [(1, "a"), (2, "b")]
    assert spark.read.parquet(f"{target}/ledger").where(F.col("batch") == 0).count() == 2
