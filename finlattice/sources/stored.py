"""Stored tables that are changed by key: only the partitions that an update touches are read and written again."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delta import update_columns, upsert

STAGING = "_staging"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, where = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def bucket(keys: Sequence[str], n: int) -> Column:
    """A partition for a key: null parts are a value of their own."""
    return F.pmod(F.xxhash64(*keys, *(F.col(k).isNull() for k in keys)), F.lit(n)).cast("int")


def recover(spark: SparkSession, path: str, by: str) -> None:
    """Finishes changes that were staged whole when a run failed, in the order they were made, and drops those that weren't."""
    for name in children(spark, f"{path}/{STAGING}"):
        staged = f"{path}/{STAGING}/{name}"
        if exists(spark, f"{staged}/_SUCCESS"):
            _replace(spark, staged, path, by)
        delete(spark, staged)


def _replace(spark: SparkSession, staged: str, path: str, by: str) -> None:
    # types as they are in the files: a partition's name alone doesn't tell 1 from "1"
    rows = spark.read.option("recursiveFileLookup", True).parquet(staged)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def _partitions(changed: DataFrame, by: str) -> list:
    """Partitions that a change touches: as many as the table has at most."""
    return [r[0] for r in changed.select(by).distinct().collect()]


def _in(by: str, touched: list) -> Column:
    some = [x for x in touched if x is not None]
    cond = F.col(by).isin(*some) if some else F.lit(False)
    return cond | F.col(by).isNull() if None in touched else cond


def _commit(spark: SparkSession, rows: DataFrame, path: str, by: str) -> None:
    # staged whole first: what is overwritten is read by the rows themselves, and a run that fails while files are moved can be finished
    staged = f"{path}/{STAGING}/{len(children(spark, f'{path}/{STAGING}')):06d}-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    _replace(spark, staged, path, by)
    delete(spark, staged)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def upsert_stored(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], by: str, *order: str) -> int:
    """Inserts or replaces rows of a Parquet table partitioned by ``by``; returns how many partitions were written.

    The partition must follow from the key (a part of it, or ``bucket``), so that a row's former version lies in its own partition. Of several updates under one key the last by
    ``order`` stands. Null key parts are equal. Updates that are stored already change nothing: their partitions, like all that no update touches,
    keep their files. A table that isn't there yet is made. One writer at a time.
    """
    recover(spark, path, by)
    updates = upsert(updates.limit(0), updates, keys, *order)
    if not any(not c.startswith("_") for c in children(spark, path)):
        touched = _partitions(updates, by)
        if touched:
            _commit(spark, updates, path, by)
        return len(touched)
    target = _read(spark, path, updates.schema)
    near = target.where(_in(by, _partitions(updates, by)))
    touched = _partitions(updates.subtract(near.select(*updates.columns)), by)
    if touched:
        _commit(spark, upsert(target.where(_in(by, touched)).select(*updates.columns), updates.where(_in(by, touched)), keys), path, by)
    return len(touched)


def update_columns_stored(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], columns: Sequence[str], by: str) -> int:
    """Sets columns of stored rows whose key is in ``updates`` and whose new value isn't null; returns how many partitions were written.

    ``updates``: keys (``by`` among them, or derived beside them) and columns, one row a key; keys that aren't stored are ignored. Partitions in which nothing changes keep their files.
    """
    recover(spark, path, by)
    target = spark.read.parquet(path)
    on = list(dict.fromkeys([*keys, by]))
    near = target.where(_in(by, _partitions(updates, by)))
    other = [~F.col(f"_{c}").eqNullSafe(F.col(c)) & F.col(f"_{c}").isNotNull() for c in columns]
    new = updates.select(*on, *(F.col(c).alias(f"_{c}") for c in columns))
    changed = near.join(new, on)
    cond = other[0]
    for c in other[1:]:
        cond = cond | c
    touched = _partitions(changed.where(cond), by)
    if touched:
        _commit(spark, update_columns(target.where(_in(by, touched)), updates, on, columns).select(*target.columns), path, by)
    return len(touched)
