"""Helpers shared by the corpus operators: durable intermediates and column checks."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see, from ``spark.checkpoint.dir``; a temporary one in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "finlattice-shared")


#: Deletes a job's shuffle files when it ends; of a table that is written nothing reads them again.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of a batch that Python workers get.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def durable(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage and survives lost executors.

    ``batch_rows``: rows that Python workers get at once, for wide ones, as a batch is held by the JVM and by the worker.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    wanted = {TIDY: "true"} | ({BATCH_ROWS: str(batch_rows)} if batch_rows else {})
    before = {k: conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.set(k, v) if v is not None else conf.unset(k)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.durable_path = path
    _MADE.append(path)
    return back


#: Folders of durable frames that this process has made and not released.
_MADE: list[str] = []


def clean_up(spark: SparkSession) -> None:
    """Deletes the folders of all durable frames left, also those that results still read: for callers that have written or collected what they need."""
    while _MADE:
        _delete(spark, _MADE.pop())


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def release(*frames: DataFrame | None) -> None:
    """Deletes the folders of durable frames that nothing reads any more."""
    for df in frames:
        if (path := getattr(df, "durable_path", None)) is not None:
            _delete(df.sparkSession, path)
            if path in _MADE:
                _MADE.remove(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_hash(columns: tuple[str, ...], seed: int) -> Column:
    """A 64-bit hash of a row's values that tells which of them are null."""
    return F.xxhash64(F.lit(seed), *columns, *(F.col(c).isNull() for c in columns))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows: what a worker holds beside a batch is bounded by a slice."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def parts(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: the session's shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys that may hold over 1 / HOT_KEYS of all rows are so many at most; HOT_ROWS: keys of fewer rows are never hot.
HOT_KEYS, HOT_ROWS = 10_000, 1_000


def join_spread(rows: DataFrame, values: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``values`` (one row for each key), no task of which gets all rows of a frequent key.

    Keys of over 1 / HOT_KEYS of the rows, HOT_KEYS of them at most, are joined by broadcast where their rows are; the others
    by a shuffle. ``rows`` should be durable, as they are read twice.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    limit = F.greatest(F.lit(HOT_ROWS), F.lit(rows.count() / HOT_KEYS))
    hot = durable(counts.where(F.col("n") > limit).select(key), "hot-keys")
    if hot.isEmpty():
        return rows.join(values, key, how)
    hot = F.broadcast(hot)
    some = rows.join(hot, key, "left_semi").join(F.broadcast(values.join(hot, key, "left_semi")), key, how)
    return some.unionByName(rows.join(hot, key, "left_anti").join(values, key, how))
