"""Resumable ingestion: Structured Streaming with a ledger of keys and content hashes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delta import _on
from ..operators.periods import pick
from ..sources.stored import bucket, exists, upsert_stored

#: Partitions of the ledger: a batch reads and rewrites those its keys fall to.
BUCKETS = 64


def content_hash(columns: Sequence[str]) -> Column:
    """A hash of a row's values; null is told from an empty text."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def ledger_rows(spark: SparkSession, target: str, buckets: Sequence[int], schema: str) -> DataFrame | None:
    """The ledger's rows of some buckets; files of others aren't even listed. None: there is nothing yet."""
    paths = [p for b in sorted(set(buckets)) if exists(spark, p := f"{target}/ledger/bucket={b}")]
    return spark.read.schema(schema).option("basePath", f"{target}/ledger").parquet(*paths) if paths else None


def ingest(
    spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str] | None = None,
    check: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet", step: str = "", by_content: bool = False,
) -> None:
    """Appends new rows of the files in ``source`` to ``target``; runs until all files are read.

    A row is taken once for each key or, ``by_content``, whenever its content differs from what was last taken under its key. The ledger tells: its rows (key, content hash, batch) lie in
    partitions by a hash of the key, and a batch reads the partitions of its own keys, so that its cost doesn't grow with all that was ever done.
    A batch is written again as a whole if it is retried (a folder for each batch), so a failure repeats nothing. ``check`` adds a column
    ``error``; rows with one go to ``<target>/failed`` with its message and are no done keys, the others to ``<target>/done``, and those that were done
    before to ``<target>/skipped``. An interrupted run goes on from the checkpoint; each ``step`` has its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        rows = pick(batch, keys, *(order or keys))
        rows = check(rows) if check else rows.withColumn("error", F.lit(None).cast("string"))
        entries = rows.select(*keys, content_hash(batch.columns).alias("hash"), F.lit(batch_id).cast("long").alias("batch"), bucket(keys, BUCKETS).alias("bucket"), "error")
        of = entries.drop("error")
        old = ledger_rows(s, target, [r.bucket for r in of.select("bucket").distinct().collect()], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in of.schema))
        # what a former try of this batch entered isn't done yet
        old = old.where(F.col("batch") != batch_id) if old is not None else of.limit(0)
        rows = rows.withColumn("hash", content_hash(batch.columns))
        on = [*keys, "hash"] if by_content else list(keys)
        old = old.select(*on)
        rows.join(old, _on(rows, old, on), "left_semi").drop("error", "hash").write.mode("overwrite").parquet(f"{target}/skipped/batch={batch_id}")
        new = rows.join(old, _on(rows, old, on), "left_anti").drop("hash")
        new.where("error IS NULL").drop("error").write.mode("overwrite").parquet(f"{target}/done/batch={batch_id}")
        new.where("error IS NOT NULL").write.mode("overwrite").parquet(f"{target}/failed/batch={batch_id}")
        done = s.read.schema(batch.schema).parquet(f"{target}/done/batch={batch_id}")
        entered = done.select(*keys, content_hash(batch.columns).alias("hash"), F.lit(batch_id).cast("long").alias("batch"), bucket(keys, BUCKETS).alias("bucket"))
        upsert_stored(s, f"{target}/ledger", entered, keys, "bucket", "batch")

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{step}" if step else checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingested(spark: SparkSession, target: str, schema: str, kind: str = "done", keys: Sequence[str] = ()) -> DataFrame:
    """What was taken (or failed, or was skipped); with ``keys``, the last version of each."""
    extra = ", error string" if kind == "failed" else ""
    rows = spark.read.option("recursiveFileLookup", True).schema(schema + extra).parquet(f"{target}/{kind}")
    if not keys:
        return rows
    batch = F.regexp_extract("_metadata.file_path", r"/batch=(\d+)/[^/]*$", 1).cast("long")
    return pick(rows.withColumn("_batch", batch), keys, F.desc("_batch")).drop("_batch")


def progress(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """Rows done, failed and skipped so far: state, n_rows; a state that hasn't occurred has no row."""
    states = [f"{target}/{k}" for k in ("done", "failed", "skipped") if exists(spark, f"{target}/{k}")]
    one = spark.read.option("recursiveFileLookup", True).schema(schema).parquet(*states)
    return one.groupBy(F.regexp_extract("_metadata.file_path", r"/(done|failed|skipped)/batch=\d+/[^/]*$", 1).alias("state")).agg(F.count("*").alias("n_rows"))
