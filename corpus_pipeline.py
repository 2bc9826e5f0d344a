"""A corpus cleaning pipeline of five stages; each stage's result is written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlattice.llm import lang_id, mixing, ngram_join, secrets, sentencepiece_codec
from finlattice.llm.common import durable, release, row_hash, table

#: Copies of one row that are written out at a time.
RUN = 10_000
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no language (null, or without a letter); a missing lang is filled with the prediction."""
    found = lang_id.with_language(docs.select(*COLUMNS)).where("lang_pred <> 'und'")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest doc_id (null last) of each group that five-word shingles link at 0.8 or more.

    Rows are told apart by 128 bits of their values, as doc_id may be null or repeated; of equal rows any one is kept. Rows without words all stay.
    """
    keyed = docs.select(*COLUMNS).withColumns({"h1": row_hash(COLUMNS, 1), "h2": row_hash(COLUMNS, 2)})
    labels = durable(ngram_join.similarity_labels(keyed, k=5, num=4, den=5, keep=("h1", "h2")), "labels")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "h1", "h2")).alias("first")
    kept = labels.where("label IS NOT NULL").groupBy("label").agg(first).select("first.h1", "first.h2")
    wordless = labels.where("label IS NULL").select("h1", "h2").distinct()
    # equal rows first become one, before the shuffle where they meet
    one = keyed.join(kept, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(*(F.first(c).alias(c) for c in COLUMNS))
    return one.select(*COLUMNS).unionByName(keyed.join(wordless, ["h1", "h2"], "left_semi").select(*COLUMNS))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret's span, in whatever encoding, by a mark; n_chars follows."""
    return secrets.mask_secrets(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mixture of sources asks for: a row for each copy.

    Rows are keyed by a hash of their values, as doc_id may be null or repeated. Equal rows become one before the shuffle where
    they meet, and that one is taken as often as they are in sum.
    """
    keyed = docs.select(*COLUMNS).withColumn("row", row_hash(COLUMNS, 1))
    drawn = mixing.mix_sources(keyed.select(F.col("row").alias("doc_id"), "text", "source"))
    copies = drawn.groupBy(F.col("doc_id").alias("row")).agg(F.sum("copies").alias("copies")).where("copies > 0")
    one = keyed.groupBy("row").agg(*(F.first(c).alias(c) for c in COLUMNS))
    runs = one.join(copies, "row").select(*COLUMNS, "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN))).alias("run"))
    return runs.select(*COLUMNS, F.explode(F.sequence(F.col("run") * RUN + 1, F.least(F.col("copies"), (F.col("run") + 1) * RUN))).alias("copy")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document; decoding them is checked."""
    return sentencepiece_codec.sentencepiece_encode(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scan", hide_secrets),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: Kernels, hashes and random rounding aren't for SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        former, docs = docs, durable(stage(spark, docs, sf_dir), name)
        release(former)
    return STAGES[-1][1](spark, docs, sf_dir)
