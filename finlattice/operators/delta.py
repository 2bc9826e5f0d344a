"""Incremental work: deltas, resumes, splits and changed content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .periods import pick


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def delta(current: DataFrame, previous: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First rows of the keys of ``current`` that ``previous`` doesn't have; null key parts are equal."""
    new = pick(current, keys, *order)
    old = previous.select(*keys).distinct()
    return new.join(old, _on(new, old, keys), "left_anti")


def unfinished(items: DataFrame, ledger: DataFrame, keys: Sequence[str], hash_column: str | None = None) -> DataFrame:
    """Items not in the ledger, or there with another content hash; null key parts are equal."""
    on = [*keys, hash_column] if hash_column else list(keys)
    done = ledger.select(*on).distinct()
    return items.join(done, _on(items, done, on), "left_anti")


def finished(items: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items in the ledger; null key parts are equal."""
    done = ledger.select(*keys).distinct()
    return items.join(done, _on(items, done, keys), "left_semi")


def listed(items: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items to run again, whatever the ledger says; null key parts are equal."""
    again = wanted.select(*keys).distinct()
    return items.join(again, _on(items, again, keys), "left_semi")


def split_ready(pages: DataFrame, skip: DataFrame, corrupted: DataFrame, key: str) -> DataFrame:
    """``pages`` with ``state``: skip, corrupted or ready; skip wins."""
    s = skip.select(key).distinct().withColumn("_skip", F.lit(True))
    c = corrupted.select(key).distinct().withColumn("_bad", F.lit(True))
    state = F.when(F.col("_skip"), "skip").when(F.col("_bad"), "corrupted").otherwise("ready")
    return pages.join(s, key, "left").join(c, key, "left").withColumn("state", state).drop("_skip", "_bad")


def merge_lists(*lists: DataFrame) -> DataFrame:
    """Distinct union."""
    out = lists[0]
    for x in lists[1:]:
        out = out.unionByName(x)
    return out.distinct()


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Rows of ``updates`` replace those of ``target`` with their key; of several under one key the last by ``order`` stands."""
    both = target.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return pick(both, keys, F.desc("_new"), *(F.desc(c) for c in order)).drop("_new")


def update_columns(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns of ``target`` taken from ``updates`` where the key is there and the value isn't null."""
    new = updates.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    return target.join(new, list(keys), "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop(*(f"_{c}" for c in columns))
