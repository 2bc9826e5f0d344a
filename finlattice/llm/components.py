"""Connected components of an edge table, by repeated hooking and contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, release


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star forest of the edges (a, b): each node but the smallest of its component, and that smallest."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new[label]]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _order(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the edges ``(a, b)`` that isn't the smallest of its component.

    Each round hooks every node to its smallest smaller neighbour, shortens the chains, and contracts
    the edges; a round at least halves the nodes that still have edges. Aggregations are minima, which
    combine before the shuffle, and the joins are plain equi-joins that AQE may split, so a node with
    very many edges isn't gathered in one task. Null ends are ignored.
    """
    left = durable(_order(edges.where("a IS NOT NULL AND b IS NOT NULL")), "edges")
    labels, again = None, False
    while not left.isEmpty():
        up = left.groupBy("a").agg(F.min("b").alias("p"))
        nxt = up.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        once = durable(up.join(nxt, "p", "left").select("a", F.coalesce("pp", "p").alias("p")), "parents")
        nxt = once.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        up = durable(once.join(nxt, "p", "left").select("a", F.coalesce("pp", "p").alias("p")), "parents")
        release(once)
        moved = up.select(F.col("a").alias("label"), "p")
        own = up.select(F.col("a").alias("node"), F.col("p").alias("label"))
        if labels is None:
            labels = own
        else:
            kept = labels.join(moved, "label", "left").select("node", F.coalesce("p", "label").alias("label"))
            former = labels if again else None
            labels, again = durable(kept.unionByName(own), "labels"), True
            release(former)
        ends = left.join(up, "a").select(F.col("p").alias("a"), F.col("b"))
        ends = ends.join(up.select(F.col("a").alias("b"), "p"), "b", "left").select("a", F.coalesce("p", "b").alias("b"))
        former, left = left, durable(_order(ends), "edges")
        release(former)
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    # a node over four steps below its root comes back in later rounds; its rows all end at that root
    return labels.groupBy("node").agg(F.min("label").alias("label")) if again else labels
