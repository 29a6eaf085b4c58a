"""Connected components of an edge table, by hooking and shortcutting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import drop_written, written


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), longs -> node, label: the smallest node that a node reaches.

    Every node points at a parent, at first itself. In each round a node and
    its parent hook onto the smallest grandparent seen among the node's
    neighbours, then pointers are shortened. Rounds grow with the logarithm
    of the longest path; each is written to the shared folder, so a lost
    executor costs one round. All grouping is by minimum, combined before the
    shuffle, so a node with very many edges is no burden.
    """
    pairs = edges.filter("a <> b").select("a", "b")
    pairs = written(pairs.union(pairs.select("b", "a")).distinct(), "cc-edges")
    state = written(pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("parent")).withColumn("grand", F.col("parent")), "cc-start")
    old = None
    while True:
        seen = pairs.join(state.select(F.col("node").alias("b"), "grand"), "b").groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("seen"))
        both = state.join(seen, "node").withColumn("low", F.least("parent", "grand", "seen"))
        hooks = both.groupBy(F.col("parent").alias("node")).agg(F.min("low").alias("hook"))
        step = written(both.join(hooks, "node", "left").select(
            "node", F.least("low", F.coalesce("hook", "low")).alias("parent"), F.col("parent").alias("was"), F.col("grand").alias("grand_was")), "cc-step")
        up = step.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        new = written(step.join(up, "parent").select("node", "parent", "grand", (
            (F.col("parent") != F.col("was")) | (F.col("grand") != F.col("grand_was"))).alias("moved")), "cc-round")
        moved = new.filter("moved").limit(1).count()
        drop_written(step)
        if old is not None:
            drop_written(old)
        old = state = new
        if not moved:
            return state.select("node", F.col("grand").alias("label"))


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node that it reaches through pairs (a, b)."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, label = inv[:len(a)], inv[len(a):], np.arange(len(nodes))
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        if np.array_equal(label, old):
            break
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]
