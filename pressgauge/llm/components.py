"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from pressgauge.llm.common import join_unique
from pressgauge.sinks.files import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node) that connect what the given pairs connect."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    rest = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[rest], nodes[root[rest]]


def _mark(edges: DataFrame) -> tuple[int, object]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the component's smallest node.

    Each round rewrites the edges to point at smaller neighbours; it ends when every component is a
    star. Rounds are written to the shared folder, so no lineage grows. Empty edges give no rows.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = stored(now.union(now.select("b", "a")), "edges")
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        linked = join_unique(both, least, "a", "n", 2 * mark[0])
        large = stored(linked.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        linked = join_unique(large, least, "a", "n", 2 * mark[0])
        small = linked.select("b", "m").where("b <> m").toDF("a", "b").union(least.select("a", "m")).distinct()
        now, last = stored(small, "edges"), mark
        mark = _mark(now)
        if mark == last:
            break
    return now.toDF("node", "root").union(now.select("b", "b").distinct())
