"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node is either linked to one smaller node or only linked to."""
    ends = edges.select(F.expr("inline(array(struct(a AS node, 1 AS up, 0 AS down), struct(b AS node, 0 AS up, 1 AS down)))"))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR (up = 1 AND down = 1)").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns) that isn't its
    component's smallest node; the smallest one and unlinked nodes have no row.

    Every round joins each edge to its end's smallest neighbour (a map-side combined
    aggregate) and writes the new edges to the shared folder; rounds grow with the
    logarithm of the longest path. Null ends, loops and repeated edges have no effect.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = stored(e, "edges")
    while not _is_stars(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # stored, so that Spark can split the shuffle of a node with many links
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = stored(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .distinct(), "large_star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        e = stored(small.distinct(), "small_star")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (a, b) of one task as links of each node to the smallest one that it
    reaches by them: fewer links, the same components."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        now = root.copy()
        np.minimum.at(now, root[x], low)
        np.minimum.at(now, root[y], low)
        now = now[now]
        if (now == root).all():
            break
        root = now
    child = root != np.arange(len(nodes))
    return nodes[child], nodes[root[child]]
