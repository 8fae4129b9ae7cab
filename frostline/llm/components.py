"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.session import stage, unstage


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node of ``a``-``b`` to the smallest node of its component; as many as nodes at most."""
    nodes, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ids[: len(a)], ids[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    far = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[far], nodes[root[far]]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has an edge ``a, b``; the root is the smallest node reachable.

    Large-star hangs every larger neighbour on the smallest one, small-star the smaller ones, in turn until nothing
    changes: O(log² n) rounds whatever the shape of the graph. Minima combine before the shuffle; every round is staged
    in the shared folder, so lineage stays short. Null ends and loops are no edges; repeated edges count once.
    """

    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("m"))

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    known = state(now)
    while known[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.where("b > a")
            .join(smallest(both).select("a", F.least("a", "m").alias("m")), "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        low = smallest(large)
        small = (
            large.join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        after = stage(small)
        found = state(after)
        unstage(now)
        now, same, known = after, found == known, found
        if same:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
