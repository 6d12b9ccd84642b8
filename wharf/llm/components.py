"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = materialise(down.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected links (u, v); root is the
    smallest node reachable. Nodes may be of any orderable type; null ends,
    loops and repeated links count for nothing.

    A step is two aggregations, combined before the shuffle, each joined back to
    the links, so a node with very many links is spread over tasks. It is
    repeated until nothing changes: about the logarithm of the longest path. The
    aggregates are written, which leaves each join a shuffle that AQE can split.
    """
    edges = links.select("u", "v").where("u <> v").distinct()
    last = None
    while True:
        edges = materialise(_small_star(_large_star(edges)).distinct(), "components")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if state == last:
            return edges.toDF("node", "root")
        last = state
