"""Connected components by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.session import cut_lineage


def _nearest(edges: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node near it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    near = _nearest(down)
    linked = down.join(near, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return linked.union(near.select("u", F.col("least").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Nodes of an undirected graph with the smallest node of their component: node, label.

    ``edges`` has columns u, v. Each round links nodes straight to the smallest node they can see,
    so the rounds grow with the logarithm of the longest chain; it ends when every node hangs on
    exactly one node, and that one on none. Rounds are written as tables, no node or link reaches the
    driver, and the neighbours of one node are never gathered. The smallest nodes themselves are
    part of the result where they have links.
    """
    edges = cut_lineage(edges.where("u <> v").select("u", "v").distinct())
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        roots = edges.select(F.col("v").alias("root")).distinct()
        torn = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if torn.isEmpty() and edges.join(roots, F.col("u") == F.col("root"), "left_semi").isEmpty():
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        roots.select("node", F.col("node").alias("label"))
    )
