"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import stored


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, low): each node's smallest neighbour or itself; combined in every task, so hot nodes are cheap."""
    low = edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    return low.select("n", F.least("n", "m").alias("low"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node in a link; the component is its smallest node.

    Links are rows of two longs, in any order, repeated or not.  Every step turns links towards smaller
    nodes until all point to the smallest of their component; each step is stored, so lost executors cost
    one step.  The number of steps grows with the logarithm of a component's diameter.
    """
    state = lambda e: e.agg(F.count("*"), F.sum("u"), F.sum("v"), F.bit_xor(F.xxhash64("u", "v"))).first()
    edges = stored(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while (now := state(edges)) != before:
        before = now
        # Large star: neighbours above a node move to the smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        # Small star: a node and its neighbours below move to the smallest of them.
        below = large.distinct()
        low = below.join(_lowest(below), F.col("u") == F.col("n"))
        small = low.select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", F.col("low").alias("v")))
        edges = stored(small.where("u != v").distinct())
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
