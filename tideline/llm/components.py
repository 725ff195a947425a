"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected to, for all nodes of links.

    Links are rewired in turns. Every node's larger neighbours are linked to its smallest
    neighbour or itself, and then its smaller neighbours are; after a number of turns that
    grows with the logarithm of the longest path, every node is linked to its smallest one
    alone. All steps are aggregates and joins by node, whose work a node with many links
    doesn't gather in one task: minima combine first, and the join's rows can be split.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stored(edges.distinct())
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)))
        # Both numbers stay as they are when no link was rewired any more.
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(roots.distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = stored(least.select("u", F.least("u", "m").alias("m")))
    found = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return found.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # All neighbours are smaller here: u > v.
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")))
    found = edges.join(least, "u")
    rewired = found.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rewired.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
