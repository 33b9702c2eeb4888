"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from every node that has an edge.

    Each round points every node's larger neighbours at the smallest one, then its smaller neighbours; the
    number of edges does not grow and the rounds are logarithmic in the diameter. Loops and repeats are fine.
    """
    found = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    found = cut_lineage(found)
    while not _stars(found):
        both = found.union(found.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        found = cut_lineage(small)
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every edge ends at a node that has none to a smaller one, and no node has two."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down")).union(edges.select("v", F.lit(0)).distinct())
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.count("*").alias("n")).filter("down > 0 AND n > 1").isEmpty()
