"""Connected components of a distributed edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, spool


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: u > v in every row."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (u, v): the smallest node that it reaches.

    Each round is written to the shared folder; hot nodes are pre-aggregated, and joins on them can be split.
    Loops and repeated edges do no harm; null ends are ignored.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), F.col("u").isNotNull().alias("a"), F.col("v").isNotNull().alias("b")).where("a AND b AND u <> v")
    edges = spool(edges.select("u", "v").distinct(), "edges")
    while True:
        before, edges = edges, spool(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        discard(before)
        # done when every node hangs on one centre and no centre hangs on another
        twice = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        chained = edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_semi")
        if not twice.union(chained.select(F.col("v").alias("u"))).take(1):
            break
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
