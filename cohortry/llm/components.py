"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a grouping and a join, so nothing grows beyond the number of links. Every round is written to the
shared folder, which keeps the lineage short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortry.scale import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are hung to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung to the smallest of them; rows have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    hung = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.union(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; the root is the smallest node of its component.

    ``edges`` has long columns a and b, in any direction, repeats and self links allowed.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = stage(ordered.distinct()), None
    while True:
        edges = stage(_small_star(_large_star(edges)).where("a <> b").distinct())
        # Stars are reached when the links no longer change; count and sum of hashes tell.
        now = tuple(edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
