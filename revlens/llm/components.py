"""Connected components of an edge table, by alternating large and small stars.

Each round is joins and minima on written tables; nothing is gathered in one place.
A node with a third of all edges is aggregated before the shuffle, and its side of
the join can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import written


def _stars(edges: DataFrame) -> bool:
    """No node has two smaller neighbours, or a smaller and a larger one: all is done.
    Counts are made before the shuffle, so it moves a row per node and task at most."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = up.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up = 1 and down = 1)").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): root is the smallest node
    linked to it. Nulls are left out; an edge to itself or a repeated edge adds nothing."""
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = written(edges.where("a is not null and b is not null").where("a <> b").select(a, b).distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # every larger neighbour of a node moves to the node's smallest
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every smaller neighbour, and the node, move to the node's smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = written(small.distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
