"""Connected components as DataFrame joins: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete, stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for edges (a, b) of longs: root is the smallest node that links reach. Lone nodes are absent.

    Each step shuffles the edges alone; neighbours are reduced to their minimum before they are joined
    back, so a node with very many neighbours is never gathered in one task. Edges end as stars.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # large star: larger neighbours move to the smallest node around
        around = _both(now)
        least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: smaller neighbours, and the node itself, move to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a")
        small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(moved.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        after = stored(small)
        # stars: nobody is both a leaf and a root, and each leaf has one root
        delete(now)
        roots = after.select(F.col("b").alias("a")).distinct()
        if after.join(roots, "a", "left_semi").isEmpty() and after.groupBy("a").count().filter("count > 1").isEmpty():
            leaves = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return leaves.unionByName(roots.select(F.col("a").alias("node"), F.col("a").alias("root")))
        now = after
