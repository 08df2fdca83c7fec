"""Connected components of links held in a table (shared by operators 3 and 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.support import pinned


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``id`` and ``component_id`` (the smallest id reachable) of every id on a link.

    ``links`` has the columns a and b.  Each round hooks: every node's links move to the
    smallest neighbour of that node, first among all neighbours, then among the smaller ones,
    until every link points from a node straight to its smallest.  Minima are combined before
    their shuffle, and the joins that bring them back split hot nodes, so a star of any size
    stays spread.  The number of rounds grows with the logarithm of the longest path.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = pinned(links, "links")
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Neighbours above a node go to the smallest of its neighbourhood.
        up = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = up.where("a <> b").distinct()
        # Then what lies below a node, and the node, go to the smallest below it.
        least = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(least, "a")
        moved = (
            down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        moved = pinned(moved, "links")
        # Done when no node is both above one and below another, and none has two roots.
        inner = moved.select("a").join(moved.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count()
        twice = moved.groupBy("a").count().where("count > 1").limit(1).count()
        links = moved
        if not inner and not twice:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("b").alias("id")).distinct().withColumn("component_id", F.col("id"))
    return links.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(roots)
