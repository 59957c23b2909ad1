"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir


def _mark(edges: DataFrame) -> tuple:
    """A number that tells two edge lists apart, and their length."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v): the least node reachable.

    Every step links a node's neighbours to its least one, so no task ever
    holds a component; a hub's edges are rows that a skewed join may split.
    Lineage is cut by a reliable checkpoint in every round.
    """
    shared_dir(edges.sparkSession)
    now = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
           .checkpoint())
    mark = _mark(now)
    while True:
        # large star: neighbours above a node are linked to its least neighbour
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its lower neighbours are linked to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = small.checkpoint()
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
