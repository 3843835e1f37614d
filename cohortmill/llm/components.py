"""Connected components of a table of links, by contraction towards the least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.sources.checkpoints import written


def _stars(links: DataFrame) -> DataFrame:
    """One round: larger neighbours of each node move to its least neighbour, then smaller ones and itself.

    Nodes meet their least neighbour through a count with partial results and a join, so a node with very
    many neighbours is split between tasks.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_least"))
    least = least.withColumn("_least", F.least("_a", "_least"))
    moved = both.join(least, F.col("a") == F.col("_a")).filter("b > a")
    moved = moved.select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()
    least = moved.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_least"))
    ends = moved.join(least, F.col("a") == F.col("_a"))
    others = ends.filter("b > _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return others.union(least.select(F.col("_a").alias("a"), F.col("_least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that is linked to another, from links (a, b) of 64-bit numbers.

    The root is the least node of the component. Each round is written to the shared folder; rounds grow
    with the logarithm of the longest chain.
    """
    links = links.filter("a <> b").select("a", "b").distinct()
    before = None
    while True:
        links = written(links)
        count, total = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if count == 0 or (count, total) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = (count, total)
        links = _stars(links)
