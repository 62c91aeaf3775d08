"""Connected components of a table of links, by alternating large and small stars.

Every step is an ordinary aggregate and join whose result is written to the shared folder,
so a lost executor costs one step, and links never reach the driver. The number of steps
grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """Link neighbours to the least neighbour: the smaller ones and the node itself, or the greater ones.

    The least neighbour of a node comes from an aggregate with partial states, and joins
    back to the node's links, so a node with many links is never gathered in one task.
    """
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    near = pairs.join(least, "a")
    if small:
        out = near.where(F.col("b") <= F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    else:
        out = near.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links(a, b)``: root is the least node of its component.

    Self-links and repeated links count once; nulls don't link; an empty table stays empty.
    """
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    mark = None
    while True:
        large = materialise(_star(_both(now), small=False), "large-star")
        now = materialise(_star(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), small=True), "small-star")
        new = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
