"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityloom.session import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbor of a node to the smallest node around it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbors to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node, as (node, root).

    ``links`` has two bigint columns (a, b), in any direction and repeated or not. Large and small stars alternate
    until nothing changes; then every link points to its root. Each round is a staged table, and only its count and checksum reach the
    driver. A node with very many neighbors costs one aggregated row per task and a join that run-time execution splits.
    """
    current = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(current)
    while state[0]:
        current = stage(_small_star(_large_star(current).distinct()).distinct(), "stars")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
