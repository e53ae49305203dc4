"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns ``a``, ``b``);
    the component is its smallest node.

    Large-star and small-star steps in turn, each a minimum per node joined back to
    the edges, until nothing changes; the number of rounds grows with the logarithm
    of the longest chain. Each round is stored, so lineage stays short and a lost
    executor costs one round at most. Nothing but two numbers a round reaches the driver.
    """
    at = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        at = materialize(_small_star(_large_star(at)))
        state = at.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"), F.bit_xor(F.hash("b", "a")).alias("g")).first()
        if state == seen:
            break
        seen = state
    # now a star: every edge leads from a node to the smallest of its component
    return at.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        at.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
