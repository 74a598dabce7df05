"""Connected components of a graph given as pairs, by alternating large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is hung on the node's least neighbour; small star: every other smaller one and the node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    hung = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return hung.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the least node of its component.

    Node degrees may be any: a star's least neighbour is aggregated before the shuffle, and the join is split
    where a node is hot. Rounds grow with the logarithm of the longest chain.
    """
    edges = cut(edges.filter("a != b").select("a", "b"), "components")
    before = None
    while True:
        edges = cut(_star(_star(edges, True), False), "components")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
