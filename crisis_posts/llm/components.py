"""Connected components of an undirected graph that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crisis_posts.llm.shared import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of the edges (a, b); a component is its smallest node.

    Rounds of large and small stars: every node's neighbours are tied to the smallest of them,
    first those above the node, then those below. A node of many edges is one row for each
    edge, never one group. Each round is written to the shared folder.
    """
    edges = written(_ordered(edges))
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        edges = written(_small_star(_large_star(edges)))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct (smaller, larger)."""
    return (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b").distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to its smallest neighbour, or to the node itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return _ordered(
        both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    below = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return _ordered(below.unionByName(least.select(F.col("m").alias("a"), "b")))
