"""Connected components of a distributed graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import settle


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1)))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the least node reached.

    Each step is an aggregation and a join over the edges, written to the shared folder;
    a node's neighbours are never gathered.  The number of steps grows with the logarithm of
    the longest path.
    """
    edges = settle(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    while True:
        # Large star: every greater neighbour of a node is tied to the node's least one.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")), "large-star")
        large = settle(both.join(least, "a").where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large-edges")
        # Small star: a node and its lesser neighbours are tied to the least of them.
        least = settle(large.groupBy("a").agg(F.min("b").alias("m")), "small-star")
        tied = large.join(least, "a")
        small = tied.select("a", F.col("m").alias("b")).unionByName(
            tied.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
        edges = settle(small.distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return settle(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "components")
