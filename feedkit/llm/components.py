"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.stored import Scratch


def _least(edges: DataFrame) -> DataFrame:
    """Least neighbour of each node; the name differs from the edges' so that a join shuffles both sides."""
    return edges.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "node")


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Does every node point to at most one root, and no root to anything?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return ends.where("out > 1 or (out > 0 and in > 0)").isEmpty()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the least node id reachable, for every node of ``edges(a, b)``.

    Runs at once, as alternating large-star and small-star rounds until every node points to its
    root; each round is written to the shared folder.  A node's least neighbour is an aggregate
    that combines before the shuffle, and is joined back, so no node's edges are gathered in one
    value.  Loops and repeated edges are fine; a node with only a loop is left out.
    """
    a, b = F.col("a"), F.col("b")
    now = scratch.write(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    while not _is_forest_of_stars(now):
        both = now.union(now.select(b.alias("a"), a.alias("b")))
        least = _least(both).withColumn("low", F.least("node", "low"))
        large = both.join(least, both.a == least.node).where(b > a).select(b.alias("a"), F.col("low").alias("b"))
        down = large.where(a != b)
        lows = _least(down)
        small = down.join(lows, down.a == lows.node).select(b.alias("a"), F.col("low").alias("b"))
        joined = small.union(lows.select(F.col("node").alias("a"), F.col("low").alias("b")))
        before, now = now, scratch.write(joined.where(a != b).distinct())
        scratch.drop(before)
    roots = now.select(b.alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(a.alias("node"), b.alias("component")).union(roots)
