"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.sources.scratch import materialise


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)`` that is not the smallest of its component.

    Alternates two steps until the edges are stars: every node links its larger neighbours, then its
    smaller ones and itself, to its smallest neighbour. Each is a minimum per node, combined before
    the shuffle, and a join; the number of edges never grows.
    """
    greater, less = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = materialise(edges.filter("a <> b").select(greater, less).distinct())
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(edges)
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        linked = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
