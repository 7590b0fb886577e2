"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terraloom.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) of every node that has a link to another one.

    Large-star and small-star steps in turn: each node is hung under the
    smallest node it knows, until nothing changes.  Rounds grow with the
    logarithm of the longest chain.  Each round is a written table; a node with
    very many links is summed before the shuffle and split by adaptive joins.
    Links with a null end or to themselves are ignored; repeated ones count once.
    """
    edges = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("v") != F.col("u"))).distinct()
    while True:
        edges = saved(_small_star(_large_star(edges)), "links")
        # Done when each node hangs under one that hangs under none.
        twice = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v")
        deep = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi").select(F.col("u").alias("v"))
        if not twice.union(deep).take(1):
            break
    # Every other node now hangs directly under the smallest of its component.
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        edges.select("u", "u")).groupBy("node").agg(F.min("component").alias("component"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("v", "u").union(edges.select("u", "v")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("_m")).select(F.col("node"), F.least("node", "_m").alias("_m"))
    return both.filter(F.col("other") > F.col("node")).join(least, "node").select(
        F.col("other").alias("v"), F.col("_m").alias("u")).filter("v <> u").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    edges = edges.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u"))
    least = edges.groupBy("v").agg(F.min("u").alias("_m"))
    moved = edges.join(least, "v").filter(F.col("u") != F.col("_m")).select(F.col("u").alias("v"), F.col("_m").alias("u"))
    return moved.union(least.toDF("v", "u")).distinct()
