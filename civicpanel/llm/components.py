"""Connected components of a graph given by its edges, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, component): the smallest node that each node reaches.

    Edges are turned into stars around ever smaller centres, first towards larger neighbours,
    then towards smaller ones, until nothing changes. Every round is written to the shared
    folder; only its number of edges and a sum of hashes reach the driver.
    """
    now = _written(edges.where("a <> b"))
    before = None
    while (state := _state(now)) != before:
        before = state
        now = _written(_small_star(_written(_large_star(now))))
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(now.select("b", "b")).distinct()


def _written(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return written(ends.distinct(), "edges")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node around it."""
    both = edges.union(edges.select("b", "a"))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.union(smallest.select("a", F.col("m").alias("b")))
