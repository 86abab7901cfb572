"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.tables import landed


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Every round points the neighbours of each node at the smallest of them. All
    work is joins and grouped minima, the edges land in the shared folder after
    each round, and only a count and a checksum reach the driver. Self loops and
    null ends are ignored.
    """
    current = landed(_oriented(edges), "edges")
    seen = _mark(current)
    while True:
        current = landed(_small_star(_large_star(current)), "edges")
        mark = _mark(current)
        if mark == seen:
            break
        seen = mark
    roots = current.select(F.col("b").alias("node")).distinct()
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(roots.withColumn("component", F.col("node")))


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, as (larger, smaller)."""
    return (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    moved = both.filter(F.col("v") > F.col("u")).join(smallest, "u")
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").filter(F.col("b") != F.col("m"))
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    key = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(key)).first())
