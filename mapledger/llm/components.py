"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of edges (u, v), except each component's smallest node.

    The component is named by its smallest node; nodes may be of any type
    that has an order. Rounds of large and small stars (each node's larger,
    then smaller neighbours are hung on its smallest one) turn every
    component into one star. Each round is written to the shared folder, so a
    lost executor costs one round at most. Only minima are gathered per node,
    in partial aggregates; the hub of a large star is an ordinary skewed join
    side, which adaptive execution splits.
    """
    current = stage(_downward(edges.select("u", "v")), "edges")
    while not _is_star_forest(current):
        current = stage(_small_star(_large_star(current)), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _downward(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    ends = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    return edges.where(F.col("u") != F.col("v")).select(*ends).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    larger = both.where(F.col("v") > F.col("u"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node hangs on one other only, and that one on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.where((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("holds") > 0))).isEmpty()
