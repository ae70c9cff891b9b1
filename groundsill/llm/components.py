"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsill.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(
        F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node that has a smaller one beside it has just one, and is itself no centre."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("centre"), F.lit(0).alias("leaf"))
    ends = ends.unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("centre"), F.lit(1).alias("leaf")))
    return ends.groupBy("n").agg(F.max("centre").alias("centre"), F.sum("leaf").alias("leaf")).where(
        "leaf + centre > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a < b``): the smallest node
    reachable. Each round is written to the shared folder, which cuts lineage; rounds end once all
    that is left is stars around the smallest node, which most groups are after one round."""
    edges = materialize(links.select("a", "b").distinct())
    while not _settled(edges):
        edges = materialize(_small_star(_large_star(edges)))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
