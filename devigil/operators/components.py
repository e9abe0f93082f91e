"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    linked = both.filter("v > u").join(smallest, "u")
    return linked.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), "m")
    return linked.unionByName(smallest).select("u", F.col("m").alias("v")).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``u, v`` edges; a component is named after its minimum.

    The two star operations alternate until nothing changes. Neither gathers a neighbourhood in one
    task: both are a partially aggregated minimum and an equi-join.
    """
    oriented = edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current = cut_lineage(oriented.distinct())
    before = None
    while (now := _fingerprint(current)) != before:
        before = now
        current = cut_lineage(_small_star(_large_star(current)))
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
