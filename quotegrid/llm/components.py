"""Connected components of a distributed list of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.session import materialize


def _min_neighbour(pairs: DataFrame) -> DataFrame:
    """Smallest of a node and its neighbours; combined before the shuffle, so a hub is no hot group."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.where("v > u").join(_min_neighbour(both), "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. ``edges`` go from larger to smaller."""
    least = _min_neighbour(edges)
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node is tied to one smaller node that is tied to none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest member) of every node that has a link to another one.

    Links with a null end or from a node to itself say nothing. Each round is written to the shared
    folder, so a lost executor costs one round; the driver gets one row per round at most.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = materialize(ends.where("u > v").distinct(), "links")
    while not _settled(now):
        now = materialize(_small_star(_large_star(now)), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def with_links(found: DataFrame, more: DataFrame) -> DataFrame:
    """What ``connected_components`` gives for the links behind ``found`` and these further ones, ``a`` and ``b``."""
    tied = found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(tied.unionByName(more.select("a", "b")))
