"""Connected components of a graph in tables, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.staging import stored


def _least(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node; written, so that the join after it can split hubs."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("least")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its greater neighbours to the least one of it and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_least(both), "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its lesser neighbours to the least of them; here ``v < u``."""
    tied = edges.join(_least(edges), "u")
    return (
        tied.select(F.col("v").alias("u"), F.col("least").alias("v"))
        .union(tied.select("u", F.col("least").alias("v")))
        .where("u <> v")
        .distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(u, v)``: the least node reachable.

    A node has at most one row. Links may repeat and stand either way round; loops are
    left out. The number of rounds grows with the logarithm of the longest chain.
    """
    edges = stored(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = _signature(edges)
    while True:
        edges = stored(_small_star(stored(_large_star(edges), "large")), "small")
        now = _signature(edges)
        if now == before:
            break
        before = now
    # stars now: every node points at the least of its component
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
