"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmbook.llm.shared import settle


def _star(edges: DataFrame, large: bool, folder: str, name: str) -> DataFrame:
    """One step: neighbours of a node are tied to the smallest of them.

    The smallest neighbours are written first: both sides of the join then have
    a shuffle of their own, which the adaptive engine can split at a hub.
    """
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))  # a > b
    if large:
        ends = ends.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    lowest = settle(ends.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), folder, f"{name}-lowest")
    tied = ends.join(lowest, "u")
    if large:
        tied = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        tied = tied.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        tied = tied.select(F.col("e.v").alias("a"), F.col("e.m").alias("b"))
    return settle(tied.where("a > b").distinct(), folder, name)


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, component (smallest node reachable) of every node that has an edge (a, b) to another."""
    tidy = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = settle(tidy, folder, "edges")
    state, turn = None, 0
    while True:
        found = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if found == state:
            break
        state, turn = found, turn + 1
        edges = _star(edges, True, folder, f"large-{turn}")
        edges = _star(edges, False, folder, f"small-{turn}")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
