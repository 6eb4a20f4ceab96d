"""Connected components of a graph given by its edges.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014).  Every step is a minimum per
node, combined before the shuffle and written, and a join with it: broadcast if it
is counted to be small, else a join of two plain shuffles, in which Spark splits a
hub of any degree (it does not where the same stage holds the aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, small_side, write_table


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Every neighbour of ``u`` (the larger or the smaller ones) linked to the least of them and ``u``."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(back) if larger else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = write_table(near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least-neighbours")
    joined = near.join(small_side(least), "u")
    if larger:
        return joined.filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def _is_star(edges: DataFrame) -> bool:
    """Whether each node is either a centre or has one edge, to a centre."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.filter("out > 1 or (out > 0 and into > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (u, v: long)."""
    pairs = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = write_table(pairs.distinct(), "edges")
    while not _is_star(now):
        after = write_table(_star(_star(now, larger=True), larger=False), "edges")
        drop_table(now)
        now = after
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
