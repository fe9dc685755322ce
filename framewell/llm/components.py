"""Connected components of a graph held as a table of edges.

Alternating star contraction: every node's neighbours are tied to the smallest of
them, first the larger neighbours, then the smaller ones, until each component is one
star around its smallest node.  The edges never grow beyond the input's number,
rounds grow with the logarithm of the nodes, and every round is written to the shared
folder, so a lost executor costs one round.  Neighbours of a hub with many edges are
never brought together: minima fold before the shuffle and hot hubs are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.llm.common import join_classes
from framewell.plans.settle import release, settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    tied = join_classes(both, least, "u", "n").where("v > u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge points from the larger node u to the smaller v
    least = settle(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    tied = join_classes(edges, least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is tied to one centre, or is one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("tied"), F.lit(0).alias("centre"))
    ends = ends.union(edges.select(F.col("v").alias("node"), F.lit(0).alias("tied"), F.lit(1).alias("centre")))
    roles = ends.groupBy("node").agg(F.sum("tied").alias("tied"), F.max("centre").alias("centre"))
    return not roles.where(F.col("tied") + F.col("centre") > 1).take(1)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``u, v`` edges; a component is named by its smallest node."""
    now = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _all_stars(now):
        large = settle(_large_star(now), "large")
        following = settle(_small_star(large), "small")
        release(now, large)
        now = following
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = settle(stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct(), "components")
    release(now)
    return out
