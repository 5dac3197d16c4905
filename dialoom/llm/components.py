"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """edges: rows of u, v (long). Gives rows of node, label: the smallest node that each node of an edge can reach.

    Every round writes its edges to the shared folder. Rounds end when the edges are stars. Loops, repeated edges and either direction are fine; no edges, no rows.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, step = scratch.keep(edges, f"{name}-0"), 0
    while True:
        # done when every node either has one smaller neighbour, which has none itself, or none
        ends = edges.select(F.col("u").alias("node"), "v").unionByName(edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("v")))
        roles = ends.groupBy("node").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.max(F.col("v").isNull()).alias("is_root"))
        if roles.where("lo <> hi or (is_root and lo is not null)").isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        step += 1
        edges = scratch.keep(small.where("u <> v").distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
