"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _is_forest_of_stars(e: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none if it has larger ones."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return per.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that edges (a, b) lead to, for each node with an edge.

    Every round is stored, so a lost executor repeats one round.  Hubs are combined
    map-side; the join that hands a hub's minimum to its neighbours is an equi-join that
    adaptive execution splits.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = store(e, "edges")
    while not _is_forest_of_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = store(small.filter("u <> v").distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
