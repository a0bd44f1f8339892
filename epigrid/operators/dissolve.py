"""Spatial dissolve (G1) and the map-ready table.

Polygons are WKT ``POLYGON`` or ``MULTIPOLYGON`` text; every ring of every part
counts, holes too.  EMPTY and NULL geometries have no segments.
Dissolving districts into provinces is done by edge cancellation: every ring
is exploded into undirected segments, segments are counted per province, and
a segment seen an even number of times is interior (shared by two districts of
the same province).  The odd ones form the province boundary.  This is exact
when neighbouring polygons share vertices, as administrative tilings do, and
it never gathers a province's geometry into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import join_null_safe


def rings(wkt: Column) -> Column:
    """WKT polygons -> ``array<array<struct<x:double,y:double>>>``: the points of each ring."""
    texts = F.regexp_extract_all(F.coalesce(wkt, F.lit("")), F.lit(r"\(([^()]+)\)"), 1)
    return F.transform(texts, lambda ring: F.transform(F.split(ring, r"\s*,\s*"), lambda p: F.struct(
        F.split(F.trim(p), r"\s+").getItem(0).cast("double").alias("x"),
        F.split(F.trim(p), r"\s+").getItem(1).cast("double").alias("y"))))


def edges(df: DataFrame, geometry: str = "geometry", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per ring segment, endpoints ordered so the segment is undirected."""
    pts = df.select(*keep, F.explode(rings(F.col(geometry))).alias("p"))
    seg = pts.select(*keep, F.explode(F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"),
                                                     F.slice("p", 2, F.size("p")).alias("b"))).alias("e"))
    a, b = F.col("e.a"), F.col("e.b")
    first = F.least(a, b)
    second = F.greatest(a, b)
    return seg.select(*keep, first.getField("x").alias("x1"), first.getField("y").alias("y1"),
                      second.getField("x").alias("x2"), second.getField("y").alias("y2"))


def dissolve_boundary(df: DataFrame, by: str, geometry: str = "geometry", name: str | None = None) -> DataFrame:
    """G1: boundary segments of the union of each group's polygons.

    Output: ``<name or by>, x1, y1, x2, y2``, one row per boundary segment.
    """
    out = name or by
    e = edges(df.withColumnRenamed(by, out), geometry, keep=(out,))
    counted = e.groupBy(out, "x1", "y1", "x2", "y2").agg(F.count(F.lit(1)).alias("k"))
    return counted.where(F.col("k") % 2 == 1).drop("k")


def attach_geometry(attrs: DataFrame, boundary: DataFrame, on: str) -> DataFrame:
    """Left join attributes to boundary segments (one row per segment); a NULL key meets the NULL group."""
    return join_null_safe(attrs, boundary, [on], "left")
