"""Province polygons from district polygons (G1), whole geometries instead of loose segments.

``dissolve_polygons`` gives one ``MULTIPOLYGON`` text per group of a polygon tiling:

1. Rings become directed edges with the district on their left (outer rings
   counter-clockwise, holes clockwise).  Each undirected segment sums its directions; what
   two neighbours share cancels.
2. Noding: where neighbours do not share vertices, segments that are left overlap in part.
   Segments and vertices meet in the cells of a grid (a segment is laid into the cells it
   crosses, a vertex into one), each segment is split at the vertices on it, and the pieces
   cancel once more.
3. Every edge that is left gets the next edge around the same piece of interior: at a
   vertex, the first way out clockwise from the way in.  Rings come from list ranking:
   pointer doubling finds each ring's smallest edge, then each edge's distance to it, in
   log2(longest ring) stored rounds.
4. A ring that meets itself at a vertex (a hole that touches its outline) is split there,
   so all rings are simple and touch in points only.
5. Counter-clockwise rings are outlines, clockwise ones holes.  A hole that was split from an
   outline belongs to it; the others are located by crossing counts to the left of their
   leftmost point, with edges and points meeting in horizontal stripes.

No group's edges are gathered into one task before its rings are complete; the result of a
group is one text by definition.

Defined results: NULL and EMPTY geometries count as empty, and a group of them alone gives
``MULTIPOLYGON EMPTY``; a NULL group is a group; unclosed rings are closed and repeated points
dropped; area that polygons of one group cover twice counts twice; vertices on straight
stretches are left out.  ``tolerance`` is the distance at which a vertex counts as lying on a
segment (0: exactly).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

POINT = "struct<x:double,y:double>"


def oriented_rings(wkt: Column) -> Column:
    """``array<array<point>>``: closed rings of all polygons, outer ones counter-clockwise, holes clockwise."""
    texts = F.regexp_extract_all(F.regexp_replace(F.coalesce(wkt, F.lit("")), r"\(\s+\(", "(("), F.lit(r"\(?\([^()]+\)"), 0)

    def number(p: Column, k: int) -> Column:
        return F.split(F.trim(p), r"\s+").getItem(k).cast("double") + 0.0      # no negative zero

    def ring(text: Column) -> Column:
        pts = F.transform(F.split(F.regexp_replace(text, r"[()]", ""), ","), lambda p: F.struct(number(p, 0).alias("x"), number(p, 1).alias("y")))
        return F.struct(F.startswith(text, F.lit("((")).alias("outer"), F.concat(pts, F.slice(pts, 1, 1)).alias("p"))

    def turned(r: Column) -> Column:
        p = r["p"]
        area = F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(0.0), lambda s, i: s
                           + F.element_at(p, i)["x"] * F.element_at(p, i + 1)["y"] - F.element_at(p, i + 1)["x"] * F.element_at(p, i)["y"])
        return F.when((area > 0) == r["outer"], p).otherwise(F.reverse(p))

    return F.transform(F.transform(texts, ring), turned)


def _flat(edges: DataFrame) -> DataFrame:
    """Sum the directions of equal segments; ``net`` > 0 runs from (x1, y1) to (x2, y2), the smaller end first."""
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    side = edges.select("g", F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.when(a < b, F.col("net")).otherwise(-F.col("net")).alias("net"))
    return (side.groupBy("g", "a", "b").agg(F.sum("net").alias("net")).where("net <> 0")
                .select("g", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), "net"))


def directed_segments(df: DataFrame, by: str, geometry: str = "geometry") -> DataFrame:
    """(g, x1, y1, x2, y2, net): the segments that do not cancel inside a group."""
    pts = df.select(F.col(by).alias("g"), F.explode(oriented_rings(F.col(geometry))).alias("p"))
    e = pts.select("g", F.explode(F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"), F.slice("p", 2, F.size("p")).alias("b"))).alias("e"))
    e = e.select("g", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"), F.lit(1).alias("net"))
    return _flat(e.where("x1 <> x2 OR y1 <> y2"))


def grid(seg: DataFrame) -> DataFrame:
    """(bg, x0, y0, cell): corner and cell side of each group's grid."""
    box = seg.groupBy("g").agg(F.min("x1").alias("x0"), F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("x1", "x2")).alias("xm"),
                               F.max(F.greatest("y1", "y2")).alias("ym"), F.count("*").alias("n"),
                               F.avg(F.greatest(F.col("x2") - F.col("x1"), F.abs(F.col("y2") - F.col("y1")))).alias("reach"))
    side = F.greatest(F.sqrt((F.col("xm") - F.col("x0")) * (F.col("ym") - F.col("y0")) / F.col("n")), 2 * F.col("reach"))
    return box.select(F.col("g").alias("bg"), "x0", "y0", side.alias("cell"))


def node_segments(segments: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Segments split at the vertices of their group that lie on them; equal pieces cancel.

    The grid has at most about one cell per segment of the group, square over the group's own
    extent however long and narrow it is, and no cell is smaller than two mean segments: a cell
    holds few of either side, and the segments are laid into a few cells each.
    """
    seg = materialize(segments.withColumn("id", F.monotonically_increasing_id()), "segments")
    box = grid(seg)
    boxed = lambda df: df.join(box, df["g"].eqNullSafe(box["bg"])).drop("bg")
    cell = lambda v, low: F.floor((v - F.col(low)) / F.col("cell"))
    slack = F.lit(tolerance) + F.col("cell") * 1e-6

    # columns first, then the rows that the segment passes inside each column
    wide = boxed(seg).withColumn("cx", F.explode(F.sequence(cell(F.col("x1") - slack, "x0"), cell(F.col("x2") + slack, "x0"))))
    slope = F.when(F.col("x2") > F.col("x1"), (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")))
    edge = lambda k: F.col("x0") + (F.col("cx") + k) * F.col("cell")
    at = lambda x: F.when(slope.isNull(), F.col("y1")).otherwise(F.col("y1") + slope * (x - F.col("x1")))
    first, last = at(F.greatest("x1", edge(0) - slack)), F.when(slope.isNull(), F.col("y2")).otherwise(at(F.least("x2", edge(1) + slack)))
    rows = F.sequence(cell(F.least(first, last) - slack, "y0"), cell(F.greatest(first, last) + slack, "y0"))
    laid = wide.withColumn("cy", F.explode(rows)).select("g", "cx", "cy", "id", "x1", "y1", "x2", "y2")

    ends = seg.select("g", F.col("x1").alias("px"), F.col("y1").alias("py")).unionByName(seg.select("g", F.col("x2").alias("px"), F.col("y2").alias("py"))).distinct()
    ends = boxed(ends).select(F.col("g").alias("vg"), "px", "py", cell(F.col("px"), "x0").alias("vx"), cell(F.col("py"), "y0").alias("vy"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    off = (F.col("px") - F.col("x1")) * dy - (F.col("py") - F.col("y1")) * dx
    t = ((F.col("px") - F.col("x1")) * dx + (F.col("py") - F.col("y1")) * dy) / (dx * dx + dy * dy)
    met = laid.join(ends, laid["g"].eqNullSafe(ends["vg"]) & (F.col("cx") == F.col("vx")) & (F.col("cy") == F.col("vy")))
    hits = met.where(F.abs(off) <= tolerance * F.sqrt(dx * dx + dy * dy)).select("id", t.alias("t"), F.col("px").alias("x"), F.col("py").alias("y")).where("t > 0 AND t < 1")

    marks = hits.unionByName(seg.select("id", F.lit(0.0).alias("t"), F.col("x1").alias("x"), F.col("y1").alias("y"))).unionByName(
        seg.select("id", F.lit(1.0).alias("t"), F.col("x2").alias("x"), F.col("y2").alias("y")))
    order = Window.partitionBy("id").orderBy("t", "x", "y")
    pieces = marks.select("id", F.col("x").alias("a1"), F.col("y").alias("b1"), F.lead("x").over(order).alias("a2"), F.lead("y").over(order).alias("b2"))
    pieces = pieces.where("a2 IS NOT NULL AND (a1 <> a2 OR b1 <> b2)").join(seg.select("id", "g", "net"), "id")
    return _flat(pieces.select("g", F.col("a1").alias("x1"), F.col("b1").alias("y1"), F.col("a2").alias("x2"), F.col("b2").alias("y2"), "net"))


# ----------------------------------------------------------------- rings
def _edges(segments: DataFrame) -> DataFrame:
    """(id, g, x1, y1, x2, y2): one directed edge per unit of ``net``."""
    copies = segments.withColumn("copy", F.explode(F.sequence(F.lit(1), F.abs("net").cast("int"))))
    way = lambda a, b: F.when(F.col("net") > 0, F.col(a)).otherwise(F.col(b))
    e = copies.select("g", way("x1", "x2").alias("x1"), way("y1", "y2").alias("y1"), way("x2", "x1").alias("x2"), way("y2", "y1").alias("y2"))
    return materialize(e.withColumn("id", F.monotonically_increasing_id()), "edges")


def _follow(edges: DataFrame, keys: list[str], clockwise: bool) -> DataFrame:
    """(id, nxt, corner, turns): the edge that follows each edge, and how often the group passes their vertex.

    At a vertex ways in and out alternate around it; the i-th way in meets the next way out in
    the given sense of rotation.  ``corner`` is false where the ring goes straight on.
    """
    turn = -1.0 if clockwise else 1.0
    def end(x: str, y: str, ox: str, oy: str, sign: float) -> Column:
        dx, dy = F.col(ox) - F.col(x), F.col(oy) - F.col(y)
        return F.struct((turn * F.atan2(dy, dx)).alias("a"), F.col("id").alias("id"), (sign * dx).alias("dx"), (sign * dy).alias("dy"))

    none = F.lit(None).cast("struct<a:double,id:bigint,dx:double,dy:double>")
    ends = (edges.select(*keys, F.col("x2").alias("x"), F.col("y2").alias("y"), end("x2", "y2", "x1", "y1", -1.0).alias("i"), none.alias("o"))
            .unionByName(edges.select(*keys, F.col("x1").alias("x"), F.col("y1").alias("y"), none.alias("i"), end("x1", "y1", "x2", "y2", 1.0).alias("o"))))
    at = ends.groupBy(*keys, "x", "y").agg(F.array_sort(F.collect_list("i")).alias("i"), F.array_sort(F.collect_list("o")).alias("o"))
    shift = F.when(F.get("i", F.lit(0))["a"] < F.get("o", F.lit(0))["a"], 0).otherwise(1)
    met = F.transform("i", lambda e, k: F.struct(e.alias("i"), F.get("o", (k + F.col("shift")) % F.size("o")).alias("o")))
    pair = at.withColumn("shift", shift).select(F.size("i").alias("turns"), F.explode(met).alias("m"))
    cross = F.col("m.i.dx") * F.col("m.o.dy") - F.col("m.i.dy") * F.col("m.o.dx")
    dot = F.col("m.i.dx") * F.col("m.o.dx") + F.col("m.i.dy") * F.col("m.o.dy")
    return pair.select(F.col("m.i.id").alias("id"), F.col("m.o.id").alias("nxt"), ((cross != 0) | (dot < 0)).alias("corner"), "turns")


def _ring_labels(edges: DataFrame, follow: DataFrame) -> DataFrame:
    """(id, lab): the smallest edge of each edge's ring, by pointer doubling; done when a round changes nothing."""
    key = F.struct("x1", "y1", "x2", "y2", "id")
    state = materialize(edges.select("id", key.alias("lab")).join(follow.select("id", F.col("nxt").alias("ptr")), "id"), "labels")
    while True:
        ahead = state.select(F.col("id").alias("ptr"), F.col("ptr").alias("to"), F.col("lab").alias("seen"))
        state = materialize(state.join(ahead, "ptr").select(
            "id", F.col("to").alias("ptr"), F.least("lab", "seen").alias("lab"), (F.col("seen") < F.col("lab")).alias("moved")), "labels")
        if state.where("moved").isEmpty():
            return state.select("id", "lab")
        state = state.drop("moved")


def _ring_ranks(follow: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, left): edges from each edge to the end of its ring, which starts at its smallest edge."""
    nxt = F.when(F.col("nxt") != F.col("lab.id"), F.col("nxt"))
    state = materialize(follow.join(labels, "id").select("id", nxt.alias("ptr"), F.lit(1).cast("long").alias("left")), "ranks")
    while not state.where("ptr IS NOT NULL").isEmpty():
        ahead = state.select(F.col("id").alias("ptr"), F.col("ptr").alias("to"), F.col("left").alias("more"))
        state = materialize(state.join(ahead, "ptr", "left").select(
            "id", F.col("to").alias("ptr"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")), "ranks")
    return state.select("id", "left")


def assemble_rings(segments: DataFrame) -> DataFrame:
    """(g, ring, whole, left, corner, x1, y1, x2, y2): boundary edges with their simple ring and their place in it.

    ``whole`` is the ring before it was split where it meets itself.
    """
    edges = _edges(segments)
    follow = materialize(_follow(edges, ["g"], clockwise=True), "follow")
    labels = whole = _ring_labels(edges, follow)
    crossed = follow.where("turns > 1").select("id")
    if not crossed.isEmpty():
        # edges into shared vertices, by ring: only vertices that one ring passes more than once change
        known = materialize(edges.join(labels, "id"), "rings")
        again = _follow(known, ["g", "lab"], clockwise=False).where("turns > 1")
        follow = materialize(follow.drop("turns").join(again.select("id"), "id", "left_anti").unionByName(again.drop("turns")), "follow")
        labels = _ring_labels(edges, follow)
    starts = follow.select(F.col("nxt").alias("id"), "corner")
    return (edges.join(labels.withColumnRenamed("lab", "ring"), "id").join(whole.withColumnRenamed("lab", "whole"), "id")
                 .join(_ring_ranks(follow, labels), "id").join(starts, "id").drop("id"))


def _parents(rings: DataFrame, edges: DataFrame) -> DataFrame:
    """(ring, parent) of holes that were not split from an outline: the smallest outline around each."""
    loose = rings.where("area2 < 0 AND NOT tied").select(F.col("g").alias("hg"), F.col("ring").alias("hole"))
    up = edges.join(rings.where("area2 > 0").select("ring", "area2"), "ring").where("y1 <> y2")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    box = up.groupBy("g").agg(F.min(low).alias("y0"), F.max(high).alias("ym"), F.count("*").alias("n"), F.avg(high - low).alias("reach"))
    tall = F.greatest((F.col("ym") - F.col("y0")) / F.col("n"), 2 * F.col("reach"))     # an edge lies in a few stripes
    box = box.select(F.col("g").alias("bg"), "y0", tall.alias("tall"))
    stripe = lambda y: F.floor((y - F.col("y0")) / F.col("tall"))
    up = up.join(box, up["g"].eqNullSafe(box["bg"])).withColumn("s", F.explode(F.sequence(stripe(low), stripe(high))))
    loose = loose.join(box, loose["hg"].eqNullSafe(box["bg"])).select("hg", "hole", F.col("hole.x1").alias("px"), F.col("hole.y1").alias("py"),
                                                                      stripe(F.col("hole.y1")).alias("hs"))
    met = up.join(loose, up["g"].eqNullSafe(loose["hg"]) & (F.col("s") == F.col("hs")))
    x = F.col("x1") + (F.col("py") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossed = met.where((low <= F.col("py")) & (F.col("py") < high) & (x < F.col("px")))
    inside = crossed.groupBy("hole", "ring").agg(F.count("*").alias("k"), F.first("area2").alias("area2")).where("k % 2 = 1")
    return inside.groupBy("hole").agg(F.min_by("ring", F.struct("area2", "ring")).alias("parent")).withColumnRenamed("hole", "ring")


def _number(x: Column) -> Column:
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def dissolve_polygons(df: DataFrame, by: str, geometry: str = "geometry", name: str | None = None, noded: bool = True,
                      tolerance: float = 0.0) -> DataFrame:
    """G1: the union of each group's polygons as whole geometries.

    Output: ``<name or by>, geometry, n_polygons, n_rings, n_points, area``; ``n_points``
    counts the corners of all rings.
    """
    out = name or by
    segments = directed_segments(df, by, geometry)
    edges = materialize(assemble_rings(node_segments(segments, tolerance) if noded else segments), "ring-edges")
    turn = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    point = F.struct((-F.col("left")).alias("at"), F.concat_ws(" ", _number(F.col("x1")), _number(F.col("y1"))).alias("t"))
    rings = edges.groupBy("g", "ring").agg(F.first("whole").alias("whole"), F.sum(turn).alias("area2"),
                                           F.array_sort(F.collect_list(F.when(F.col("corner"), point))).alias("p"))
    text = F.concat(F.lit("("), F.array_join(F.transform(F.concat("p", F.slice("p", 1, 1)), lambda p: p["t"]), ", "), F.lit(")"))
    owner = F.max(F.when(F.col("area2") > 0, F.col("ring"))).over(Window.partitionBy("g", "whole"))
    rings = materialize(rings.select("g", "ring", "area2", F.size("p").alias("n"), text.alias("t"), owner.alias("owner"))
                        .withColumn("tied", F.col("owner").isNotNull()), "rings")
    rings = rings.join(_parents(rings, edges), "ring", "left").withColumn("outline", F.coalesce("owner", "parent", "ring"))
    parts = rings.groupBy("g", "outline").agg(
        F.array_sort(F.collect_list(F.struct((F.col("area2") < 0).alias("hole"), "ring", "t"))).alias("r"),
        F.sum("area2").alias("area2"), F.sum("n").alias("n"), F.count("*").alias("k"))
    poly = F.concat(F.lit("("), F.array_join(F.transform("r", lambda r: r["t"]), ", "), F.lit(")"))
    whole = parts.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("outline", poly.alias("t")))).alias("r"), F.count("*").alias("n_polygons"),
                                   F.sum("k").alias("n_rings"), F.sum("n").alias("n_points"), (F.sum("area2") / 2).alias("area"))
    groups = df.select(F.col(by).alias("key")).distinct()
    made = groups.join(whole, groups["key"].eqNullSafe(whole["g"]), "left")
    shape = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform("r", lambda r: r["t"]), ", "), F.lit(")"))
    return made.select(F.col("key").alias(out), F.coalesce(shape, F.lit("MULTIPOLYGON EMPTY")).alias("geometry"),
                       *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_polygons", "n_rings", "n_points")], F.coalesce("area", F.lit(0.0)).alias("area"))
