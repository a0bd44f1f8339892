"""Dissolved polygons against cell counts: corners, holes, islands, T-junctions."""

import random
import re

from pyspark.sql import functions as F

from epigrid.operators.polygons import directed_segments, dissolve_polygons, node_segments

SCHEMA = "prov string, geometry string"


def box(x, y, w=1, h=1, turn=False):
    pts = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in (pts[::-1] if turn else pts)) + "))"


def parse(text):
    """[[ring, ...], ...] of a MULTIPOLYGON text."""
    if text.endswith("EMPTY"):
        return []
    body = text[len("MULTIPOLYGON ("):-1]
    return [[[tuple(map(float, p.split())) for p in r.split(", ")] for r in re.findall(r"\(([^()]+)\)", part)]
            for part in re.findall(r"\(((?:\([^()]+\)(?:, )?)+)\)", body)]


def area2(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))


def inside(ring, x, y):
    return sum((a[1] <= y < b[1] or b[1] <= y < a[1]) and a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) < x for a, b in zip(ring, ring[1:])) % 2 == 1


def components(cells):
    cells, out = set(cells), []
    while cells:
        todo = [cells.pop()]
        out.append(set(todo))
        while todo:
            x, y = todo.pop()
            for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if c in cells:
                    cells.remove(c)
                    todo.append(c)
                    out[-1].add(c)
    return out


def check(row, cells):
    """The geometry covers exactly the cells, with simple rings and one outline per polygon."""
    cells = set(cells)
    polygons = parse(row.geometry)
    grid = {(x, y) for x in range(min(x for x, _ in cells) - 1, max(x for x, _ in cells) + 2) for y in range(min(y for _, y in cells) - 1, max(y for _, y in cells) + 2)}
    parts = components(cells)
    holes = sum(len(components(grid - part)) - 1 for part in parts)
    assert (row.n_polygons, row.n_rings, row.area) == (len(parts), len(parts) + holes, len(cells))
    assert len(polygons) == row.n_polygons and sum(map(len, polygons)) == row.n_rings
    assert sum(len(r) - 1 for p in polygons for r in p) == row.n_points
    for outer, *inner in polygons:
        assert area2(outer) > 0 and all(area2(r) < 0 for r in inner)
        for r in (outer, *inner):
            assert r[0] == r[-1] and len(set(r[:-1])) == len(r) - 1
    for x, y in grid:
        held = [sum(inside(r, x + 0.5, y + 0.5) for r in p) for p in polygons]
        assert (1 in held) == ((x, y) in cells) and all(h <= 2 for h in held)


def test_shapes(spark):
    shapes = {
        "block": [(x, y) for x in range(3) for y in range(2)],
        "ring": [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)],
        "corner": [(0, 0), (1, 1)],
        "touching hole": [(x, y) for x in range(4) for y in range(4) if (x, y) not in ((1, 1), (0, 0))],
        "two holes at a corner": [(x, y) for x in range(4) for y in range(4) if (x, y) not in ((1, 1), (2, 2))],
        "island": [(x, y) for x in range(7) for y in range(7) if x in (0, 6) or y in (0, 6) or (x, y) == (3, 3)],
        "island with a hole": [(x, y) for x in range(9) for y in range(9) if x in (0, 8) or y in (0, 8) or (2 <= x <= 6 and 2 <= y <= 6 and (x, y) != (4, 4))],
        "far": [(-5, -7), (100, 3)],
    }
    random.seed(2)
    for k in range(4):
        shapes[f"random {k}"] = [(x, y) for x in range(12) for y in range(9) if random.random() < 0.35 + 0.12 * k]
    rows = [(n, box(x, y, turn=(x + y) % 2 == 0)) for n, cells in shapes.items() for x, y in cells]
    got = {r.prov: r for r in dissolve_polygons(spark.createDataFrame(rows, SCHEMA), "prov").collect()}
    assert set(got) == set(shapes)
    for n, cells in shapes.items():
        check(got[n], cells)
    assert got["block"].geometry == "MULTIPOLYGON (((0 0, 3 0, 3 2, 0 2, 0 0)))"
    assert got["ring"].geometry == "MULTIPOLYGON (((0 0, 3 0, 3 3, 0 3, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1)))"


def bricks(rows, width):
    """A wall of bricks three cells wide, every other row moved by one: no two rows share inner vertices."""
    return [(3 * c + r % 2, r, 3) for r in range(rows) for c in range(width)]


def test_t_junctions_give_the_outline_of_the_aligned_form(spark):
    random.seed(4)
    wall = [b for b in bricks(8, 7) if random.random() < 0.7]
    loose = spark.createDataFrame([("P", box(x, y, w)) for x, y, w in wall], SCHEMA)
    aligned = spark.createDataFrame([("P", box(x + k, y)) for x, y, w in wall for k in range(w)], SCHEMA)
    a, b = (dissolve_polygons(d, "prov").first() for d in (loose, aligned))
    check(a, [(x + k, y) for x, y, w in wall for k in range(w)])
    assert a == b
    segments = directed_segments(loose, "prov")
    plan = node_segments(segments)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert node_segments(segments).count() < segments.count() * 3


def test_slanted_segments_and_tolerance(spark):
    # a triangle whose long side meets two smaller ones at its middle, exactly and nearly
    for m, tolerance in (((4, 2), 0.0), ((4, 2.0000001), 1e-5)):
        tri = ["POLYGON ((0 0, 8 4, 0 4, 0 0))", f"POLYGON ((0 0, 8 0, {m[0]} {m[1]}, 0 0))", f"POLYGON ((8 0, 8 4, {m[0]} {m[1]}, 8 0))"]
        row = dissolve_polygons(spark.createDataFrame([("T", t) for t in tri], SCHEMA), "prov", tolerance=tolerance).first()
        assert row.geometry == "MULTIPOLYGON (((0 0, 8 0, 8 4, 0 4, 0 0)))" and row.area == 32


def test_one_long_border_with_many_vertices(spark):
    n = 3000
    rows = [("L", box(0, -1, n, 1))] + [("L", box(k, 0)) for k in range(n)]
    row = dissolve_polygons(spark.createDataFrame(rows, SCHEMA).repartition(8), "prov").first()
    assert row.geometry == f"MULTIPOLYGON (((0 -1, {n} -1, {n} 1, 0 1, 0 -1)))" and row.area == 2 * n


def test_odd_input(spark):
    rows = [("E", "POLYGON EMPTY"), ("E", None), (None, box(50, 50)), ("O", "POLYGON((0 0,2 0,2 0,2 2,0 2))"),
            ("H", "POLYGON ( (0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"), ("H", box(1, 1)), ("D", box(0, 0)), ("D", box(0, 0)),
            ("M", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((-0.0 1, 1 1, 1 2, 0 2, 0 1)))")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", g int, net string")
    got = {r.prov: r for r in dissolve_polygons(df, "prov").collect()}
    assert got["E"].geometry == "MULTIPOLYGON EMPTY" and got["E"].area == 0
    assert got[None].area == 1 and got["O"].area == 4 and got["D"].area == 2
    assert got["H"].area == 78 and got["H"].n_rings == 2
    assert got["M"].geometry == "MULTIPOLYGON (((0 0, 1 0, 1 2, 0 2, 0 0)))"
    assert dissolve_polygons(df.limit(0), "prov", name="province").columns == ["province", "geometry", "n_polygons", "n_rings", "n_points", "area"]
    assert dissolve_polygons(df.where(F.lit(False)), "prov").count() == 0
