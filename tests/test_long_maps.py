"""Grids of long narrow maps, and dates parsed in one rewrite."""

from pyspark.sql import functions as F

from epigrid.functions.dates import parse_ymd
from epigrid.operators.polygons import directed_segments, dissolve_polygons, grid


def square(x, y):
    return f"POLYGON (({x} {y}, {x + 1} {y}, {x + 1} {y + 1}, {x} {y + 1}, {x} {y}))"


def test_grid_of_a_long_narrow_map(spark):
    rows = [("p", square(k * 7 % 10, k * 5)) for k in range(1500)]
    df = spark.createDataFrame(rows, "prov string, geometry string")
    segments = directed_segments(df, "prov")
    assert grid(segments).first().cell <= 5     # a map of 10 by 7,500: a few segments a cell, not the root of their number
    assert grid(segments.where("y1 = 0 AND y2 = 0")).first().cell == 2      # all on one line
    got = dissolve_polygons(df, "prov").first()
    assert (got.n_polygons, got.n_rings, got.n_points, got.area) == (1500, 1500, 6000, 1500.0)


def test_dates_are_rewritten_once(spark):
    assert parse_ymd(F.col("t"))._jc.toString().count("concat_ws") == 2         # one a compact layout
    rows = ["20210304", "210304", "2021-03-04", "21/3/4", "2021.3.14", "99_12_31", "2021-Mar-04", "68 jan 1", "69 JAN 1", " 20210304 ", "2021030", "20211345",
            "SIN DATO", "", None, "2021-foo-04", "21-3-4x"]
    want = ["2021-03-04", "2021-03-04", "2021-03-04", "2021-03-04", "2021-03-14", "1999-12-31", "2021-03-04", "2068-01-01", "1969-01-01", "2021-03-04"] + [None] * 7
    df = spark.createDataFrame(list(enumerate(rows)), "k int, t string").select("k", parse_ymd(F.col("t")).cast("string").alias("d"))
    assert [r.d for r in df.orderBy("k").collect()] == want
