import os

from pyspark.sql import functions as F

from epigrid.operators.dissolve import dissolve_boundary
from epigrid.session import scratch_path
from epigrid.sources import io


def _cell(x, y):
    pts = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]
    return "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in pts) + "))"


def test_dissolve_grid(spark):
    rows = [("P", _cell(x, y)) for x in range(3) for y in range(2)] + [("Q", _cell(5, 5))]
    out = dissolve_boundary(spark.createDataFrame(rows, "prov string, geometry string"), "prov", name="province")
    counts = {r.province: r.n for r in out.groupBy("province").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"P": 10, "Q": 4}   # a 3x2 block has 10 unit boundary edges


def test_sheet_skip_and_na_roundtrip(spark):
    df = spark.createDataFrame([(f"{i:06d}", None if i % 3 == 0 else f"d{i}") for i in range(50)], "c1 string, c2 string")
    path = io.write_with_preamble(df.repartition(3), scratch_path(spark, "t-sheet"), ["title", "", "x", "y", "z"])
    back = io.read_sheet(spark, path, skip=5, names=["c1", "c2"])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    p2 = io.write_table(df, scratch_path(spark, "t-csv"))
    again = io.read_delimited(spark, p2, "cc")
    assert again.where("c2 is null").count() == df.where("c2 is null").count()
    assert again.where("c1 = '000007'").count() == 1   # leading zeros kept


def test_type_string_schema():
    s = io.type_string_schema("cDi", ["ubigeo", "week_start", "cases"])
    assert [f.dataType.simpleString() for f in s.fields] == ["string", "date", "int"]


def test_scratch_scope_removes_only_its_own_tables(spark):
    from epigrid.session import materialize, scratch_scope
    from epigrid.sources import fixtures as fx

    kept = fx.crosswalk(spark, "/root/testdata/sf0.001")          # ingested: survives scopes
    with scratch_scope(spark):
        tmp = materialize(spark.range(10), "t-scope")
        assert tmp.count() == 10
        path = tmp.inputFiles()[0]
    assert not os.path.exists(path.replace("file:", ""))
    assert kept.count() > 0


def test_dissolve_all_rings_and_parts(spark):
    from epigrid.operators.dissolve import attach_geometry

    hole = "POLYGON ((0 0, 3 0, 3 3, 0 3, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    two = "MULTIPOLYGON (((9 9, 10 9, 10 10, 9 10, 9 9)), ((20 20, 21 20, 21 21, 20 21, 20 20)))"
    rows = [("H", hole), ("M", two), ("E", "POLYGON EMPTY"), ("E", None), (None, _cell(50, 50))]
    out = dissolve_boundary(spark.createDataFrame(rows, "prov string, geometry string"), "prov")
    counts = {r.prov: r.n for r in out.groupBy("prov").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"H": 8, "M": 8, None: 4}
    attrs = spark.createDataFrame([("E", 1), (None, 2)], "prov string, v int")
    got = {(r.prov, r.v): r.n for r in attach_geometry(attrs, out, "prov").groupBy("prov", "v").agg(F.count("x1").alias("n")).collect()}
    assert got == {("E", 1): 0, (None, 2): 4}


def test_long_codes_are_not_cut(spark):
    from epigrid.sources.fixtures import code6

    df = spark.createDataFrame([(7,), (1000000,), (1000007,)], "k long")
    assert [r[0] for r in df.select(code6(F.col("k"))).collect()] == ["000007", "1000000", "1000007"]


def test_null_department_keeps_its_rates(spark):
    from epigrid.plans.pipelines import department_weekly_rates

    cases = spark.createDataFrame([("a", "2020-03-01", 5), ("b", "2020-03-01", 7)], "ubigeo string, week_start string, cases long")
    deaths = cases.withColumnRenamed("cases", "deaths")
    districts = spark.createDataFrame([("a", None), ("b", "B")], "ubigeo string, department string")
    population = spark.createDataFrame([("a", 100.0), ("b", 100.0)], "ubigeo string, population double")
    out = department_weekly_rates(cases, deaths, districts, population)
    assert {r.department for r in out.collect()} == {None, "B"}
