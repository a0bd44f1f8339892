"""NULL and numeric rules N1-N12 on inline rows."""

from pyspark.sql import functions as F

from epigrid.functions.columns import across, letters_to_zero, per_100k, starts_with, to_double
from epigrid.operators import aggregate as A
from epigrid.operators import filters as FL
from epigrid.operators import joins as J
from epigrid.operators import project as P


def test_filter_drops_null_comparisons(spark):  # N1, N2
    df = spark.createDataFrame([("a", 5), (None, 5), ("EN INVESTIGACIÓN", 5), ("b", None)], "p string, age int")
    out = df.where(FL.not_sentinel("p", "EN INVESTIGACIÓN") & FL.between(F.col("age"), 0, 123))
    assert [r.p for r in out.collect()] == ["a"]


def test_sum_rules(spark):  # N3, N4
    df = spark.createDataFrame([("k", None), ("k", None), ("j", 1.0), ("j", None)], "g string, x double")
    across_sum = {r.g: r.x for r in A.sum_across(df, ["g"], ["x"]).collect()}
    assert across_sum == {"k": 0.0, "j": 1.0}
    strict = {r.g: r.x for r in A.sum_by(df, ["g"], ["x"]).collect()}
    assert strict == {"k": None, "j": None}


def test_text_cells(spark):  # N5, N6
    df = spark.createDataFrame([("12", "n.d.", "1,5", None)], "population_a string, population_b string, "
                               "population_c string, population_d string")
    out = across(across(df, starts_with("population"), letters_to_zero), starts_with("population"), to_double)
    assert tuple(out.first()) == (12.0, 0.0, None, None)


def test_rate_with_zero_population_is_null(spark):  # N8
    df = spark.createDataFrame([(5, 0.0), (5, 100000.0), (None, 10.0)], "c long, pop double")
    assert [r.r for r in df.select(per_100k(F.col("c"), F.col("pop")).alias("r")).collect()] == [None, 5.0, None]


def test_null_safe_join_and_null_group(spark):  # N9, N10
    left = spark.createDataFrame([(None, None, 3), ("d", "p", 4)], "department string, province string, n long")
    right = spark.createDataFrame([(None, None, 10.0), ("d", "p", 20.0)], "department string, province string, pop double")
    out = {(r.department, r.province): r.pop for r in J.join_null_safe(left, right, ["department", "province"]).collect()}
    assert out == {(None, None): 10.0, ("d", "p"): 20.0}
    groups = A.count_by(left.unionByName(left), ["department"], "n").collect()
    assert sorted((r.department or "", r.n) for r in groups) == [("", 2), ("d", 2)]


def test_mutate_consume_keeps_recreated(spark):  # P8
    df = spark.createDataFrame([(1, 2, 3)], "cases long, deaths long, population long")
    out = P.mutate_consume(df, {"cases": F.col("cases") * 2}, ["cases", "population"])
    assert out.columns == ["cases", "deaths"]


def test_relabel(spark):  # P13
    df = spark.createDataFrame([("cases",), ("deaths",), ("other",)], "name string")
    got = [r.l for r in df.select(P.relabel(F.col("name"), {"cases": "Positive cases", "deaths": "Deaths"}).alias("l")).collect()]
    assert got == ["Positive cases", "Deaths", "other"]


def test_crosswalk_children_unique_and_many_to_one(spark):  # Q11
    from epigrid.sources import fixtures as fx

    cw = fx.crosswalk(spark, "/root/testdata/sf0.001")
    assert A.duplicate_keys(cw, ["ubigeo_2022"]).count() == 0
    assert cw.select("ubigeo_2017").distinct().count() < cw.count()   # several children per parent


def test_a_child_listed_twice_is_an_error(spark):  # Q11
    import pytest

    once = spark.createDataFrame([("a", "x"), ("b", None), (None, "y"), (None, "z")], "k string, p string")
    assert {(r.k, r.p) for r in A.one_per_key(once, "k").where("k IS NOT NULL").collect()} == {("a", "x"), ("b", None)}
    with pytest.raises(Exception, match="listed more than once: a"):
        A.one_per_key(once.union(once.limit(1)), "k").collect()
