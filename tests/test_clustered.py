"""Clustered interim tables: joins and aggregations without a shuffle."""

import pytest
from pyspark.sql import functions as F

from epigrid.operators import joins as J
from epigrid.sources.clustered import write_clustered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def weekly(spark, n, value, weeks=7):
    grid = spark.range(n * weeks).select(F.format_string("%06d", (F.col("id") / weeks).cast("int")).alias("ubigeo"),
                                         F.expr(f"date_add(DATE'2021-01-03', cast(id % {weeks} AS int) * 7)").alias("week_start"),
                                         (F.col("id") % 5).alias(value))
    return grid.withColumn("ubigeo", F.when(F.col("ubigeo") != "000003", F.col("ubigeo")))      # a NULL district


def test_joins_start_from_the_buckets(spark, no_broadcast):
    cases, deaths = weekly(spark, 40, "cases"), weekly(spark, 30, "deaths", 5)
    dims = spark.createDataFrame([(f"{k:06d}", f"P{k % 4}") for k in range(35)], "ubigeo string, province string")
    plain = J.join_on(cases, deaths, ["ubigeo", "week_start"])
    assert "Exchange" in plan(plain)
    c, d = write_clustered(cases, "cases", ["ubigeo"], ["week_start"], 6), write_clustered(deaths, "deaths", ["ubigeo"], ["week_start"], 6)
    g = write_clustered(dims, "districts", ["ubigeo"], buckets=6)
    both = J.join_on(c, d, ["ubigeo", "week_start"])                                # J6
    named = J.join_on(both, g, ["ubigeo"], "left")                                  # J2
    total = named.groupBy("ubigeo", "province").agg(F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths"))
    for df in (both, named, total):
        assert "Exchange" not in plan(df), plan(df)
    want = J.join_on(plain, dims, ["ubigeo"], "left")
    assert sorted(map(tuple, named.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert sorted(map(tuple, c.collect()), key=str) == sorted(map(tuple, cases.collect()), key=str)      # NULL keys stay


def test_one_file_a_bucket_and_empty_tables(spark):
    c = write_clustered(weekly(spark, 40, "cases").repartition(9), "files", ["ubigeo"], ["week_start"], 4)
    assert len(c.inputFiles()) <= 4
    none = write_clustered(weekly(spark, 40, "cases").limit(0), "none", ["ubigeo"])
    assert none.count() == 0 and none.columns == ["ubigeo", "week_start", "cases"]
