import os

from epigrid.plans import pipelines as C
from epigrid.plans.workflow import run_all
from epigrid.sources import io

SF = "/root/testdata/sf0.001"


def test_workflow_writes_every_table(spark):
    paths = run_all(spark, SF)
    assert set(paths) == {"interim/population_2018-2022", "processed/cases", "processed/deaths",
                          "figures/weekly_long", "figures/province_map", "figures/province_polygons", "figures/department_weekly_classes"}
    cases = io.read_delimited(spark, paths["processed/cases"], "cDl")   # the reference's "cDi" reload
    assert cases.columns == ["ubigeo", "week_start", "cases"]
    assert cases.count() == C.weekly_cases_from(spark, SF).count()
    assert cases.where("cases is null").count() == 0
    pop = io.read_delimited(spark, paths["interim/population_2018-2022"], "cid")
    assert pop.count() == C.population_from(spark, SF).count()
    assert all(os.path.basename(p) for p in paths.values())


def test_sinks_are_sorted(spark):
    paths = run_all(spark, SF)
    rows = [tuple(r) for r in io.read_delimited(spark, paths["processed/deaths"], "cDl").collect()]
    keys = [(r[0], r[1]) for r in rows]
    assert keys == sorted(keys)
