"""Parser problems keep the text that failed and are counted on the way."""

from datetime import date

from epigrid.sources.problems import observe_problems, parse_with_problems, problem_report


def test_problems_and_observation(spark):
    rows = [("7", "2020-03-01", "1.5"), ("x", "20200301", "n.d."), ("x", "SIN DATO", "NA"), (None, "", "1,5"), ("8.5", "2020-13-01", "2")]
    raw = spark.createDataFrame(rows, "age string, day string, value string")
    df, seen = observe_problems(parse_with_problems(raw, {"age": "i", "day": "y", "value": "d"}), ["age", "day", "value"])
    got = df.collect()
    assert [(r.age, r.day, r.value) for r in got][:2] == [(7, date(2020, 3, 1), 1.5), (None, date(2020, 3, 1), None)]
    assert [tuple(p) for p in got[1].problems] == [("age", "x"), ("value", "n.d.")] and got[0].problems == []
    assert seen.get == {"rows": 5, "age": 3, "day": 2, "value": 2}
    report = {(r.source, r.column, r.text): r.n for r in problem_report(df, "s").collect()}
    assert report == {("s", "age", "x"): 2, ("s", "age", "8.5"): 1, ("s", "day", "SIN DATO"): 1, ("s", "day", "2020-13-01"): 1,
                      ("s", "value", "n.d."): 1, ("s", "value", "1,5"): 1}
