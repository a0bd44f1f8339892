"""Dense weekly series: fast path equals the reference's daily grid; skew; quirks."""

import datetime as dt
import random

from pyspark.sql import functions as F

from epigrid.operators import densify as R


def _events(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "000001" if i % 3 == 0 else f"{rnd.randint(2, 40):06d}"   # one key holds a third of all rows
        rows.append((key, dt.date(2020, 3, 6) + dt.timedelta(days=rnd.randint(0, 400))))
    rows.append(("999999", dt.date(2020, 2, 1)))   # unknown key widens the calendar, then vanishes (Q1)
    return spark.createDataFrame(rows, "ubigeo string, d date")


def test_fast_path_equals_daily_grid(spark):
    ev = _events(spark)
    keys = spark.createDataFrame([(f"{i:06d}",) for i in range(1, 46)], "ubigeo string")
    fast = R.weekly_counts(ev, keys, "d", "n")
    slow = R.weekly_counts_daily_grid(ev, keys, "d", "n")
    a = sorted(map(tuple, fast.collect()))
    b = sorted(map(tuple, slow.collect()))
    assert a == b
    n_weeks = fast.select("week_start").distinct().count()
    assert fast.count() == 45 * n_weeks                         # dense: keys x weeks
    assert fast.agg(F.sum("n")).first()[0] == 3000              # every known event counted once
    assert fast.where("ubigeo = '000041'").agg(F.sum("n")).first()[0] == 0   # key without events: zeros


def test_complete_fixed_and_dates(spark):
    df = spark.createDataFrame([("a", 2018, 1.0), ("a", 2020, 2.0), ("b", 2019, 3.0)], "k string, year int, v double")
    out = R.complete_fixed(df, ["k"], "year", [2018, 2019, 2020])
    assert out.count() == 6 and out.where("v is null").count() == 3
    daily = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1), ("a", dt.date(2020, 1, 5), 2),
                                   ("b", dt.date(2020, 1, 3), 1)], "k string, d date, n long")
    full = R.complete_dates(daily, ["k"], "d")
    assert full.where("k = 'a'").count() == 5 and full.where("k = 'b'").count() == 1


def test_pivot_longer_prefix(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0)], "ubigeo string, population_2018 double, population_2019 double")
    long = R.pivot_longer(df, lambda cols: [c for c in cols if c.startswith("population")], "year", "population",
                          names_prefix="population_")
    assert sorted((r.year, r.population) for r in long.collect()) == [("2018", 1.0), ("2019", 2.0)]


def test_sparse_aggregates_equal_dense_joins(spark):
    """C4/C5/C8 from sparse counts equal the reference's joins of dense tables."""
    from epigrid.plans import pipelines as C

    sf = "/root/testdata/sf0.001"
    for fn in (C.national_weekly_long_from, C.province_rates_from, C.department_weekly_rates_from):
        a = sorted(map(lambda r: tuple(round(v, 9) if isinstance(v, float) else v for v in r), fn(spark, sf).collect()), key=str)
        b = sorted(map(lambda r: tuple(round(v, 9) if isinstance(v, float) else v for v in r), fn(spark, sf, dense=True).collect()), key=str)
        assert a == b and len(a) > 0


def test_unknown_codes_and_harmonised_events(spark):
    """Q1: events of codes without population vanish and are reported; Q2: mapped through the crosswalk."""
    from epigrid.plans import pipelines as C

    ev = spark.createDataFrame([("000001", dt.date(2020, 3, 2)), ("000009", dt.date(2020, 3, 3)),
                                ("000009", dt.date(2020, 3, 10)), ("777777", dt.date(2020, 3, 4))],
                               "ubigeo string, dx_date date")
    keys = spark.createDataFrame([("000001",)], "ubigeo string")
    s = R.weekly_series(ev, keys, "dx_date", "cases")
    rep = C.dropped_events(s, "cases").first()
    assert (rep.events, rep.dropped) == (4, 3)
    cw = spark.createDataFrame([("000009", "000001")], "ubigeo_2022 string, ubigeo_2017 string")
    s2 = R.weekly_series(C.harmonise_events(ev, cw), keys, "dx_date", "cases")
    assert C.dropped_events(s2, "cases").first().dropped == 1
    assert s2.dense().agg(F.sum("cases")).first()[0] == 3
