import datetime as dt

from pyspark.sql import functions as F

from epigrid.functions.dates import epi_week, epi_year, parse_ymd, week_floor, year_week_label


def test_parse_ymd_layouts(spark):
    rows = [("20200306", dt.date(2020, 3, 6)), ("2020-3-6", dt.date(2020, 3, 6)),
            ("2020/03/06", dt.date(2020, 3, 6)), ("2020.03.06", dt.date(2020, 3, 6)),
            ("20201345", None), ("2020-02-30", None), ("SIN DATO", None), (None, None),
            (" 20200306", dt.date(2020, 3, 6)), ("2020-03-06 ", dt.date(2020, 3, 6)),
            ("2020 03 06", dt.date(2020, 3, 6)), ("2020_03_06", dt.date(2020, 3, 6)),
            ("20-03-06", dt.date(2020, 3, 6)), ("99/1/2", dt.date(1999, 1, 2)), ("200306", dt.date(2020, 3, 6)),
            ("2020-Mar-06", dt.date(2020, 3, 6)), ("20 dec 6", dt.date(2020, 12, 6)), ("2020-anf-06", None),
            ("2020-03-06x", None), ("2020", None), ("2020-03", None), ("2020-03-06 10:00", None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = {r.t: r.d for r in df.select("t", parse_ymd(F.col("t")).alias("d")).collect()}
    assert got == {t: d for t, d in rows}


def test_week_starts_sunday(spark):
    days = [dt.date(2020, 3, 1) + dt.timedelta(days=i) for i in range(14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", week_floor(F.col("d")).alias("w")).collect():
        assert r.w.weekday() == 6 and 0 <= (r.d - r.w).days < 7


def test_epi_week_labels_of_the_reference(spark):
    # first and last joined weeks of the reference's figure: EW 10, 2020 and EW 03, 2024
    df = spark.createDataFrame([(dt.date(2020, 3, 1),), (dt.date(2024, 1, 14),), (dt.date(2020, 12, 27),)], "w date")
    got = [(r.y, r.k, r.l) for r in df.select(epi_year(F.col("w")).alias("y"), epi_week(F.col("w")).alias("k"),
                                               year_week_label(F.col("w")).alias("l")).collect()]
    assert got == [(2020, 10, "2020 W10"), (2024, 3, "2024 W03"), (2020, 53, "2020 W53")]


def test_calendar_sizes_of_the_reference(spark):
    from epigrid.operators.densify import WEEK, DAY

    def sizes(lo, hi):
        b = spark.createDataFrame([(lo, hi)], "lo date, hi date")
        days = b.select(F.size(F.sequence("lo", "hi", DAY())).alias("n")).first().n
        weeks = b.select(F.size(F.sequence(week_floor(F.col("lo")), week_floor(F.col("hi")), WEEK())).alias("n")).first().n
        return days, weeks

    assert sizes(dt.date(2020, 3, 6), dt.date(2024, 1, 20)) == (1416, 203)
    assert sizes(dt.date(2020, 3, 3), dt.date(2024, 1, 21)) == (1420, 204)
