"""Composite pipelines C1-C9, each a composition of the inventory operators.

Every function takes DataFrames and returns a DataFrame; nothing is collected.
The ``*_from`` helpers wire the fixture tables in for ``(spark, sf_dir)`` callers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import across, col_range, letters_to_zero, per_100k, starts_with, to_double
from ..functions.dates import epi_week, epi_year, parse_ymd, year_week_label
from ..functions.labels import label_table
from ..operators import aggregate as A
from ..operators import classify as B
from ..operators import dissolve as G
from ..operators import polygons as PG
from ..operators import densify as R
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import project as P
from ..sources import fixtures as fx

POP_NAMES = ("ubigeo", "district", *[f"population_{y}" for y in fx.POPULATION_YEARS])


# --------------------------------------------------------------------- C1
def clean_sheet(sheet: DataFrame) -> DataFrame:
    """Sheet rows -> named district rows."""
    c1 = F.col(sheet.columns[0])
    rows = (FL.drop_na(sheet, sheet.columns[0], sheet.columns[1])
              .where(FL.not_matching(c1, "UBIGEO"))
              .where(FL.substring_not_equal(c1, 5, 2, "00")))
    return P.set_names(rows, POP_NAMES)


def harmonise(named: DataFrame, cw: DataFrame) -> DataFrame:
    """J1 + X8: attach the 2017 parent code; districts without one keep their own.

    A child listed twice would count its population twice, so it is an error.
    """
    cw = A.one_per_key(cw.select(*starts_with("ubigeo")(cw.columns)), "ubigeo_2022")
    joined = J.left_join_renamed(named, cw, "ubigeo", "ubigeo_2022")
    return joined.withColumn("ubigeo_2017", F.coalesce("ubigeo_2017", "ubigeo"))


def population_wide(sheet: DataFrame, cw: DataFrame) -> DataFrame:
    """Cleaned, cast and summed by parent code: ``ubigeo, population_2018..2022``."""
    h = harmonise(clean_sheet(sheet), cw)
    h = across(h, starts_with("population"), letters_to_zero)
    h = across(h, starts_with("population"), to_double)
    wide = A.sum_across(h, ["ubigeo_2017"], starts_with("population"))
    return P.rename(wide, {"ubigeo_2017": "ubigeo"})


def population_long(sheet: DataFrame, cw: DataFrame) -> DataFrame:
    """``ubigeo string, year int, population double``, one row per code and year.

    The reference completes the years afterwards; after a full unpivot every
    code already has all five years, so that step (R3) is a no-op and left out.
    """
    long = R.pivot_longer(population_wide(sheet, cw), starts_with("population"),
                          names_to="year", values_to="population", names_prefix="population_")
    return long.withColumn("year", F.col("year").cast("int"))


# --------------------------------------------------------------------- C2/C3
def valid_cases(line_list: DataFrame, sentinel: str = fx.SENTINEL, floor: str = fx.DATE_FLOOR,
                age=(fx.AGE_MIN, fx.AGE_MAX)) -> DataFrame:
    """Case events that pass the reference's filters, with ``dx_date``."""
    ll = P.lower_names(line_list)
    ll = FL.drop_na(ll, "ubigeo", "fecha_resultado")
    ll = ll.where(FL.between(F.col("edad"), *age) & FL.not_sentinel("provincia", "distrito", sentinel))
    ll = P.mutate(ll, {"dx_date": parse_ymd(F.col("fecha_resultado"))})
    return ll.where(FL.on_or_after(F.col("dx_date"), floor))


def valid_deaths(line_list: DataFrame, floor: str = fx.DATE_FLOOR, age=(fx.AGE_MIN, fx.AGE_MAX)) -> DataFrame:
    """Death events that pass the filters (no sentinel filter), with ``death_date``."""
    ll = P.lower_names(line_list)
    ll = FL.drop_na(ll, "ubigeo", "fecha_fallecimiento")
    ll = ll.where(FL.between(F.col("edad_declarada"), *age))
    ll = P.mutate_consume(ll, {"death_date": parse_ymd(F.col("fecha_fallecimiento"))},
                          ["fecha_fallecimiento"])
    return ll.where(FL.on_or_after(F.col("death_date"), floor))


def harmonise_events(events: DataFrame, cw: DataFrame) -> DataFrame:
    """Q2 option: map 2022 district codes of events to their 2017 parents."""
    cw = cw.select("ubigeo_2022", "ubigeo_2017")
    return (J.left_join_renamed(events, cw, "ubigeo", "ubigeo_2022")
             .withColumn("ubigeo", F.coalesce("ubigeo_2017", "ubigeo")).drop("ubigeo_2017"))


def case_series(line_list: DataFrame, population: DataFrame, crosswalk: DataFrame | None = None) -> R.WeeklySeries:
    """C2 in sparse form: case counts per (district, week) over the population codes.

    With ``crosswalk``, event codes are first mapped to their parents (Q2 option).
    """
    keys = P.distinct_keys(population, "ubigeo")
    ev = valid_cases(line_list).select("ubigeo", "dx_date")
    if crosswalk is not None:
        ev = harmonise_events(ev, crosswalk)
    return R.weekly_series(ev, keys, "dx_date", "cases")


def death_series(line_list: DataFrame, population: DataFrame) -> R.WeeklySeries:
    """C3 in sparse form: death counts per (district, week) over the population codes."""
    keys = P.distinct_keys(population, "ubigeo")
    return R.weekly_series(valid_deaths(line_list).select("ubigeo", "death_date"), keys, "death_date", "deaths")


def dropped_events(series: R.WeeklySeries, source: str) -> DataFrame:
    """Q1: valid events whose district code is not a population key (they vanish)."""
    v, k = series.value, series.key
    marked = series.counts.join(series.keys.select(k).withColumn("__known", F.lit(True)), k, "left")
    return marked.agg(F.lit(source).alias("source"),
                      F.coalesce(F.sum(v), F.lit(0)).cast("bigint").alias("events"),
                      F.coalesce(F.sum(F.when(F.col("__known").isNull(), F.col(v))), F.lit(0)).cast("bigint").alias("dropped"))


def weekly_cases(line_list: DataFrame, population: DataFrame, daily_grid: bool = False) -> DataFrame:
    """``ubigeo, week_start, cases`` dense over population codes x weeks."""
    keys = P.distinct_keys(population, "ubigeo")
    ev = valid_cases(line_list).select("ubigeo", "dx_date")
    build = R.weekly_counts_daily_grid if daily_grid else R.weekly_counts
    return build(ev, keys, "dx_date", "cases")


def weekly_deaths(line_list: DataFrame, population: DataFrame, daily_grid: bool = False) -> DataFrame:
    """``ubigeo, week_start, deaths`` dense over population codes x weeks."""
    keys = P.distinct_keys(population, "ubigeo")
    ev = valid_deaths(line_list).select("ubigeo", "death_date")
    build = R.weekly_counts_daily_grid if daily_grid else R.weekly_counts
    return build(ev, keys, "death_date", "deaths")


# --------------------------------------------------------------------- C4
def national_weekly_long(cases: DataFrame, deaths: DataFrame) -> DataFrame:
    """C4: national weekly totals, long (``name`` cases/deaths), with epi-week."""
    cw = A.sum_by(cases, ["week_start"], ["cases"])
    dw = A.sum_by(deaths, ["week_start"], ["deaths"])
    weekly = J.join_reduce([cw, dw], ["week_start"])
    long = R.pivot_longer(weekly, ["cases", "deaths"])
    return long.withColumns({"epi_year": epi_year(F.col("week_start")),
                             "epi_week": epi_week(F.col("week_start")),
                             "year_week": year_week_label(F.col("week_start"))})


# --------------------------------------------------------------------- C5/C8
def districts_dim(district_map: DataFrame) -> DataFrame:
    """S6 + P6 + P4: district attributes."""
    return P.select_as(P.drop_geometry(district_map),
                       {"ubigeo": "ubigeo", "department": "dep", "province": "prov", "district": "distr"})


def population_year(population: DataFrame, year: int = fx.RATE_YEAR) -> DataFrame:
    """F7 + P5: the denominator year, without the year column."""
    return population.where(FL.equals(F.col("year"), year)).drop("year")


def rates(df: DataFrame, first: str = "cases", last: str = "deaths") -> DataFrame:
    """X12 over ``first:last``, consuming ``population``."""
    out = across(df, col_range(first, last), lambda c: per_100k(c, F.col("population")))
    return out.drop("population")


def province_rates(cases: DataFrame, deaths: DataFrame, districts: DataFrame,
                   population: DataFrame) -> DataFrame:
    """Cumulative rates per 100,000 by department and province.

    Codes missing from the district table keep NULL labels and a NULL rate (Q6).
    """
    counts = J.join_on(J.join_on(cases, deaths, ["ubigeo", "week_start"]), districts, ["ubigeo"], "left")
    prov_counts = A.sum_by(counts, ["department", "province"], ["cases", "deaths"])
    prov_pop = A.sum_by(J.join_on(districts, population, ["ubigeo"]), ["department", "province"], ["population"])
    return rates(J.join_null_safe(prov_counts, prov_pop, ["department", "province"], "left"))


def department_weekly_rates(cases: DataFrame, deaths: DataFrame, districts: DataFrame,
                            population: DataFrame) -> DataFrame:
    """Weekly rates per 100,000 by department (inner joins: unknown codes drop)."""
    dep_pop = A.sum_by(J.join_on(districts, population, ["ubigeo"]), ["department"], ["population"])
    dc = A.sum_by(J.join_on(cases, districts, ["ubigeo"], "left"), ["department", "week_start"], ["cases"])
    dd = A.sum_by(J.join_on(deaths, districts, ["ubigeo"], "left"), ["department", "week_start"], ["deaths"])
    counts = J.join_null_safe(dc, dd, ["department", "week_start"], "inner")
    return rates(J.join_null_safe(counts, dep_pop, ["department"], "inner"))


# --------------------------------------------------------------------- C4/C5/C8 from sparse counts
# The reference aggregates the dense key x week tables.  Their missing cells
# are zeros, so the same totals come from the sparse counts: only the grid's
# keys count, every key still contributes its (possibly zero) group, and an
# inner join of two series keeps the weeks both calendars share.  Nothing of
# size keys x weeks is built.
def _filled(grid: DataFrame, sums: DataFrame, keys: list[str], value: str) -> DataFrame:
    return grid.join(sums, keys, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0).cast("bigint")))


def national_weekly_long_sparse(cs: R.WeeklySeries, ds: R.WeeklySeries) -> DataFrame:
    """C4 from two series."""
    cw = _filled(cs.calendar(), A.sum_by(cs.known(), ["week_start"], ["cases"]), ["week_start"], "cases")
    dw = _filled(ds.calendar(), A.sum_by(ds.known(), ["week_start"], ["deaths"]), ["week_start"], "deaths")
    weekly = J.join_reduce([cw, dw], ["week_start"])
    long = R.pivot_longer(weekly, ["cases", "deaths"])
    return long.withColumns({"epi_year": epi_year(F.col("week_start")),
                             "epi_week": epi_week(F.col("week_start")),
                             "year_week": year_week_label(F.col("week_start"))})


def province_rates_sparse(cs: R.WeeklySeries, ds: R.WeeklySeries, districts: DataFrame,
                          population: DataFrame) -> DataFrame:
    """C5 from two series over the same keys."""
    lo, hi = F.greatest(cs.lo, ds.lo), F.least(cs.hi, ds.hi)       # weeks both tables have

    def per_key(series: R.WeeklySeries) -> DataFrame:
        v = series.value
        return series.counts.where(F.col("week_start").between(lo, hi)).groupBy("ubigeo").agg(F.sum(v).alias(v))

    keys = cs.keys.select("ubigeo").where(lo <= hi)
    tot = _filled(_filled(keys, per_key(cs), ["ubigeo"], "cases"), per_key(ds), ["ubigeo"], "deaths")
    counts = J.join_on(tot, districts, ["ubigeo"], "left")
    prov_counts = A.sum_by(counts, ["department", "province"], ["cases", "deaths"])
    prov_pop = A.sum_by(J.join_on(districts, population, ["ubigeo"]), ["department", "province"], ["population"])
    return rates(J.join_null_safe(prov_counts, prov_pop, ["department", "province"], "left"))


def department_weekly_rates_sparse(cs: R.WeeklySeries, ds: R.WeeklySeries, districts: DataFrame,
                                   population: DataFrame) -> DataFrame:
    """C8 from two series."""
    dep_pop = A.sum_by(J.join_on(districts, population, ["ubigeo"]), ["department"], ["population"])
    dep_of_key = J.join_on(cs.keys.select("ubigeo"), districts.select("ubigeo", "department"), ["ubigeo"], "left")
    deps = dep_of_key.select("department").distinct()

    def by_department(series: R.WeeklySeries) -> DataFrame:
        v = series.value
        grid = deps.select("department", F.explode(F.sequence(series.lo, series.hi, R.WEEK())).alias("week_start"))
        sums = A.sum_by(J.join_on(series.counts, dep_of_key, ["ubigeo"]), ["department", "week_start"], [v])
        return J.join_null_safe(grid, sums, ["department", "week_start"], "left") \
            .withColumn(v, F.coalesce(F.col(v), F.lit(0).cast("bigint")))

    counts = J.join_null_safe(by_department(cs), by_department(ds), ["department", "week_start"], "inner")
    return rates(J.join_null_safe(counts, dep_pop, ["department"], "inner"))


# --------------------------------------------------------------------- C6/C7/C9
HEATMAP_METHODS = ("quantile", "kmeans", "fisher", "geom", "arith", "em")


def classify(df: DataFrame, cols: list[str], methods, k: int, labels: bool = True,
             dig_lab: int = 5, consume: bool = True) -> DataFrame:
    """Add ``{col}_{method}`` classes (labels or 1-based indices) for every column and method.

    All breaks are computed and stored together (one small row per column and
    method), read back as scalar subqueries, so the table itself is never
    joined or shuffled for the classification.
    """
    br = B.many_breaks(B.long_values(df, cols), k, list(methods), groups=cols)
    br = br.withColumn("key", F.concat_ws("|", "method", "g"))
    fields = [F.first(F.when(F.col("key") == f"{m}|{c}", F.col("breaks")), ignorenulls=True).alias(f"b_{c}_{m}")
              for m in methods for c in cols]
    if labels:
        lab = label_table(br.select(F.col("key").alias("g"), "breaks"), dig_lab).withColumnRenamed("g", "key")
        br = br.join(lab, "key")
        fields += [F.first(F.when(F.col("key") == f"{m}|{c}", F.col("labels")), ignorenulls=True).alias(f"l_{c}_{m}")
                   for m in methods for c in cols]
    # every break and label array in one stored row, read back by one scalar subquery
    row = B.store(br.agg(F.struct(*fields).alias("all")), "class-row")
    out = {}
    for m in methods:
        for c in cols:
            idx = B.cut_index(F.col(c), F.col(f"__all.b_{c}_{m}"), k)
            out[f"{c}_{m}"] = F.try_element_at(F.col(f"__all.l_{c}_{m}"), idx) if labels else idx
    res = df.withColumn("__all", row.select("all").scalar()).withColumns(out).drop("__all")
    return res.drop(*cols) if consume else res


def department_weekly_classes(rates_df: DataFrame, methods=HEATMAP_METHODS, labels: bool = True,
                              k: int = 4) -> DataFrame:
    """Department-week classes, 6 methods x 2 measures, the measures consumed."""
    rates_df = B.store(rates_df)
    return classify(rates_df, ["cases", "deaths"], methods, k, labels=labels)


def province_bivariate(prates: DataFrame, k: int = 3, style: str = "jenks") -> DataFrame:
    """Bivariate class ``x-y`` of case and death rates (natural breaks, k classes)."""
    prates = B.store(prates)
    cls = classify(prates, ["cases", "deaths"], [style], k, labels=False, consume=False)
    return (cls.withColumn("bi_class", B.bi_class(F.col(f"cases_{style}"), F.col(f"deaths_{style}")))
               .drop(f"cases_{style}", f"deaths_{style}"))


def province_boundaries(district_map: DataFrame) -> DataFrame:
    """G1 + A8: district polygons dissolved into provinces (by province name)."""
    return G.dissolve_boundary(district_map, "prov", name="province")


def province_map(bivariate: DataFrame, district_map: DataFrame) -> DataFrame:
    """Province classes with their boundary segments, joined by name (Q5)."""
    return G.attach_geometry(bivariate, province_boundaries(district_map), "province")


def province_polygons(district_map: DataFrame) -> DataFrame:
    """G1 + A8 as whole geometries: one MULTIPOLYGON text per province."""
    return PG.dissolve_polygons(district_map, "prov", name="province")


def province_polygon_map(bivariate: DataFrame, district_map: DataFrame) -> DataFrame:
    """C7 ready to draw: province classes with their geometry, joined by name (Q5)."""
    return G.attach_geometry(bivariate, province_polygons(district_map), "province")


# --------------------------------------------------------------------- fixture wiring
def population_from(spark: SparkSession, sf: str) -> DataFrame:
    return population_long(fx.population_sheet(spark, sf), fx.crosswalk(spark, sf))


def weekly_cases_from(spark: SparkSession, sf: str, daily_grid: bool = False) -> DataFrame:
    return weekly_cases(fx.case_line_list(spark, sf), population_from(spark, sf), daily_grid)


def weekly_deaths_from(spark: SparkSession, sf: str, daily_grid: bool = False) -> DataFrame:
    return weekly_deaths(fx.death_line_list(spark, sf), population_from(spark, sf), daily_grid)


def districts_from(spark: SparkSession, sf: str) -> DataFrame:
    return districts_dim(fx.district_map(spark, sf))


def series_from(spark: SparkSession, sf: str):
    """Case and death series over the same population keys (built concurrently)."""
    from concurrent.futures import ThreadPoolExecutor

    pop = population_from(spark, sf)
    with ThreadPoolExecutor(2) as pool:
        cs = pool.submit(case_series, fx.case_line_list(spark, sf), pop)
        ds = pool.submit(death_series, fx.death_line_list(spark, sf), pop)
        return cs.result(), ds.result(), pop


def province_rates_from(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    cs, ds, pop = series_from(spark, sf)
    if dense:
        return province_rates(cs.dense(), ds.dense(), districts_from(spark, sf), population_year(pop))
    return province_rates_sparse(cs, ds, districts_from(spark, sf), population_year(pop))


def department_weekly_rates_from(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    cs, ds, pop = series_from(spark, sf)
    if dense:
        return department_weekly_rates(cs.dense(), ds.dense(), districts_from(spark, sf), population_year(pop))
    return department_weekly_rates_sparse(cs, ds, districts_from(spark, sf), population_year(pop))


def national_weekly_long_from(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    cs, ds, _ = series_from(spark, sf)
    if dense:
        return national_weekly_long(cs.dense(), ds.dense())
    return national_weekly_long_sparse(cs, ds)


def department_weekly_classes_from(spark: SparkSession, sf: str, labels: bool = True,
                                   methods=HEATMAP_METHODS) -> DataFrame:
    return department_weekly_classes(department_weekly_rates_from(spark, sf), methods, labels)


def province_bivariate_from(spark: SparkSession, sf: str) -> DataFrame:
    return province_bivariate(province_rates_from(spark, sf))


def province_map_from(spark: SparkSession, sf: str) -> DataFrame:
    return province_map(province_bivariate_from(spark, sf), fx.district_map(spark, sf))
