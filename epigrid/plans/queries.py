
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import across, col_range, letters_to_zero, per_100k, starts_with, to_double
from ..functions.dates import epi_week, epi_year, parse_ymd, week_floor, year_week_label
from ..functions.labels import label_table
from ..operators import aggregate as A
from ..operators import classify as B
from ..operators import densify as R
from ..operators import dissolve as G
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import polygons as PG
from ..operators import project as P
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import io
from ..sources.clustered import write_clustered
from ..sources.problems import parse_with_problems, problem_report
from ..sources.workbook import read_workbook, write_workbooks
from . import oracles as O
from . import pipelines as C
from .catalog import register
from .oracles import q

# ============================================================ composite pipelines


@register("population_long", q("SELECT ubigeo, year, population FROM population", "population"),
          doubles=("population",))
def population_long(spark, sf):
    return C.population_from(spark, sf)


@register("weekly_cases", q("SELECT ubigeo, week_start, cases FROM weekly_cases", "weekly_cases"))
def weekly_cases(spark, sf):
    return C.weekly_cases_from(spark, sf)


@register("weekly_deaths", q("SELECT ubigeo, week_start, deaths FROM weekly_deaths", "weekly_deaths"))
def weekly_deaths(spark, sf):
    return C.weekly_deaths_from(spark, sf)


@register("national_weekly_long",
          q("SELECT week_start, name, value, epi_year, epi_week, year_week FROM national_long", "national_long"))
def national_weekly_long(spark, sf):
    return C.national_weekly_long_from(spark, sf)


@register("province_rates", q("SELECT department, province, cases, deaths FROM province_rates", "province_rates"),
          doubles=("cases", "deaths"))
def province_rates(spark, sf):
    return C.province_rates_from(spark, sf)


@register("department_weekly_rates",
          q("SELECT department, week_start, cases, deaths FROM department_rates", "department_rates"),
          doubles=("cases", "deaths"))
def department_weekly_rates(spark, sf):
    return C.department_weekly_rates_from(spark, sf)


# ============================================================ class breaks, classes, maps

_EXACT = ("quantile", "fisher", "geom", "arith", "em")


def _rates_values(spark, sf):
    return B.long_values(B.store(C.department_weekly_rates_from(spark, sf), "rates"), ["cases", "deaths"])


def _order_values(spark, sf):
    return B.clean_values(fx.daily_order_counts(spark, sf).select(F.lit("n_orders").alias("g"),
                                                                  F.col("n_orders").alias("x")))


def _long_breaks(br):
    return br.select("g", F.posexplode("breaks").alias("i", "brk")).select(
        "g", (F.col("i") + 1).cast("bigint").alias("i"), "brk")


_BRK_SQL = "SELECT g, i, brk FROM (SELECT g, unnest(generate_series(1, len(breaks))) AS i, unnest(breaks) AS brk FROM {t})"


def _breaks_entry(key, method, k, values, vals_cte):
    tag = O.breaks_sql(vals_cte, method, k, f"brk_{key}")

    @register(key, q(_BRK_SQL.format(t=tag), tag), doubles=("brk",))
    def run(spark, sf):
        return _long_breaks(B.class_breaks(values(spark, sf), k, method))
    return run


_breaks_entry("breaks_quantile", "quantile", 4, _rates_values, "rate_vals")
_breaks_entry("breaks_geom", "geom", 4, _order_values, "order_vals")
_breaks_entry("breaks_arith", "arith", 4, _rates_values, "rate_vals")
_breaks_entry("breaks_nested_means", "em", 4, _rates_values, "rate_vals")
_breaks_entry("breaks_fisher", "fisher", 4, _order_values, "order_vals")
_breaks_entry("breaks_jenks", "jenks", 3, _order_values, "order_vals")


_breaks_entry("breaks_kmeans", "kmeans", 4, _rates_values, "rate_vals")


@register("breaks_kmeans_ml")
def breaks_kmeans_ml(spark, sf):
    """Spark ML's iterative k-means (fixed seed): rows-only, the answer depends on the start."""
    return _long_breaks(B.kmeans_breaks(_rates_values(spark, sf), 4, groups=["cases", "deaths"]))


O.breaks_sql("rate_vals", "quantile", 4, "cut_q")


@register("cut_class", q(f"""SELECT department, week_start, cases, deaths,
  {O.cut_sql('cases', '(SELECT breaks FROM cut_q WHERE g = $$cases$$)', 4)} AS cases_class,
  {O.cut_sql('deaths', '(SELECT breaks FROM cut_q WHERE g = $$deaths$$)', 4)} AS deaths_class
FROM department_rates""", "department_rates", "cut_q"), doubles=("cases", "deaths"))
def cut_class(spark, sf):
    rates = B.store(C.department_weekly_rates_from(spark, sf), "rates")
    br = B.store(B.quantile_breaks(B.long_values(rates, ["cases", "deaths"]), 4), "breaks")
    return rates.withColumns({f"{c}_class": B.cut_index(F.col(c), br.where(F.col("g") == c).select("breaks").scalar(), 4)
                              for c in ("cases", "deaths")})


for _m in _EXACT:
    O.breaks_sql("rate_vals", _m, 4, f"lab_b_{_m}")
    O.labels_sql(f"lab_b_{_m}", f"lab_l_{_m}")
_LAB_SQL = " UNION ALL ".join(
    f"SELECT g, '{m}' AS method, unnest(generate_series(1, len(labels))) AS class, unnest(labels) AS label FROM lab_l_{m}"
    for m in _EXACT)


@register("cut_label", q(_LAB_SQL, *[f"lab_l_{m}" for m in _EXACT]))
def cut_label(spark, sf):
    vals = B.store(_rates_values(spark, sf), "values")
    out = None
    for m in _EXACT:
        lab = label_table(B.class_breaks(vals, 4, m)).select(
            "g", F.lit(m).alias("method"), F.posexplode("labels").alias("class", "label"))
        lab = lab.withColumn("class", (F.col("class") + 1).cast("bigint"))
        out = lab if out is None else out.unionByName(lab)
    return out


def _classes_sql(methods, as_labels):
    cols, ctes = [], []
    for m in methods:
        tb = O.breaks_sql("rate_vals", m, 4, f"dwc_b_{m}")
        ctes.append(tb)
        if as_labels:
            ctes.append(O.labels_sql(tb, f"dwc_l_{m}"))
        for c in ("cases", "deaths"):
            idx = O.cut_sql(c, f"(SELECT breaks FROM {tb} WHERE g = '{c}')", 4)
            if as_labels:
                cols.append(f"(SELECT labels FROM dwc_l_{m} WHERE g = '{c}')[{idx}] AS {c}_{m}")
            else:
                cols.append(f"CAST({idx} AS INTEGER) AS {c}_{m}")
    return q(f"SELECT department, week_start, {', '.join(cols)} FROM department_rates", "department_rates", *ctes)


@register("department_weekly_classes", _classes_sql(("quantile", "kmeans", "fisher", "geom", "arith", "em"),
                                                   as_labels=True))
def department_weekly_classes(spark, sf):
    return C.department_weekly_classes_from(spark, sf)


@register("department_weekly_classes_exact", _classes_sql(_EXACT, as_labels=False))
def department_weekly_classes_exact(spark, sf):
    return C.department_weekly_classes_from(spark, sf, labels=False, methods=_EXACT)


O.breaks_sql("prov_vals", "jenks", 3, "bi_b")
_BI = f"""SELECT department, province, cases, deaths,
  CASE WHEN cx IS NOT NULL AND cy IS NOT NULL THEN CAST(cx AS VARCHAR) || '-' || CAST(cy AS VARCHAR) END AS bi_class
FROM (SELECT *, {O.cut_sql('cases', "(SELECT breaks FROM bi_b WHERE g = 'cases')", 3)} AS cx,
                {O.cut_sql('deaths', "(SELECT breaks FROM bi_b WHERE g = 'deaths')", 3)} AS cy FROM province_rates)"""
O.cte("province_bi", ("province_rates", "bi_b"), _BI)


@register("bivariate_class", q("SELECT province, bi_class FROM province_bi", "province_bi"))
def bivariate_class(spark, sf):
    return C.province_bivariate_from(spark, sf).select("province", "bi_class")


@register("province_bivariate", q("SELECT * FROM province_bi", "province_bi"), doubles=("cases", "deaths"))
def province_bivariate(spark, sf):
    return C.province_bivariate_from(spark, sf)


@register("province_map", q("""SELECT b.*, g.x1, g.y1, g.x2, g.y2 FROM province_bi b
  LEFT JOIN boundaries g ON b.province = g.province""", "province_bi", "boundaries"), doubles=("cases", "deaths"))
def province_map(spark, sf):
    return C.province_map_from(spark, sf)


@register("dissolve_boundary", q("SELECT * FROM boundaries", "boundaries"))
def dissolve_boundary(spark, sf):
    return C.province_boundaries(fx.district_map(spark, sf))


_SHAPE = ("n_polygons", "n_rings", "n_points", "area")


@register("dissolve_polygons", q("SELECT g AS province, n_polygons, n_rings, n_points, area FROM province_shapes", "province_shapes"))
def dissolve_polygons(spark, sf):
    """G1 as whole geometries: one MULTIPOLYGON per province, told by its counts and area."""
    return C.province_polygons(fx.district_map(spark, sf)).select("province", *_SHAPE)


@register("dissolve_t_junctions", q("SELECT g AS department, n_polygons, n_rings, n_points, area FROM department_shapes", "department_shapes"))
def dissolve_t_junctions(spark, sf):
    """G1 where neighbours share no vertices: districts as bricks, every other row moved by a third of a brick."""
    bricks = fx.brick_map(fx.district_map(spark, sf))
    return PG.dissolve_polygons(bricks, "dep", name="department").select("department", *_SHAPE)


@register("province_polygon_map", q("""SELECT b.*, g.n_polygons, g.n_rings, g.n_points, g.area FROM province_bi b
  LEFT JOIN province_shapes g ON b.province = g.g""", "province_bi", "province_shapes"), doubles=("cases", "deaths"))
def province_polygon_map(spark, sf):
    """C7 with one drawable geometry per row (its counts and area stand for it here)."""
    return C.province_polygon_map(C.province_bivariate_from(spark, sf), fx.district_map(spark, sf)).drop("geometry")


@register("map_ready_table", q("""SELECT b.province, b.bi_class, g.x1, g.y1, g.x2, g.y2 FROM province_bi b
  LEFT JOIN boundaries g ON b.province = g.province""", "province_bi", "boundaries"))
def map_ready_table(spark, sf):
    return G.attach_geometry(C.province_bivariate_from(spark, sf).select("province", "bi_class"),
                             C.province_boundaries(fx.district_map(spark, sf)), "province")


@register("join_left_geometry", q("""SELECT r.*, g.x1, g.y1, g.x2, g.y2 FROM province_rates r
  LEFT JOIN boundaries g ON r.province = g.province""", "province_rates", "boundaries"), doubles=("cases", "deaths"))
def join_left_geometry(spark, sf):
    return G.attach_geometry(C.province_rates_from(spark, sf), C.province_boundaries(fx.district_map(spark, sf)),
                             "province")


@register("agg_dissolve_groups", q("SELECT prov AS province, count(*) AS n_districts FROM district_map GROUP BY 1",
                                   "district_map"))
def agg_dissolve_groups(spark, sf):
    """Group the map by a renamed key; the geometry part of the summary is G1."""
    return A.count_by(fx.district_map(spark, sf), [F.col("prov").alias("province")], "n_districts")


# ============================================================ sources and sinks

CASE_TYPES = "cccccicccc"
DEATH_TYPES = "cciccccccc"
_CASE_COLS = ", ".join(fx.CASE_COLUMNS)


@register("scan_line_list", q(f"SELECT {_CASE_COLS} FROM cases_raw", "cases_raw"))
def scan_line_list(spark, sf):
    path = io.write_table(fx.case_line_list(spark, sf), scratch_path(spark, "cases-csv"), sep=";")
    return io.read_line_list(spark, path, CASE_TYPES)


@register("scan_prefix_columns", q("SELECT ubigeo_2022, ubigeo_2017 FROM crosswalk", "crosswalk"))
def scan_prefix_columns(spark, sf):
    path = io.write_table(fx.crosswalk(spark, sf), scratch_path(spark, "crosswalk-csv"))
    return io.read_delimited(spark, path, "ccc", columns=starts_with("ubigeo"))


@register("scan_single_column", q("SELECT ubigeo FROM population", "population"))
def scan_single_column(spark, sf):
    path = io.write_table(C.population_from(spark, sf), scratch_path(spark, "population-csv"))
    return io.read_delimited(spark, path, "cid", columns=["ubigeo"])


@register("scan_type_string", q("SELECT ubigeo, year, population FROM population", "population"),
          doubles=("population",))
def scan_type_string(spark, sf):
    path = io.write_table(C.population_from(spark, sf), scratch_path(spark, "population-csv"))
    return io.read_delimited(spark, path, "cid")


PREAMBLE = ("POBLACION ESTIMADA", "POR DISTRITO", "", "(fixture export)", "")


@register("scan_skip_preamble", q("SELECT * FROM sheet", "sheet"))
def scan_skip_preamble(spark, sf):
    path = io.write_with_preamble(fx.population_sheet(spark, sf).repartition(4),
                                  scratch_path(spark, "sheet-txt"), PREAMBLE)
    return io.read_sheet(spark, path, skip=5, names=fx.SHEET_COLUMNS)


_BAD = "SELECT '{s}' AS source, '{c}' AS column, {c} AS text, count(*) AS n FROM {t} WHERE {c} IS NOT NULL AND {p} IS NULL GROUP BY {c}"
_PROBLEM_SQL = "\nUNION ALL ".join([
    _BAD.format(s="cases", c="FECHA_RESULTADO", t="cases_raw", p=O.parse("FECHA_RESULTADO")),
    _BAD.format(s="deaths", c="FECHA_FALLECIMIENTO", t="deaths_raw", p=O.parse("FECHA_FALLECIMIENTO")),
    *[_BAD.format(s="population", c=c, t="sheet", p=f"try_cast({c} AS DOUBLE)") for c in fx.SHEET_COLUMNS[2:]]])


@register("scan_problems", q(_PROBLEM_SQL, "cases_raw", "deaths_raw", "sheet"))
def scan_problems(spark, sf):
    """What each source's declared types could not read, by column and text."""
    def report(df, source, types):
        return problem_report(parse_with_problems(df.select(*[F.col(c).cast("string") for c in types]), types), source)

    cases = report(fx.case_line_list(spark, sf), "cases", {"FECHA_RESULTADO": "y", "EDAD": "i"})
    deaths = report(fx.death_line_list(spark, sf), "deaths", {"FECHA_FALLECIMIENTO": "y", "EDAD_DECLARADA": "i"})
    sheet = report(fx.population_sheet(spark, sf), "population", dict.fromkeys(fx.SHEET_COLUMNS[2:], "d"))
    return cases.unionByName(deaths).unionByName(sheet)


@register("scan_workbook", q("SELECT * FROM sheet", "sheet"))
def scan_workbook(spark, sf):
    """S5 from workbooks: the population sheet as four .xlsx files, each with the preamble."""
    path = write_workbooks(fx.population_sheet(spark, sf).repartition(4), scratch_path(spark, "sheet-xlsx"), PREAMBLE)
    return read_workbook(spark, path, fx.SHEET_COLUMNS, skip=5)


_BROKEN = "CASE WHEN c1 LIKE '%3' THEN c2 || chr(10) || 'de \"' || c1 || '\"' || chr(10) WHEN c1 LIKE '%7' THEN '\"' || c2 ELSE c2 END"


@register("scan_quoted_breaks", q(f"SELECT c1, {_BROKEN} AS c2, c3, c4, c5, c6, c7 FROM sheet", "sheet"))
def scan_quoted_breaks(spark, sf):
    """S5 with quotes and line breaks inside cells; some records cross the file splits."""
    sheet = fx.population_sheet(spark, sf).withColumn("c2", F.expr(_BROKEN))
    path = io.write_with_preamble(sheet.repartition(4), scratch_path(spark, "sheet-breaks"), PREAMBLE)
    return io.read_sheet(spark, path, skip=5, names=fx.SHEET_COLUMNS)


_BROKEN_PLACE = "CASE WHEN ID_PERSONA LIKE '%3' THEN DISTRITO || chr(10) || 'de \"' || PROVINCIA || '\"; ' || chr(10) ELSE DISTRITO END"


@register("scan_line_list_breaks", q("SELECT " + ", ".join(f"{_BROKEN_PLACE} AS DISTRITO" if c == "DISTRITO" else c for c in fx.CASE_COLUMNS) + " FROM cases_raw", "cases_raw"))
def scan_line_list_breaks(spark, sf):
    """S1 with separators, quotes and line breaks inside a cell of the line list."""
    cases = fx.case_line_list(spark, sf).select(*fx.CASE_COLUMNS).withColumn("DISTRITO", F.expr(_BROKEN_PLACE))
    path = io.write_with_preamble(cases, scratch_path(spark, "cases-breaks"), [";".join(fx.CASE_COLUMNS)], sep=";")
    return io.read_line_list(spark, path, CASE_TYPES, quoted_breaks=True)


@register("scan_dimension", q("SELECT * FROM district_map", "district_map"))
def scan_dimension(spark, sf):
    path = io.write_table(fx.district_map(spark, sf), scratch_path(spark, "districts-parquet"), fmt="parquet")
    return io.load_dimension(spark, path)


@register("sink_roundtrip", q("""SELECT k.ubigeo, y.year, p.population
  FROM (SELECT DISTINCT ubigeo FROM pop_sparse) k CROSS JOIN (SELECT unnest([2018, 2019, 2020, 2021, 2022]) AS year) y
  LEFT JOIN pop_sparse p ON p.ubigeo = k.ubigeo AND p.year = y.year""", "pop_sparse"), doubles=("population",))
def sink_roundtrip(spark, sf):
    dense = R.complete_fixed(_pop_sparse(spark, sf), ["ubigeo"], "year", fx.POPULATION_YEARS)
    path = io.write_table(dense.select("ubigeo", "year", "population"), scratch_path(spark, "sink-csv"))
    return io.read_delimited(spark, path, "cid")


# ============================================================ projections
def _cases_lower(spark, sf):
    return P.lower_names(fx.case_line_list(spark, sf))


@register("proj_lower_names", q("SELECT * FROM cases_lower", "cases_lower"))
def proj_lower_names(spark, sf):
    return _cases_lower(spark, sf)


_POP_NAMED = ("SELECT c1 AS ubigeo, c2 AS district, c3 AS population_2018, c4 AS population_2019, "
              "c5 AS population_2020, c6 AS population_2021, c7 AS population_2022 FROM sheet")


@register("proj_positional_names", q(_POP_NAMED, "sheet"))
def proj_positional_names(spark, sf):
    return P.set_names(fx.population_sheet(spark, sf), C.POP_NAMES)


@register("proj_rename", q("SELECT * FROM pop_wide", "pop_wide"),
          doubles=tuple(f"population_{y}" for y in fx.POPULATION_YEARS))
def proj_rename(spark, sf):
    return C.population_wide(fx.population_sheet(spark, sf), fx.crosswalk(spark, sf))


@register("proj_select_rename", q("SELECT * FROM districts", "districts"))
def proj_select_rename(spark, sf):
    return P.select_as(fx.district_map(spark, sf),
                       {"ubigeo": "ubigeo", "department": "dep", "province": "prov", "district": "distr"})


@register("proj_drop", q("SELECT ubigeo, population FROM population", "population"), doubles=("population",))
def proj_drop(spark, sf):
    return C.population_from(spark, sf).drop("year")


@register("proj_drop_geometry", q("SELECT ubigeo, dep, prov, distr FROM district_map", "district_map"))
def proj_drop_geometry(spark, sf):
    return P.drop_geometry(fx.district_map(spark, sf))


@register("proj_mutate", q("SELECT * FROM cases_valid", "cases_valid"))
def proj_mutate(spark, sf):
    return C.valid_cases(fx.case_line_list(spark, sf))


@register("proj_mutate_consume", q("SELECT * FROM deaths_valid", "deaths_valid"))
def proj_mutate_consume(spark, sf):
    return C.valid_deaths(fx.death_line_list(spark, sf))


_CLEAN_COLS = ", ".join(f"{O._clean(f'population_{y}')} AS population_{y}" for y in fx.POPULATION_YEARS)


@register("proj_across_prefix", q(f"SELECT ubigeo, district, {_CLEAN_COLS}, ubigeo_2017 FROM pop_harmonised",
                                  "pop_harmonised"),
          doubles=tuple(f"population_{y}" for y in fx.POPULATION_YEARS))
def proj_across_prefix(spark, sf):
    h = C.harmonise(C.clean_sheet(fx.population_sheet(spark, sf)), fx.crosswalk(spark, sf))
    h = across(h, starts_with("population"), letters_to_zero)
    return across(h, starts_with("population"), to_double)


O.cte("province_counts_pop", ("province_counts", "province_population"), """
SELECT c.department, c.province, c.cases, c.deaths, p.population FROM province_counts c
LEFT JOIN province_population p
  ON c.department IS NOT DISTINCT FROM p.department AND c.province IS NOT DISTINCT FROM p.province""")


def _province_counts_pop(spark, sf):
    pop = C.population_from(spark, sf)
    cases = C.weekly_cases(fx.case_line_list(spark, sf), pop)
    deaths = C.weekly_deaths(fx.death_line_list(spark, sf), pop)
    dist = C.districts_from(spark, sf)
    counts = J.join_on(J.join_on(cases, deaths, ["ubigeo", "week_start"]), dist, ["ubigeo"], "left")
    prov_counts = A.sum_by(counts, ["department", "province"], ["cases", "deaths"])
    prov_pop = A.sum_by(J.join_on(dist, C.population_year(pop), ["ubigeo"]), ["department", "province"],
                        ["population"])
    return J.join_null_safe(prov_counts, prov_pop, ["department", "province"], "left")


@register("proj_across_range", q(f"""SELECT department, province, {O.rate('cases')} AS cases,
  {O.rate('deaths')} AS deaths, population FROM province_counts_pop""", "province_counts_pop"),
          doubles=("cases", "deaths", "population"))
def proj_across_range(spark, sf):
    return across(_province_counts_pop(spark, sf), col_range("cases", "deaths"),
                  lambda c: per_100k(c, F.col("population")))


@register("proj_across_template", q(f"""SELECT department, province, cases, deaths, population,
  {O.rate('cases')} AS cases_rate, {O.rate('deaths')} AS deaths_rate FROM province_counts_pop""",
                                    "province_counts_pop"),
          doubles=("cases_rate", "deaths_rate", "population"))
def proj_across_template(spark, sf):
    return across(_province_counts_pop(spark, sf), col_range("cases", "deaths"),
                  lambda c: per_100k(c, F.col("population")), names="{col}_rate")


@register("distinct_keys", q("SELECT DISTINCT ubigeo FROM population", "population"))
def distinct_keys(spark, sf):
    return P.distinct_keys(C.population_from(spark, sf), "ubigeo")


@register("proj_relabel", q("""SELECT week_start, name, CASE name WHEN 'cases' THEN 'Positive cases'
  WHEN 'deaths' THEN 'Deaths' ELSE name END AS label, value FROM national_long""", "national_long"))
def proj_relabel(spark, sf):
    long = C.national_weekly_long_from(spark, sf)
    return long.select("week_start", "name", P.relabel(F.col("name"), fx.FACET_NAMES).alias("label"), "value")


# ============================================================ filters
@register("filter_drop_na", q("SELECT * FROM cases_lower WHERE ubigeo IS NOT NULL AND fecha_resultado IS NOT NULL",
                              "cases_lower"))
def filter_drop_na(spark, sf):
    return FL.drop_na(_cases_lower(spark, sf), "ubigeo", "fecha_resultado")


@register("filter_not_match", q("SELECT * FROM sheet WHERE c1 IS NOT NULL AND c2 IS NOT NULL "
                                "AND NOT regexp_matches(c1, 'UBIGEO')", "sheet"))
def filter_not_match(spark, sf):
    sheet = FL.drop_na(fx.population_sheet(spark, sf), "c1", "c2")
    return sheet.where(FL.not_matching(F.col("c1"), "UBIGEO"))


@register("filter_substring", q("SELECT * FROM sheet WHERE c1 IS NOT NULL AND c2 IS NOT NULL "
                                "AND NOT regexp_matches(c1, 'UBIGEO') AND substring(c1, 5, 2) <> '00'", "sheet"))
def filter_substring(spark, sf):
    sheet = FL.drop_na(fx.population_sheet(spark, sf), "c1", "c2")
    return sheet.where(FL.not_matching(F.col("c1"), "UBIGEO")).where(FL.substring_not_equal(F.col("c1"), 5, 2, "00"))


@register("filter_between", q("SELECT * FROM cases_lower WHERE edad BETWEEN 0 AND 123", "cases_lower"))
def filter_between(spark, sf):
    return _cases_lower(spark, sf).where(FL.between(F.col("edad"), fx.AGE_MIN, fx.AGE_MAX))


@register("filter_sentinel", q(f"SELECT * FROM cases_lower WHERE provincia <> {O.SENT} AND distrito <> {O.SENT}",
                               "cases_lower"))
def filter_sentinel(spark, sf):
    return _cases_lower(spark, sf).where(FL.not_sentinel("provincia", "distrito", fx.SENTINEL))


@register("filter_date_floor", q(f"""SELECT * FROM (SELECT *, {O.parse('fecha_resultado')} AS dx_date FROM cases_lower)
  WHERE dx_date >= DATE '2020-03-01'""", "cases_lower"))
def filter_date_floor(spark, sf):
    ll = P.mutate(_cases_lower(spark, sf), {"dx_date": parse_ymd(F.col("fecha_resultado"))})
    return ll.where(FL.on_or_after(F.col("dx_date"), fx.DATE_FLOOR))


@register("filter_year", q("SELECT * FROM population WHERE year = 2020", "population"), doubles=("population",))
def filter_year(spark, sf):
    return C.population_from(spark, sf).where(FL.equals(F.col("year"), fx.RATE_YEAR))


# ============================================================ joins
@register("join_left_crosswalk", q("""SELECT p.*, cw.ubigeo_2017 FROM pop_named p
  LEFT JOIN crosswalk cw ON p.ubigeo = cw.ubigeo_2022""", "pop_named", "crosswalk"))
def join_left_crosswalk(spark, sf):
    cw = fx.crosswalk(spark, sf)
    cw = cw.select(*starts_with("ubigeo")(cw.columns))
    return J.left_join_renamed(C.clean_sheet(fx.population_sheet(spark, sf)), cw, "ubigeo", "ubigeo_2022")


@register("join_left_grid", q("""SELECT g.ubigeo, g.dx_date, c.cases FROM cases_grid g
  LEFT JOIN cases_daily_counts c ON g.ubigeo = c.ubigeo AND g.dx_date = c.dx_date""",
                              "cases_grid", "cases_daily_counts"))
def join_left_grid(spark, sf):
    ev = C.valid_cases(fx.case_line_list(spark, sf)).select("ubigeo", "dx_date")
    grid = R.cross_calendar(P.distinct_keys(C.population_from(spark, sf), "ubigeo"), ev, "dx_date")
    daily = A.count_by(ev, ["ubigeo", "dx_date"], "cases")
    return J.join_on(grid, daily, ["ubigeo", "dx_date"], "left")


@register("join_left_dim", q("SELECT * FROM weekly_cases LEFT JOIN districts USING (ubigeo)",
                             "weekly_cases", "districts"))
def join_left_dim(spark, sf):
    return J.join_on(C.weekly_cases_from(spark, sf), C.districts_from(spark, sf), ["ubigeo"], "left")


@register("join_left_nullsafe", q("SELECT * FROM province_counts_pop", "province_counts_pop"),
          doubles=("population",))
def join_left_nullsafe(spark, sf):
    return _province_counts_pop(spark, sf)


@register("join_inner_single", q("SELECT * FROM districts JOIN pop_2020 USING (ubigeo)", "districts", "pop_2020"),
          doubles=("population",))
def join_inner_single(spark, sf):
    return J.join_on(C.districts_from(spark, sf), C.population_year(C.population_from(spark, sf)), ["ubigeo"])


@register("join_inner_multi", q("""SELECT c.ubigeo, c.week_start, c.cases, d.deaths FROM weekly_cases c
  JOIN weekly_deaths d ON c.ubigeo IS NOT DISTINCT FROM d.ubigeo AND c.week_start = d.week_start""", "weekly_cases", "weekly_deaths"))
def join_inner_multi(spark, sf):
    pop = C.population_from(spark, sf)
    return J.join_null_safe(C.weekly_cases(fx.case_line_list(spark, sf), pop),
                            C.weekly_deaths(fx.death_line_list(spark, sf), pop), ["ubigeo", "week_start"], "inner")


@register("join_clustered", q("""SELECT c.ubigeo, c.week_start, c.cases, d.deaths, m.province FROM weekly_cases c
  JOIN weekly_deaths d ON c.ubigeo = d.ubigeo AND c.week_start = d.week_start
  LEFT JOIN (SELECT ubigeo, prov AS province FROM district_map) m ON c.ubigeo = m.ubigeo""", "weekly_cases", "weekly_deaths", "district_map"))
def join_clustered(spark, sf):
    """J6 and J2 over interim tables in buckets by district: neither join shuffles."""
    pop = C.population_from(spark, sf)
    dims = fx.district_map(spark, sf).select("ubigeo", F.col("prov").alias("province"))
    cases = write_clustered(C.weekly_cases(fx.case_line_list(spark, sf), pop), "cases", ["ubigeo"], ["week_start"])
    deaths = write_clustered(C.weekly_deaths(fx.death_line_list(spark, sf), pop), "deaths", ["ubigeo"], ["week_start"])
    return J.join_on(J.join_on(cases, deaths, ["ubigeo", "week_start"]), write_clustered(dims, "districts", ["ubigeo"]), ["ubigeo"], "left")


@register("join_reduce", q("SELECT * FROM national_wide", "national_wide"))
def join_reduce(spark, sf):
    pop = C.population_from(spark, sf)
    cw = A.sum_by(C.weekly_cases(fx.case_line_list(spark, sf), pop), ["week_start"], ["cases"])
    dw = A.sum_by(C.weekly_deaths(fx.death_line_list(spark, sf), pop), ["week_start"], ["deaths"])
    return J.join_reduce([cw, dw], ["week_start"])


@register("join_cross_calendar", q("SELECT * FROM cases_grid", "cases_grid"))
def join_cross_calendar(spark, sf):
    ev = C.valid_cases(fx.case_line_list(spark, sf))
    return R.cross_calendar(P.distinct_keys(C.population_from(spark, sf), "ubigeo"), ev, "dx_date")


# ============================================================ aggregates
@register("agg_count", q("SELECT * FROM cases_daily_counts", "cases_daily_counts"))
def agg_count(spark, sf):
    return A.count_by(C.valid_cases(fx.case_line_list(spark, sf)), ["ubigeo", "dx_date"], "cases")


@register("agg_sum", q("SELECT week_start, CAST(sum(cases) AS BIGINT) AS cases FROM weekly_cases GROUP BY 1",
                       "weekly_cases"))
def agg_sum(spark, sf):
    return A.sum_by(C.weekly_cases_from(spark, sf), ["week_start"], ["cases"])


@register("agg_multi_sum", q("SELECT * FROM province_counts", "province_counts"))
def agg_multi_sum(spark, sf):
    return _province_counts_pop(spark, sf).drop("population")


_SUM_COLS = ", ".join(f"coalesce(sum({O._clean(f'population_{y}')}), 0.0) AS population_{y}"
                      for y in fx.POPULATION_YEARS)


@register("agg_across_sum", q(f"SELECT ubigeo_2017, {_SUM_COLS} FROM pop_harmonised GROUP BY ubigeo_2017",
                              "pop_harmonised"), doubles=tuple(f"population_{y}" for y in fx.POPULATION_YEARS))
def agg_across_sum(spark, sf):
    h = C.harmonise(C.clean_sheet(fx.population_sheet(spark, sf)), fx.crosswalk(spark, sf))
    h = across(across(h, starts_with("population"), letters_to_zero), starts_with("population"), to_double)
    return A.sum_across(h, ["ubigeo_2017"], starts_with("population"))


@register("agg_weekly_sum", q("SELECT ubigeo, week_start, cases FROM weekly_cases", "weekly_cases"))
def agg_weekly_sum(spark, sf):
    """A5 on the reference's literal key x day grid (checks the fast path's equivalence)."""
    return C.weekly_cases_from(spark, sf, daily_grid=True)


@register("agg_bounds", q("SELECT min(dx_date) AS lo, max(dx_date) AS hi FROM cases_valid", "cases_valid"))
def agg_bounds(spark, sf):
    return A.bounds(C.valid_cases(fx.case_line_list(spark, sf)), "dx_date")


@register("agg_group_bounds", q("SELECT ubigeo, min(dx_date) AS lo, max(dx_date) AS hi FROM cases_valid GROUP BY 1",
                                "cases_valid"))
def agg_group_bounds(spark, sf):
    return A.group_bounds(C.valid_cases(fx.case_line_list(spark, sf)), ["ubigeo"], "dx_date")


# ============================================================ reshape / densify
@register("reshape_longer_prefix", q(" UNION ALL ".join(
    f"SELECT ubigeo, '{y}' AS year, population_{y} AS population FROM pop_wide" for y in fx.POPULATION_YEARS),
    "pop_wide"), doubles=("population",))
def reshape_longer_prefix(spark, sf):
    wide = C.population_wide(fx.population_sheet(spark, sf), fx.crosswalk(spark, sf))
    return R.pivot_longer(wide, starts_with("population"), "year", "population", names_prefix="population_")


@register("reshape_longer_rest", q("SELECT week_start, name, value FROM national_long", "national_long"))
def reshape_longer_rest(spark, sf):
    wide = join_reduce(spark, sf)
    return R.pivot_longer(wide, lambda cols: [c for c in cols if c != "week_start"])


def _pop_sparse(spark, sf):
    pop = C.population_from(spark, sf)
    return pop.where((F.col("year") + F.substring("ubigeo", 4, 3).cast("int")) % 3 != 0)


@register("densify_fixed", q("""SELECT k.ubigeo, y.year, p.population
  FROM (SELECT DISTINCT ubigeo FROM pop_sparse) k CROSS JOIN (SELECT unnest([2018, 2019, 2020, 2021, 2022]) AS year) y
  LEFT JOIN pop_sparse p ON p.ubigeo = k.ubigeo AND p.year = y.year""", "pop_sparse"), doubles=("population",))
def densify_fixed(spark, sf):
    return R.complete_fixed(_pop_sparse(spark, sf), ["ubigeo"], "year", fx.POPULATION_YEARS)


@register("densify_daily", q("""SELECT b.ubigeo, b.dx_date, c.cases FROM (
    SELECT ubigeo, CAST(unnest(generate_series(min(dx_date), max(dx_date), INTERVAL 1 DAY)) AS DATE) AS dx_date
    FROM cases_daily_sparse GROUP BY ubigeo) b
  LEFT JOIN cases_daily_sparse c ON b.ubigeo = c.ubigeo AND b.dx_date = c.dx_date""", "cases_daily_sparse"))
def densify_daily(spark, sf):
    daily = A.count_by(C.valid_cases(fx.case_line_list(spark, sf)), ["ubigeo", "dx_date"], "cases")
    return R.complete_dates(daily, ["ubigeo"], "dx_date")


@register("calendar_daily", q("SELECT * FROM cases_days", "cases_days"))
def calendar_daily(spark, sf):
    return R.calendar(C.valid_cases(fx.case_line_list(spark, sf)), "dx_date")


@register("replace_na", q("SELECT ubigeo, dx_date, cases FROM cases_daily", "cases_daily"))
def replace_na(spark, sf):
    return R.replace_na(join_left_grid(spark, sf), {"cases": 0})


@register("sort_key_date", q("SELECT * FROM cases_grid ORDER BY ubigeo, dx_date", "cases_grid"))
def sort_key_date(spark, sf):
    return R.sort_by(join_cross_calendar(spark, sf), "ubigeo", "dx_date")


# ============================================================ scalar functions
@register("date_parse_ymd", q(f"SELECT fecha_resultado, {O.parse('fecha_resultado')} AS dx_date FROM cases_lower",
                              "cases_lower"))
def date_parse_ymd(spark, sf):
    return _cases_lower(spark, sf).select("fecha_resultado", parse_ymd(F.col("fecha_resultado")).alias("dx_date"))


@register("date_week_floor", q(f"SELECT dx_date, {O.week('dx_date')} AS week_start FROM cases_days", "cases_days"))
def date_week_floor(spark, sf):
    days = calendar_daily(spark, sf)
    return days.select("dx_date", week_floor(F.col("dx_date")).alias("week_start"))


@register("date_epi_week", q(f"SELECT week_start, {O.epi('week_start')} FROM (SELECT DISTINCT week_start FROM weekly_cases)",
                             "weekly_cases"))
def date_epi_week(spark, sf):
    weeks = C.weekly_cases_from(spark, sf).select("week_start").distinct()
    ws = F.col("week_start")
    return weeks.select("week_start", epi_year(ws).alias("epi_year"), epi_week(ws).alias("epi_week"),
                        year_week_label(ws).alias("year_week"))


@register("str_match", q("""SELECT c1, c3, regexp_matches(c1, 'UBIGEO') AS is_header,
  regexp_matches(c3, '[a-zA-Z]') AS has_letters FROM sheet""", "sheet"))
def str_match(spark, sf):
    s = fx.population_sheet(spark, sf)
    return s.select("c1", "c3", F.col("c1").rlike("UBIGEO").alias("is_header"),
                    F.col("c3").rlike("[a-zA-Z]").alias("has_letters"))


@register("str_substring", q("SELECT c1, substring(c1, 5, 2) AS code56 FROM sheet", "sheet"))
def str_substring(spark, sf):
    return fx.population_sheet(spark, sf).select("c1", F.substring("c1", 5, 2).alias("code56"))


@register("cond_coalesce", q("SELECT ubigeo, ubigeo_2017 FROM pop_harmonised", "pop_harmonised"))
def cond_coalesce(spark, sf):
    return C.harmonise(C.clean_sheet(fx.population_sheet(spark, sf)), fx.crosswalk(spark, sf)) \
        .select("ubigeo", "ubigeo_2017")


_TXT = ", ".join(f"CASE WHEN regexp_matches(population_{y}, '[a-zA-Z]') THEN '0' ELSE population_{y} END "
                 f"AS population_{y}" for y in fx.POPULATION_YEARS)


@register("cond_pattern", q(f"SELECT ubigeo, {_TXT} FROM pop_named", "pop_named"))
def cond_pattern(spark, sf):
    named = C.clean_sheet(fx.population_sheet(spark, sf)).drop("district")
    return across(named, starts_with("population"), letters_to_zero)


@register("cast_double", q(f"SELECT ubigeo, {_CLEAN_COLS} FROM pop_named", "pop_named"),
          doubles=tuple(f"population_{y}" for y in fx.POPULATION_YEARS))
def cast_double(spark, sf):
    named = C.clean_sheet(fx.population_sheet(spark, sf)).drop("district")
    return across(across(named, starts_with("population"), letters_to_zero), starts_with("population"), to_double)


@register("cast_year", q("SELECT ubigeo, year FROM population", "population"))
def cast_year(spark, sf):
    return reshape_longer_prefix(spark, sf).select("ubigeo", F.col("year").cast("int").alias("year"))


@register("rate_per_100k", q(f"""SELECT department, {O.rate('cases', 'population')} AS cases,
  {O.rate('deaths', 'population')} AS deaths FROM (
  SELECT department, sum(cases) AS cases, sum(deaths) AS deaths, sum(population) AS population
  FROM province_counts_pop GROUP BY department)""", "province_counts_pop"),
          doubles=("cases", "deaths"))
def rate_per_100k(spark, sf):
    dep = (_province_counts_pop(spark, sf)
           .groupBy("department").agg(F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths"),
                                      F.sum("population").alias("population")))
    return dep.select("department", per_100k(F.col("cases"), F.col("population")).alias("cases"),
                      per_100k(F.col("deaths"), F.col("population")).alias("deaths"))



# ============================================================ quirks Q1, Q2
O.cte("cases_harmonised", ("cases_valid", "crosswalk"), """
SELECT coalesce(cw.ubigeo_2017, v.ubigeo) AS ubigeo, v.dx_date FROM cases_valid v
LEFT JOIN crosswalk cw ON v.ubigeo = cw.ubigeo_2022""")
O.cte("weekly_cases_harmonised", ("pop_keys", "cases_harmonised"), f"""
SELECT k.ubigeo, w.week_start, CAST(coalesce(c.cases, 0) AS BIGINT) AS cases
FROM pop_keys k
CROSS JOIN (SELECT CAST(unnest(generate_series({O.week('min(dx_date)')}, {O.week('max(dx_date)')}, INTERVAL 7 DAY))
                   AS DATE) AS week_start FROM cases_harmonised) w
LEFT JOIN (SELECT ubigeo, {O.week('dx_date')} AS week_start, count(*) AS cases FROM cases_harmonised GROUP BY 1, 2) c
  ON c.ubigeo = k.ubigeo AND c.week_start = w.week_start""")


@register("weekly_cases_harmonised", q("SELECT * FROM weekly_cases_harmonised", "weekly_cases_harmonised"))
def weekly_cases_harmonised(spark, sf):
    """Q2 option: events mapped through the crosswalk before counting (split districts kept)."""
    pop = C.population_from(spark, sf)
    return C.case_series(fx.case_line_list(spark, sf), pop, fx.crosswalk(spark, sf)).dense()


@register("unknown_district_events", q("""
SELECT 'cases' AS source, CAST(count(*) AS BIGINT) AS events,
       CAST(count(*) FILTER (WHERE ubigeo NOT IN (SELECT ubigeo FROM pop_keys)) AS BIGINT) AS dropped FROM cases_valid
UNION ALL
SELECT 'deaths', CAST(count(*) AS BIGINT),
       CAST(count(*) FILTER (WHERE ubigeo NOT IN (SELECT ubigeo FROM pop_keys)) AS BIGINT) FROM deaths_valid""",
                                       "cases_valid", "deaths_valid", "pop_keys"))
def unknown_district_events(spark, sf):
    """Q1: how many valid events vanish because their code has no population row."""
    cs, ds, _ = C.series_from(spark, sf)
    return C.dropped_events(cs, "cases").unionByName(C.dropped_events(ds, "deaths"))



@register("days_in_week", q(f"""SELECT {O.week('dx_date')} AS week_start, CAST(count(*) AS INTEGER) AS days_in_week
FROM cases_days GROUP BY 1""", "cases_days"))
def days_in_week(spark, sf):
    """Q7 option: calendar days covered by each week of the case series."""
    return R.days_in_week(C.valid_cases(fx.case_line_list(spark, sf)), "dx_date")


@register("department_weekly_classes_labels", _classes_sql(_EXACT, as_labels=True))
def department_weekly_classes_labels(spark, sf):
    """C9 with interval labels for the five deterministic methods (k-means excluded)."""
    return C.department_weekly_classes_from(spark, sf, labels=True, methods=_EXACT)
