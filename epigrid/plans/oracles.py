"""DuckDB SQL for the correctness oracle.

The fixture mapping and each pipeline are written again here as plain SQL over
the driver's views (``lineitem``, ``supplier``, ...).  The SQL follows the
reference's literal plan (e.g. the key x day grid), not our Spark plan, so the
two are independent checks of each other.  ``with_(...)`` assembles a WITH
clause from named CTE fragments and their dependencies.
"""

from __future__ import annotations

SENT = "'EN INVESTIGACIÓN'"
SHIFT = 9131

_DATE_TEXT = """CASE WHEN ln = 6 AND ok % 2 = 0 THEN NULL
         WHEN ln = 5 THEN strftime({d}, '%Y-%m-%d')
         WHEN ln = 4 THEN strftime({d}, '%Y/%m/%d')
         WHEN ln = 3 AND ok % 10 = 0 THEN 'SIN DATO'
         ELSE strftime({d}, '%Y%m%d') END"""
_AGE = "CASE WHEN ln = 2 AND ok % 4 = 0 THEN NULL ELSE CAST(floor(q) AS INTEGER) * 3 - 20 END"
_LI = """(SELECT *, l_linenumber AS ln, l_orderkey AS ok, l_quantity AS q,
                 CAST(l_shipdate AS DATE) AS d0 FROM lineitem)"""

PARSE = ("CAST(coalesce(try_strptime({x}, '%Y%m%d'), try_strptime({x}, '%Y-%m-%d'), "
         "try_strptime({x}, '%Y/%m/%d'), try_strptime({x}, '%Y.%m.%d')) AS DATE)")


def parse(x: str) -> str:
    return PARSE.format(x=x)


def week(d: str) -> str:
    """Sunday on or before d (DuckDB dayofweek: Sunday = 0)."""
    return f"CAST({d} - CAST(dayofweek({d}) AS INTEGER) AS DATE)"


CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTE[name] = (deps, sql)


cte("cases_raw", (), f"""
SELECT '20240208' AS FECHA_CORTE,
       'DEP_' || CAST(l_suppkey % 5 AS VARCHAR) AS DEPARTAMENTO,
       CASE WHEN l_returnflag = 'N' THEN {SENT} WHEN ln = 1 AND ok % 9 = 0 THEN NULL
            ELSE 'PROV_' || l_returnflag END AS PROVINCIA,
       CASE WHEN l_linestatus = 'O' AND ln = 2 THEN {SENT} ELSE 'DIST_' || l_linestatus END AS DISTRITO,
       CASE WHEN ok % 3 = 0 THEN 'PCR' WHEN ok % 3 = 1 THEN 'PR' ELSE 'AG' END AS METODODX,
       {_AGE} AS EDAD,
       CASE WHEN l_partkey % 2 = 0 THEN 'MASCULINO' ELSE 'FEMENINO' END AS SEXO,
       {_DATE_TEXT.format(d=f'(d0 + {SHIFT})')} AS FECHA_RESULTADO,
       CASE WHEN ln = 7 THEN NULL ELSE repeat('0', greatest(0, 6 - length(CAST(l_suppkey AS VARCHAR)))) || CAST(l_suppkey AS VARCHAR) END AS UBIGEO,
       CAST(l_orderkey AS VARCHAR) AS ID_PERSONA
FROM {_LI}""")

cte("deaths_raw", (), f"""
SELECT '20240208' AS FECHA_CORTE,
       {_DATE_TEXT.format(d=f'(d0 + CAST({SHIFT} + ok % 29 AS INTEGER))')} AS FECHA_FALLECIMIENTO,
       {_AGE} AS EDAD_DECLARADA,
       CASE WHEN l_partkey % 2 = 0 THEN 'MASCULINO' ELSE 'FEMENINO' END AS SEXO,
       CASE WHEN ok % 2 = 0 THEN 'CRITERIO VIROLOGICO' ELSE 'CRITERIO SINADEF' END AS CLASIFICACION_DEF,
       'DEP_' || CAST(l_suppkey % 5 AS VARCHAR) AS DEPARTAMENTO,
       CASE WHEN ln = 1 AND ok % 9 = 0 THEN NULL ELSE 'PROV_R' END AS PROVINCIA,
       CASE WHEN l_linestatus = 'O' AND ln = 2 THEN {SENT} ELSE 'DIST_' || l_linestatus END AS DISTRITO,
       CASE WHEN ln = 7 THEN NULL ELSE repeat('0', greatest(0, 6 - length(CAST(l_suppkey AS VARCHAR)))) || CAST(l_suppkey AS VARCHAR) END AS UBIGEO,
       'U' || CAST(l_orderkey AS VARCHAR) AS UUID
FROM {_LI} WHERE l_returnflag = 'R'""")


def _cell(k: int) -> str:
    v = f"CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) + {37 * k} AS VARCHAR)"
    parts = []
    if k == 1:
        parts.append("WHEN s_suppkey % 17 = 0 THEN 'n.d.'")
    if k == 3:
        parts.append(f"WHEN s_suppkey % 19 = 0 THEN {v} || ',5'")
    if k == 4:
        parts.append("WHEN s_suppkey % 23 = 0 THEN NULL")
    if not parts:
        return f"{v} AS c{k + 3}"
    return f"CASE {' '.join(parts)} ELSE {v} END AS c{k + 3}"


_YEARS = (2018, 2019, 2020, 2021, 2022)
cte("sheet", (), f"""
SELECT repeat('0', greatest(0, 6 - length(CAST(s_suppkey AS VARCHAR)))) || CAST(s_suppkey AS VARCHAR) AS c1, s_name AS c2, {', '.join(_cell(k) for k in range(5))}
FROM supplier
UNION ALL
SELECT 'UBIGEO', 'DISTRITO', {', '.join(f"'POBLACION {y}'" for y in _YEARS)} FROM supplier WHERE s_suppkey % 50 = 1
UNION ALL
SELECT 'Nota ' || CAST(s_suppkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 40 = 3""")

cte("crosswalk", (), """
SELECT repeat('0', greatest(0, 6 - length(CAST(s_suppkey AS VARCHAR)))) || CAST(s_suppkey AS VARCHAR) AS ubigeo_2022,
       repeat('0', greatest(0, 6 - length(CAST(s_suppkey - s_suppkey % 10 + 1 AS VARCHAR)))) || CAST(s_suppkey - s_suppkey % 10 + 1 AS VARCHAR) AS ubigeo_2017,
       repeat('0', greatest(0, 6 - length(CAST(s_suppkey AS VARCHAR)))) || CAST(s_suppkey AS VARCHAR) || ' was split from '
         || repeat('0', greatest(0, 6 - length(CAST(s_suppkey - s_suppkey % 10 + 1 AS VARCHAR)))) || CAST(s_suppkey - s_suppkey % 10 + 1 AS VARCHAR) AS notes
FROM supplier WHERE s_suppkey % 10 IN (8, 9)""")

cte("district_map", (), """
SELECT repeat('0', greatest(0, 6 - length(CAST(s_suppkey AS VARCHAR)))) || CAST(s_suppkey AS VARCHAR) AS ubigeo, r_name AS dep, n_name AS prov, s_name AS distr,
       'POLYGON ((' || x || ' ' || y || ', ' || (x + 1) || ' ' || y || ', ' || (x + 1) || ' ' || (y + 1)
       || ', ' || x || ' ' || (y + 1) || ', ' || x || ' ' || y || '))' AS geometry
FROM (SELECT *, CAST(s_suppkey % 10 AS BIGINT) AS x, CAST(s_suppkey // 10 AS BIGINT) AS y FROM supplier) s
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE s_suppkey % 25 <> 3""")

cte("districts", ("district_map",), """
SELECT ubigeo, dep AS department, prov AS province, distr AS district FROM district_map""")

cte("order_days", (), """
SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS DOUBLE) AS n_orders FROM orders GROUP BY 1""")

# ---- C1 population -----------------------------------------------------------
cte("pop_named", ("sheet",), """
SELECT c1 AS ubigeo, c2 AS district, c3 AS population_2018, c4 AS population_2019,
       c5 AS population_2020, c6 AS population_2021, c7 AS population_2022
FROM sheet
WHERE c1 IS NOT NULL AND c2 IS NOT NULL AND NOT regexp_matches(c1, 'UBIGEO')
  AND substring(c1, 5, 2) <> '00'""")

cte("pop_harmonised", ("pop_named", "crosswalk"), """
SELECT p.*, coalesce(cw.ubigeo_2017, p.ubigeo) AS ubigeo_2017
FROM pop_named p LEFT JOIN crosswalk cw ON p.ubigeo = cw.ubigeo_2022""")


def _clean(c: str) -> str:
    return f"TRY_CAST(CASE WHEN regexp_matches({c}, '[a-zA-Z]') THEN '0' ELSE {c} END AS DOUBLE)"


cte("pop_wide", ("pop_harmonised",), f"""
SELECT ubigeo_2017 AS ubigeo, {', '.join(f"coalesce(sum({_clean(f'population_{y}')}), 0.0) AS population_{y}" for y in _YEARS)}
FROM pop_harmonised GROUP BY ubigeo_2017""")

cte("population", ("pop_wide",), " UNION ALL ".join(
    f"SELECT ubigeo, CAST({y} AS INTEGER) AS year, population_{y} AS population FROM pop_wide" for y in _YEARS))

cte("pop_2020", ("population",), "SELECT ubigeo, population FROM population WHERE year = 2020")

# ---- C2 / C3 ------------------------------------------------------------------
cte("cases_valid", ("cases_raw",), f"""
SELECT * FROM (
  SELECT FECHA_CORTE AS fecha_corte, DEPARTAMENTO AS departamento, PROVINCIA AS provincia,
         DISTRITO AS distrito, METODODX AS metododx, EDAD AS edad, SEXO AS sexo,
         FECHA_RESULTADO AS fecha_resultado, UBIGEO AS ubigeo, ID_PERSONA AS id_persona,
         {parse('FECHA_RESULTADO')} AS dx_date
  FROM cases_raw
  WHERE UBIGEO IS NOT NULL AND FECHA_RESULTADO IS NOT NULL AND EDAD BETWEEN 0 AND 123
    AND PROVINCIA <> {SENT} AND DISTRITO <> {SENT})
WHERE dx_date >= DATE '2020-03-01'""")

cte("deaths_valid", ("deaths_raw",), f"""
SELECT * FROM (
  SELECT FECHA_CORTE AS fecha_corte, EDAD_DECLARADA AS edad_declarada, SEXO AS sexo,
         CLASIFICACION_DEF AS clasificacion_def, DEPARTAMENTO AS departamento, PROVINCIA AS provincia,
         DISTRITO AS distrito, UBIGEO AS ubigeo, UUID AS uuid,
         {parse('FECHA_FALLECIMIENTO')} AS death_date
  FROM deaths_raw
  WHERE UBIGEO IS NOT NULL AND FECHA_FALLECIMIENTO IS NOT NULL AND EDAD_DECLARADA BETWEEN 0 AND 123)
WHERE death_date >= DATE '2020-03-01'""")

cte("pop_keys", ("population",), "SELECT DISTINCT ubigeo FROM population")


def _weekly(kind: str, date: str, value: str) -> None:
    cte(f"{kind}_days", (f"{kind}_valid",), f"""
SELECT CAST(unnest(generate_series(min({date}), max({date}), INTERVAL 1 DAY)) AS DATE) AS {date}
FROM {kind}_valid""")
    cte(f"{kind}_grid", ("pop_keys", f"{kind}_days"), f"""
SELECT k.ubigeo, d.{date} FROM pop_keys k CROSS JOIN {kind}_days d""")
    cte(f"{kind}_daily_counts", (f"{kind}_valid",), f"""
SELECT ubigeo, {date}, count(*) AS {value} FROM {kind}_valid GROUP BY ubigeo, {date}""")
    cte(f"{kind}_daily", (f"{kind}_grid", f"{kind}_daily_counts"), f"""
SELECT g.ubigeo, g.{date}, coalesce(c.{value}, 0) AS {value}
FROM {kind}_grid g LEFT JOIN {kind}_daily_counts c ON g.ubigeo = c.ubigeo AND g.{date} = c.{date}""")
    cte(f"weekly_{kind}", (f"{kind}_daily",), f"""
SELECT ubigeo, {week(date)} AS week_start, CAST(sum({value}) AS BIGINT) AS {value}
FROM {kind}_daily GROUP BY 1, 2""")


_weekly("cases", "dx_date", "cases")
_weekly("deaths", "death_date", "deaths")

# ---- C4 -------------------------------------------------------------------------
cte("national_wide", ("weekly_cases", "weekly_deaths"), """
SELECT c.week_start, c.cases, d.deaths FROM
  (SELECT week_start, CAST(sum(cases) AS BIGINT) AS cases FROM weekly_cases GROUP BY 1) c
  JOIN (SELECT week_start, CAST(sum(deaths) AS BIGINT) AS deaths FROM weekly_deaths GROUP BY 1) d
  USING (week_start)""")


def epi(ws: str) -> str:
    w = f"({ws} + 3)"
    return (f"CAST(year({w}) AS INTEGER) AS epi_year, "
            f"CAST(floor((dayofyear({w}) - 1) / 7) + 1 AS INTEGER) AS epi_week, "
            f"printf('%d W%02d', year({w}), CAST(floor((dayofyear({w}) - 1) / 7) + 1 AS INTEGER)) AS year_week")


cte("national_long", ("national_wide",), f"""
SELECT week_start, name, value, {epi('week_start')} FROM (
  SELECT week_start, 'cases' AS name, cases AS value FROM national_wide
  UNION ALL SELECT week_start, 'deaths', deaths FROM national_wide)""")

# ---- C5 / C8 --------------------------------------------------------------------
cte("district_counts", ("weekly_cases", "weekly_deaths", "districts"), """
SELECT c.ubigeo, c.week_start, c.cases, d.deaths, x.department, x.province, x.district
FROM weekly_cases c JOIN weekly_deaths d ON c.ubigeo = d.ubigeo AND c.week_start = d.week_start
LEFT JOIN districts x ON c.ubigeo = x.ubigeo""")

cte("province_counts", ("district_counts",), """
SELECT department, province, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths
FROM district_counts GROUP BY department, province""")

cte("province_population", ("districts", "pop_2020"), """
SELECT department, province, sum(population) AS population
FROM districts JOIN pop_2020 USING (ubigeo) GROUP BY department, province""")


def rate(x: str, pop: str = "population") -> str:
    return f"CASE WHEN {pop} = 0 THEN NULL ELSE 100000.0 * {x} / {pop} END"


cte("province_rates", ("province_counts", "province_population"), f"""
SELECT c.department, c.province, {rate('c.cases', 'p.population')} AS cases,
       {rate('c.deaths', 'p.population')} AS deaths
FROM province_counts c LEFT JOIN province_population p
  ON c.department IS NOT DISTINCT FROM p.department AND c.province IS NOT DISTINCT FROM p.province""")

cte("department_population", ("districts", "pop_2020"), """
SELECT department, sum(population) AS population FROM districts JOIN pop_2020 USING (ubigeo) GROUP BY department""")

cte("department_rates", ("weekly_cases", "weekly_deaths", "districts", "department_population"), f"""
SELECT c.department, c.week_start, {rate('c.cases', 'p.population')} AS cases,
       {rate('d.deaths', 'p.population')} AS deaths
FROM (SELECT department, week_start, sum(cases) AS cases FROM weekly_cases LEFT JOIN districts USING (ubigeo)
      GROUP BY 1, 2) c
JOIN (SELECT department, week_start, sum(deaths) AS deaths FROM weekly_deaths LEFT JOIN districts USING (ubigeo)
      GROUP BY 1, 2) d ON c.department = d.department AND c.week_start = d.week_start
JOIN department_population p ON c.department = p.department""")


def with_(*names: str) -> str:
    """WITH clause holding the named CTEs and everything they depend on, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order) + "\n"


def q(body: str, *names: str) -> str:
    return with_(*names) + body

# ---- single-operator fragments ------------------------------------------------------
_LOWER = ", ".join(f"{c} AS {c.lower()}" for c in (
    "FECHA_CORTE", "DEPARTAMENTO", "PROVINCIA", "DISTRITO", "METODODX", "EDAD", "SEXO",
    "FECHA_RESULTADO", "UBIGEO", "ID_PERSONA"))
cte("cases_lower", ("cases_raw",), f"SELECT {_LOWER} FROM cases_raw")

cte("cases_daily_sparse", ("cases_valid",), """
SELECT ubigeo, dx_date, count(*) AS cases FROM cases_valid GROUP BY ubigeo, dx_date""")

cte("pop_sparse", ("population",), """
SELECT * FROM population WHERE (year + CAST(substring(ubigeo, 4, 3) AS INTEGER)) % 3 <> 0""")

cte("dm", ("district_map",), """
SELECT prov, CAST(regexp_extract(geometry, 'POLYGON \\(\\((\\d+) (\\d+),', 1) AS BIGINT) AS x,
             CAST(regexp_extract(geometry, 'POLYGON \\(\\((\\d+) (\\d+),', 2) AS BIGINT) AS y
FROM district_map""")

cte("boundaries", ("dm",), """
SELECT province, x1, y1, x2, y2 FROM (
  SELECT prov AS province, x1, y1, x2, y2, count(*) AS k FROM (
    SELECT prov, CAST(x AS DOUBLE) x1, CAST(y AS DOUBLE) y1, CAST(x + 1 AS DOUBLE) x2, CAST(y AS DOUBLE) y2 FROM dm
    UNION ALL SELECT prov, x + 1, y, x + 1, y + 1 FROM dm
    UNION ALL SELECT prov, x, y + 1, x + 1, y + 1 FROM dm
    UNION ALL SELECT prov, x, y, x, y + 1 FROM dm)
  GROUP BY ALL) WHERE k % 2 = 1""")

# bricks: districts three cells wide, every other row moved by one cell, so that rows share no inner vertices
cte("brick_cells", ("district_map",), """
SELECT dep AS g, 3 * x + y % 2 + k AS x, y FROM (
  SELECT dep, CAST(regexp_extract(geometry, 'POLYGON \\(\\((\\d+) (\\d+),', 1) AS BIGINT) AS x,
         CAST(regexp_extract(geometry, 'POLYGON \\(\\((\\d+) (\\d+),', 2) AS BIGINT) AS y FROM district_map), range(3) t(k)""")
cte("square_cells", ("dm",), "SELECT prov AS g, x, y FROM dm")


def polygons_sql(cells: str, tag: str) -> str:
    """Register CTE ``{tag}`` = (g, n_polygons, n_rings, n_points, area) of the union of unit cells.

    Polygons are components of cells that share sides.  Around each polygon the Euler number of its
    open inside gives the outlines and holes before splitting; each vertex where a polygon meets
    itself splits off one ring more.
    """
    cte(f"{tag}_c", (cells,), f"""
WITH RECURSIVE r AS (
  SELECT g, x, y, 1000000 * x + y AS m FROM {cells}
  UNION SELECT c.g, c.x, c.y, r.m FROM r JOIN {cells} c ON c.g = r.g AND abs(c.x - r.x) + abs(c.y - r.y) = 1)
SELECT g, x, y, min(m) AS m FROM r GROUP BY g, x, y""")
    cte(f"{tag}_v", (f"{tag}_c",), f"""
SELECT g, x + a AS vx, y + b AS vy, count(*) AS k, sum(a + 2 * b) AS s, min(m) = max(m) AS one
FROM {tag}_c, range(2) s(a), range(2) t(b) GROUP BY ALL""")
    cte(tag, (f"{tag}_c", f"{tag}_v"), f"""
SELECT g, n_polygons, 2 * n_polygons - (f - coalesce(e, 0) + v) + p AS n_rings, n_points, CAST(f AS DOUBLE) AS area
FROM (SELECT g, count(DISTINCT m) AS n_polygons, count(*) AS f FROM {tag}_c GROUP BY g)
LEFT JOIN (SELECT a.g, count(*) AS e FROM {tag}_c a JOIN {tag}_c b
           ON a.g = b.g AND ((b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1)) GROUP BY a.g) USING (g)
JOIN (SELECT g, count(*) FILTER (k = 4) AS v, count(*) FILTER (k = 2 AND s = 3 AND one) AS p,
             CAST(sum(CASE WHEN k IN (1, 3) THEN 1 WHEN k = 2 AND s = 3 THEN 2 ELSE 0 END) AS BIGINT) AS n_points
      FROM {tag}_v GROUP BY g) USING (g)""")
    return tag


polygons_sql("square_cells", "province_shapes")
polygons_sql("brick_cells", "department_shapes")

# ---- class breaks ---------------------------------------------------------------------
cte("rate_vals", ("department_rates",), """
SELECT 'cases' AS g, cases AS x FROM department_rates WHERE cases IS NOT NULL AND NOT isnan(cases)
UNION ALL SELECT 'deaths', deaths FROM department_rates WHERE deaths IS NOT NULL AND NOT isnan(deaths)""")
cte("prov_vals", ("province_rates",), """
SELECT 'cases' AS g, cases AS x FROM province_rates WHERE cases IS NOT NULL AND NOT isnan(cases)
UNION ALL SELECT 'deaths', deaths FROM province_rates WHERE deaths IS NOT NULL AND NOT isnan(deaths)""")
cte("order_vals", ("order_days",), "SELECT 'n_orders' AS g, n_orders AS x FROM order_days")


def breaks_sql(vals: str, method: str, k: int, tag: str) -> str:
    """Register CTE ``{tag}`` = (g, breaks) for ``method`` over CTE ``vals`` (g, x)."""
    fin = "list_sort(list_distinct(list_filter({a}, lambda v: v IS NOT NULL AND NOT isnan(v))))"
    if method == "quantile":
        probs = ", ".join(str(t / k) for t in range(k + 1))
        cte(tag, (vals,), f"SELECT g, {fin.format(a=f'quantile_cont(x, [{probs}])')} AS breaks FROM {vals} GROUP BY g")
    elif method == "geom":
        steps, tmp = [], "mn"
        for _ in range(1, k):
            tmp = f"({tmp} * r)"
            steps.append(tmp)
        arr = f"CASE WHEN mn > 0 THEN [mn, mx, {', '.join(steps)}] ELSE [mn, mx] END"
        cte(tag, (vals,), f"""SELECT g, {fin.format(a=arr)} AS breaks FROM (
  SELECT g, min(x) mn, max(x) mx, CASE WHEN min(x) > 0 THEN exp((ln(max(x)) - ln(min(x))) / {k}) END AS r
  FROM {vals} GROUP BY g)""")
    elif method == "arith":
        steps, tmp = [], "mn"
        for i in range(1, k):
            tmp = f"({tmp} + r * {i})"
            steps.append(tmp)
        cte(tag, (vals,), f"""SELECT g, {fin.format(a=f"[mn, mx, {', '.join(steps)}]")} AS breaks FROM (
  SELECT g, min(x) mn, max(x) mx, (max(x) - min(x)) / {k * (k + 1) / 2} AS r FROM {vals} GROUP BY g)""")
    elif method == "em":
        assert k == 4
        cte(tag, (vals,), f"""SELECT g, {fin.format(a="[mn, mx, m, m1, m2]")} AS breaks FROM (
  SELECT v.g, min(x) mn, max(x) mx, any_value(m) m, avg(x) FILTER (WHERE x <= m) m1, avg(x) FILTER (WHERE x > m) m2
  FROM {vals} v JOIN (SELECT g, avg(x) m FROM {vals} GROUP BY g) USING (g) GROUP BY v.g)""")
    elif method in ("fisher", "jenks", "kmeans"):
        fr = f"{tag}_r"
        cte(fr, (vals,), f"""
SELECT g, x, w, row_number() OVER (PARTITION BY g ORDER BY x) AS idx,
       sum(w) OVER wd AS c1, sum(w * xc) OVER wd AS c2, sum(w * pow(xc, 2)) OVER wd AS c3,
       count(*) OVER (PARTITION BY g) AS n
FROM (SELECT h.g, h.x, h.w, h.x - m.mu AS xc
      FROM (SELECT g, x, count(*) AS w FROM {vals} GROUP BY g, x) h
      JOIN (SELECT g, avg(x) AS mu FROM {vals} GROUP BY g) m USING (g))
WINDOW wd AS (PARTITION BY g ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
        cte(f"{tag}_1", (fr,), f"SELECT g, idx, c3 - pow(c2, 2) / c1 AS D, CAST([] AS BIGINT[]) AS path FROM {fr}")
        for m in range(2, k + 1):
            last = "AND b.idx = b.n" if m == k else ""
            cost = "(a.D + ((b.c3 - a.c3) - pow(b.c2 - a.c2, 2) / (b.c1 - a.c1)))"
            cte(f"{tag}_{m}", (fr, f"{tag}_{m - 1}"), f"""
SELECT g, idx, D, path FROM (
  SELECT b.g, b.idx, {cost} AS D, list_append(a.path, a.idx + 1) AS path,
         row_number() OVER (PARTITION BY b.g, b.idx ORDER BY {cost}, a.idx) AS rn
  FROM {fr} b JOIN (SELECT p.g, p.idx, p.D, p.path, r.c1, r.c2, r.c3
                    FROM {tag}_{m - 1} p JOIN {fr} r USING (g, idx)) a
    ON a.g = b.g AND a.idx < b.idx
  WHERE b.idx >= {m} {last}) WHERE rn = 1""")
        value = {"fisher": "r.x", "jenks": "p.x", "kmeans": "(p.x + r.x) / 2"}[method]
        cte(tag, (fr, f"{tag}_{k}"), f"""
SELECT g, list_sort(list_distinct(list(x))) AS breaks FROM (
  SELECT g, x FROM {fr} WHERE idx = 1 OR idx = n
  UNION ALL
  SELECT r.g, {value} FROM (SELECT f.g, unnest(f.path) AS i FROM {tag}_{k} f
                             JOIN (SELECT DISTINCT g, n FROM {fr}) USING (g) WHERE f.idx = n) s
  JOIN {fr} r ON r.g = s.g AND r.idx = s.i
  JOIN {fr} p ON p.g = s.g AND p.idx = s.i - 1) GROUP BY g""")
    else:
        raise KeyError(method)
    return tag


def cut_sql(x: str, b: str, k: int) -> str:
    """Right-closed class index 1..k of x against list b (lowest included)."""
    inner = " + ".join(f"CASE WHEN {i} <= len({b}) - 1 AND {x} > {b}[{i}] THEN 1 ELSE 0 END" for i in range(2, k + 1))
    return f"CASE WHEN {x} >= {b}[1] AND {x} <= {b}[len({b})] THEN 1 + {inner} END"


def _strip_sql(t: str) -> str:
    return f"CASE WHEN contains({t}, '.') THEN regexp_replace(regexp_replace({t}, '0+$', ''), '\\.$', '') ELSE {t} END"


def fmt_sql(x: str, d: str) -> str:
    """C %g with d significant digits, built from %.Nf."""
    e0 = f"floor(log10(abs({x})))"
    mant = f"round(abs({x}) / pow(10.0, {e0} - ({d} - 1)))"
    e = f"CAST({e0} + CASE WHEN {mant} >= pow(10.0, {d}) THEN 1 ELSE 0 END AS INTEGER)"
    fixed = _strip_sql(f"printf('%.' || CAST({d} - 1 - {e} AS VARCHAR) || 'f', {x})")
    sci_m = _strip_sql(f"printf('%.' || CAST({d} - 1 AS VARCHAR) || 'f', {x} / pow(10.0, {e}))")
    sci = f"{sci_m} || 'e' || CASE WHEN {e} < 0 THEN '-' ELSE '+' END || lpad(CAST(abs({e}) AS VARCHAR), 2, '0')"
    return f"CASE WHEN {x} = 0 THEN '0' WHEN {e} < -4 OR {e} >= {d} THEN {sci} ELSE {fixed} END"


def labels_sql(brk: str, tag: str, dig_lab: int = 5) -> str:
    """Register CTE ``{tag}`` = (g, labels) from CTE ``brk`` (g, breaks)."""
    cands = ", ".join(f"list_transform(breaks, lambda v: {fmt_sql('v', str(d))})" for d in range(dig_lab, 13))
    cte(f"{tag}_t", (brk,), f"""
SELECT g, coalesce(list_filter([{cands}], lambda t: len(list_distinct(t)) = len(t))[1],
                   list_transform(breaks, lambda v: {fmt_sql('v', '12')})) AS texts FROM {brk}""")
    cte(tag, (f"{tag}_t",), f"""
SELECT g, CASE WHEN len(texts) >= 2 THEN list_transform(generate_series(1, len(texts) - 1),
          lambda i: CASE WHEN i = 1 THEN '[' ELSE '(' END || texts[i] || ',' || texts[i + 1] || ']')
          ELSE CAST([] AS VARCHAR[]) END AS labels FROM {tag}_t""")
    return tag
