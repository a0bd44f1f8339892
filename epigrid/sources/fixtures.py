"""Domain tables derived from the driver's TPC-H-like tables.

The reference reads a case line list, a death line list, a population sheet, a
district crosswalk and a district map, none of which ship.  These functions
derive each one deterministically from the driver tables so that every query
grows with them.  The same mapping is written as SQL in ``plans/oracles.py``.

Mapping (see FIXTURES.md):
  * line lists  <- lineitem: district code = supplier key padded to 6 digits,
    dates = ship date shifted by ``DATE_SHIFT_DAYS`` into 2020-2026, written in
    several year-month-day layouts, with NULLs, sentinels and junk text injected
    on fixed line numbers;
  * population sheet, crosswalk, district map <- supplier (+ nation, region).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

# ---- fixed values that must equal the reference's --------------------------
SENTINEL = "EN INVESTIGACIÓN"      # "under investigation" province/district text
DATE_FLOOR = "2020-03-01"          # first date kept in both line lists
AGE_MIN, AGE_MAX = 0, 123          # inclusive age bounds
POPULATION_YEARS = (2018, 2019, 2020, 2021, 2022)
RATE_YEAR = 2020                   # population year used as denominator
FACET_NAMES = {"cases": "Positive cases", "deaths": "Deaths"}   # series labels
# ---------------------------------------------------------------------------

DATE_SHIFT_DAYS = 9131             # 1995-01-02 + 9131 days = 2020-01-03
CUTOFF_TEXT = "20240208"

CASE_COLUMNS = ("FECHA_CORTE", "DEPARTAMENTO", "PROVINCIA", "DISTRITO", "METODODX",
                "EDAD", "SEXO", "FECHA_RESULTADO", "UBIGEO", "ID_PERSONA")
DEATH_COLUMNS = ("FECHA_CORTE", "FECHA_FALLECIMIENTO", "EDAD_DECLARADA", "SEXO",
                 "CLASIFICACION_DEF", "DEPARTAMENTO", "PROVINCIA", "DISTRITO", "UBIGEO", "UUID")
SHEET_COLUMNS = tuple(f"c{i}" for i in range(1, 8))


_TABLES: dict[tuple[str, str], DataFrame] = {}


def _cached(cache: dict, k: tuple, spark: SparkSession, make) -> DataFrame:
    """Per-application cache; an entry made by another session is rebuilt."""
    df = cache.get(k)
    if df is None or df.sparkSession is not spark:
        df = cache[k] = make()
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read once per session and path)."""
    path = f"{sf_dir}/{name}.parquet"
    return _cached(_TABLES, (spark.sparkContext.applicationId, path), spark, lambda: spark.read.parquet(path))


_DOMAIN: dict[tuple[str, str, str], DataFrame] = {}


def ingest(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Derive a domain table once per session and store it as parquet.

    The reference reads its line lists, sheet, crosswalk and map from files;
    this gives our pipelines the same footing: real columns on disk (so
    filters and column pruning reach the scan), written in at least as many
    files as the cluster has cores.
    """
    def make() -> DataFrame:
        df = build(spark, sf_dir)
        want = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < want:
            df = df.repartition(want)
        return materialize(df, f"domain-{name}", keep=True)

    return _cached(_DOMAIN, (spark.sparkContext.applicationId, sf_dir, name), spark, make)


def code6(key: Column) -> Column:
    """District code of at least six digits: leading zeros, never cut."""
    text = key.cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), 6 - F.length(text))), text)


def _date_text(d: Column, ln: Column, ok: Column) -> Column:
    iso = d.cast("string")                       # yyyy-MM-dd
    return (F.when((ln == 6) & (ok % 2 == 0), F.lit(None).cast("string"))
            .when(ln == 5, iso)
            .when(ln == 4, F.translate(iso, "-", "/"))
            .when((ln == 3) & (ok % 10 == 0), F.lit("SIN DATO"))
            .otherwise((F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("string")))


def _age(q: Column, ln: Column, ok: Column) -> Column:
    return (F.when((ln == 2) & (ok % 4 == 0), F.lit(None).cast("int"))
            .otherwise(F.floor(q).cast("int") * 3 - 20))


def _common(li: DataFrame) -> DataFrame:
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.col("l_linenumber").alias("ln"), F.col("l_orderkey").alias("ok"),
        F.col("l_quantity").alias("q"), F.to_date("l_shipdate").alias("d0"))


def build_case_line_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case line list (10 columns, upper-case names, 6th an integer age)."""
    li = _common(table(spark, sf_dir, "lineitem"))
    ln, ok = F.col("ln"), F.col("ok")
    d = F.date_add("d0", DATE_SHIFT_DAYS)
    return li.select(
        F.lit(CUTOFF_TEXT).alias("FECHA_CORTE"),
        F.concat(F.lit("DEP_"), (F.col("l_suppkey") % 5).cast("string")).alias("DEPARTAMENTO"),
        F.when(F.col("l_returnflag") == "N", F.lit(SENTINEL))
         .when((ln == 1) & (ok % 9 == 0), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("PROV_"), F.col("l_returnflag"))).alias("PROVINCIA"),
        F.when((F.col("l_linestatus") == "O") & (ln == 2), F.lit(SENTINEL))
         .otherwise(F.concat(F.lit("DIST_"), F.col("l_linestatus"))).alias("DISTRITO"),
        F.when(ok % 3 == 0, "PCR").when(ok % 3 == 1, "PR").otherwise("AG").alias("METODODX"),
        _age(F.col("q"), ln, ok).alias("EDAD"),
        F.when(F.col("l_partkey") % 2 == 0, "MASCULINO").otherwise("FEMENINO").alias("SEXO"),
        _date_text(d, ln, ok).alias("FECHA_RESULTADO"),
        F.when(ln == 7, F.lit(None).cast("string")).otherwise(code6(F.col("l_suppkey"))).alias("UBIGEO"),
        F.col("l_orderkey").cast("string").alias("ID_PERSONA"),
    )


def build_death_line_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Death line list (10 columns, upper-case names, 3rd an integer age)."""
    li = _common(table(spark, sf_dir, "lineitem")).where(F.col("l_returnflag") == "R")
    ln, ok = F.col("ln"), F.col("ok")
    d = F.date_add("d0", (F.lit(DATE_SHIFT_DAYS) + ok % 29).cast("int"))
    return li.select(
        F.lit(CUTOFF_TEXT).alias("FECHA_CORTE"),
        _date_text(d, ln, ok).alias("FECHA_FALLECIMIENTO"),
        _age(F.col("q"), ln, ok).alias("EDAD_DECLARADA"),
        F.when(F.col("l_partkey") % 2 == 0, "MASCULINO").otherwise("FEMENINO").alias("SEXO"),
        F.when(ok % 2 == 0, "CRITERIO VIROLOGICO").otherwise("CRITERIO SINADEF").alias("CLASIFICACION_DEF"),
        F.concat(F.lit("DEP_"), (F.col("l_suppkey") % 5).cast("string")).alias("DEPARTAMENTO"),
        F.when((ln == 1) & (ok % 9 == 0), F.lit(None).cast("string"))
         .otherwise(F.lit("PROV_R")).alias("PROVINCIA"),
        F.when((F.col("l_linestatus") == "O") & (ln == 2), F.lit(SENTINEL))
         .otherwise(F.concat(F.lit("DIST_"), F.col("l_linestatus"))).alias("DISTRITO"),
        F.when(ln == 7, F.lit(None).cast("string")).otherwise(code6(F.col("l_suppkey"))).alias("UBIGEO"),
        F.concat(F.lit("U"), F.col("l_orderkey").cast("string")).alias("UUID"),
    )


def _population_cell(s: Column, base: Column, k: int) -> Column:
    value = (base + F.lit(37 * k)).cast("string")
    cell = F.when((s % 17 == 0) & F.lit(k == 1), F.lit("n.d."))
    cell = cell.when((s % 19 == 0) & F.lit(k == 3), F.concat(value, F.lit(",5")))
    cell = cell.when((s % 23 == 0) & F.lit(k == 4), F.lit(None).cast("string"))
    return cell.otherwise(value)


def build_population_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population sheet after its preamble: 7 text columns ``c1..c7`` by position.

    One row per supplier, plus repeated header rows and footnote rows, as a
    spreadsheet export has them.  Codes ending in ``00`` are province totals.
    """
    sup = table(spark, sf_dir, "supplier")
    s = F.col("s_suppkey")
    base = F.floor(F.abs(F.col("s_acctbal"))).cast("bigint")
    rows = sup.select(code6(s).alias("c1"), F.col("s_name").alias("c2"),
                      *[_population_cell(s, base, k).alias(f"c{k + 3}") for k in range(5)])
    headers = sup.where(s % 50 == 1).select(
        F.lit("UBIGEO").alias("c1"), F.lit("DISTRITO").alias("c2"),
        *[F.lit(f"POBLACION {y}").alias(f"c{k + 3}") for k, y in enumerate(POPULATION_YEARS)])
    notes = sup.where(s % 40 == 3).select(
        F.concat(F.lit("Nota "), s.cast("string")).alias("c1"), F.lit(None).cast("string").alias("c2"),
        *[F.lit(None).cast("string").alias(f"c{k + 3}") for k in range(5)])
    return rows.unionByName(headers).unionByName(notes)


def build_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District crosswalk: codes ending in 8 or 9 were split from the code ending in 1."""
    sup = table(spark, sf_dir, "supplier")
    s = F.col("s_suppkey")
    parent = code6(s - s % 10 + 1)
    return sup.where((s % 10 == 8) | (s % 10 == 9)).select(
        code6(s).alias("ubigeo_2022"), parent.alias("ubigeo_2017"),
        F.concat(code6(s), F.lit(" was split from "), parent).alias("notes"))


def build_district_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District map: attributes plus a unit-square polygon (WKT) per district.

    Districts whose key is 3 mod 25 are missing from the map.
    """
    sup = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 25 != 3)
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    x = (F.col("s_suppkey") % 10).cast("bigint")
    y = F.floor(F.col("s_suppkey") / 10).cast("bigint")
    pts = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]
    ring = F.concat_ws(", ", *[F.concat_ws(" ", a.cast("string"), b.cast("string")) for a, b in pts])
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
               .join(reg, nat.n_regionkey == reg.r_regionkey)
               .select(code6(F.col("s_suppkey")).alias("ubigeo"),
                       F.col("r_name").alias("dep"), F.col("n_name").alias("prov"),
                       F.col("s_name").alias("distr"),
                       F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("geometry")))


def brick_map(district_map: DataFrame) -> DataFrame:
    """The district map as a wall of bricks three cells wide; every other row is moved by one cell, so rows share no inner vertices."""
    corner = F.split(F.regexp_extract("geometry", r"\(\(([^,]+),", 1), " ")
    y = corner.getItem(1).cast("bigint")
    x = corner.getItem(0).cast("bigint") * 3 + y % 2
    pts = [(x, y), (x + 3, y), (x + 3, y + 1), (x, y + 1), (x, y)]
    ring = F.concat_ws(", ", *[F.concat_ws(" ", a.cast("string"), b.cast("string")) for a, b in pts])
    return district_map.withColumn("geometry", F.concat(F.lit("POLYGON (("), ring, F.lit("))")))


def daily_order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse values for class-break checks: orders counted per order date."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("day"))
             .agg(F.count(F.lit(1)).cast("double").alias("n_orders")))


def case_line_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, sf_dir, "cases", build_case_line_list)


def death_line_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, sf_dir, "deaths", build_death_line_list)


def population_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, sf_dir, "sheet", build_population_sheet)


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, sf_dir, "crosswalk", build_crosswalk)


def district_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, sf_dir, "district_map", build_district_map)


def ingest_all(spark: SparkSession, sf_dir: str) -> None:
    """Derive every domain table; the five independent jobs are submitted together."""
    from concurrent.futures import ThreadPoolExecutor

    fns = (case_line_list, death_line_list, population_sheet, crosswalk, district_map)
    with ThreadPoolExecutor(len(fns)) as pool:
        for f in [pool.submit(fn, spark, sf_dir) for fn in fns]:
            f.result()
