"""The reference's whole workflow as one Spark job: interim and processed
tables plus the three figure tables, written to a folder.

Shared intermediates (population, the sparse weekly series, the rates) are
built once and reused, as the reference's scripts hand CSV files to its
figure document.

    python -m epigrid.plans.workflow --sf-dir /root/testdata/sf0.01 --out <shared folder>
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from ..operators import classify as B
from ..session import build_session, materialize, scratch_path
from ..sources import fixtures as fx
from ..sources.io import write_table
from . import pipelines as C


def run_all(spark: SparkSession, sf_dir: str, out_dir: str | None = None, fmt: str = "csv") -> dict[str, str]:
    """Write every output table; returns name -> path."""
    out_dir = out_dir or scratch_path(spark, "workflow")
    paths: dict[str, str] = {}

    def emit(name: str, df, order: tuple[str, ...] = ()) -> None:
        # grouped results come out sorted by their keys in the reference (N12);
        # order is imposed only here, at the sink (a range-partitioned sort)
        if order:
            df = df.orderBy(*order)
        paths[name] = write_table(df, os.path.join(out_dir, name), fmt=fmt)

    pop = materialize(C.population_from(spark, sf_dir), "population")
    emit("interim/population_2018-2022", pop, ("ubigeo", "year"))
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(2) as pool:
        fc = pool.submit(C.case_series, fx.case_line_list(spark, sf_dir), pop)
        fd = pool.submit(C.death_series, fx.death_line_list(spark, sf_dir), pop)
        cs, ds = fc.result(), fd.result()
    emit("processed/cases", cs.dense(), ("ubigeo", "week_start"))
    emit("processed/deaths", ds.dense(), ("ubigeo", "week_start"))
    emit("figures/weekly_long", C.national_weekly_long_sparse(cs, ds), ("week_start", "name"))
    districts = C.districts_from(spark, sf_dir)
    pop_year = C.population_year(pop)
    prates = B.store(C.province_rates_sparse(cs, ds, districts, pop_year), "province-rates")
    bivariate = B.store(C.province_bivariate(prates), "province-bivariate")
    emit("figures/province_map", C.province_map(bivariate, fx.district_map(spark, sf_dir)))
    emit("figures/province_polygons", C.province_polygon_map(bivariate, fx.district_map(spark, sf_dir)), ("department", "province"))
    drates = C.department_weekly_rates_sparse(cs, ds, districts, pop_year)
    emit("figures/department_weekly_classes", C.department_weekly_classes(drates), ("department", "week_start"))
    return paths


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None, help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--master", default=None)
    args = ap.parse_args()
    spark = build_session(args.master)
    for name, path in run_all(spark, args.sf_dir, args.out, args.format).items():
        print(f"{name}\t{path}")
    spark.stop()


if __name__ == "__main__":
    main()
