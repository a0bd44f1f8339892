"""Write the formatted physical plans of the headline queries to PLANS.md."""

from __future__ import annotations

import contextlib
import io as _io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from epigrid.functions.dates import week_floor  # noqa: E402
from epigrid.plans import pipelines as C  # noqa: E402
from epigrid.session import build_session  # noqa: E402
from epigrid.sources import fixtures as fx  # noqa: E402


def formatted(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"file:/\S+/epigrid-scratch/", "<scratch>/", buf.getvalue())
    return re.sub(r"#\d+L?", "", text)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    ev = C.valid_cases(fx.case_line_list(spark, sf)).select("ubigeo", "dx_date")
    cs, ds, pop = C.series_from(spark, sf)
    sections = [
        ("Event aggregation (stored once per series)",
         ev.groupBy("ubigeo", week_floor(F.col("dx_date")).alias("week_start")).agg(F.count(F.lit(1)).alias("cases"))),
        ("Dense weekly cases (C2) from the stored sparse counts", cs.dense()),
        ("Province rates (C5) from sparse counts", C.province_rates_sparse(
            cs, ds, C.districts_from(spark, sf), C.population_year(pop))),
    ]
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/show_plans.py` on `{os.path.basename(sf)}` (AQE shows the initial plan).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", formatted(df).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
