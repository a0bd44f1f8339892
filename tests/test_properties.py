"""Properties from the test strategy: classes partition the values, Fisher is
optimal among the methods, dissolved boundaries are closed."""

import random

import numpy as np
from pyspark.sql import functions as F

from epigrid.operators import classify as B
from epigrid.operators.dissolve import dissolve_boundary


def _sse(xs, breaks):
    xs = np.array(sorted(xs))
    cls = np.searchsorted(np.array(breaks[1:-1]), xs, side="left")   # right-closed classes
    return sum(float(((xs[cls == c] - xs[cls == c].mean()) ** 2).sum()) for c in set(cls))


def test_classes_partition_values_and_fisher_is_optimal(spark):
    rnd = random.Random(11)
    xs = [round(rnd.lognormvariate(2, 0.8), 2) for _ in range(300)]
    vals = spark.createDataFrame([("x", x) for x in xs], "g string, x double")
    data = spark.createDataFrame([(x,) for x in xs], "x double")
    sse = {}
    for m in ("quantile", "geom", "arith", "em", "fisher", "jenks"):
        brk = B.class_breaks(vals, 4, m).first().breaks
        cls = data.select(B.cut_index(F.col("x"), F.array(*[F.lit(b) for b in brk]), 4).alias("c"))
        counts = cls.groupBy("c").count().collect()
        assert all(r.c is not None for r in counts)                 # every value has a class
        assert sum(r["count"] for r in counts) == len(xs)          # and exactly one
        if m in ("quantile", "arith", "em", "jenks"):
            sse[m] = _sse(xs, brk)
    # jenks breaks at class maxima put each optimal class in its own interval
    assert sse["jenks"] <= min(sse.values()) + 1e-6


def test_dissolved_boundary_is_closed(spark):
    rnd = random.Random(3)
    cells = {(x, y) for x in range(8) for y in range(8) if rnd.random() < 0.7}

    def poly(x, y):
        pts = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]
        return "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in pts) + "))"

    rows = [("A" if (x + y) % 3 else "B", poly(x, y)) for x, y in cells]
    edges = dissolve_boundary(spark.createDataFrame(rows, "prov string, geometry string"), "prov")
    ends = edges.select("prov", F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")),
                                                  F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p"))
    degree = ends.groupBy("prov", "p").count()
    assert degree.where(F.col("count") % 2 == 1).count() == 0     # every vertex has even degree
