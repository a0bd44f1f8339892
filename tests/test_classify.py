"""Class breaks against brute force / NumPy, cut rules and labels."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from epigrid.functions.labels import format_g, interval_labels
from epigrid.operators import classify as B


def _vals(spark, xs, g="x"):
    return spark.createDataFrame([(g, float(x)) for x in xs], "g string, x double")


def _brute(xs, k):
    """Minimum within-class SSE over contiguous partitions of the sorted distinct values."""
    xs = sorted(xs)
    vals = sorted(set(xs))
    best = None
    for cuts in itertools.combinations(range(1, len(vals)), k - 1):
        bounds = [0, *cuts, len(vals)]
        sse = 0.0
        for a, b in zip(bounds, bounds[1:]):
            group = [x for x in xs if vals[a] <= x <= vals[b - 1]]
            sse += float(np.sum((np.array(group) - np.mean(group)) ** 2))
        if best is None or sse < best[0] - 1e-9:
            best = (sse, cuts)
    starts = [vals[c] for c in best[1]]
    ends = [vals[c - 1] for c in best[1]]
    return starts, ends


@pytest.mark.parametrize("k,seed", [(3, 1), (4, 2), (4, 3)])
def test_fisher_and_jenks_match_brute_force(spark, k, seed, monkeypatch):
    monkeypatch.setattr(B.optimal_starts, "__defaults__", (4,))    # force several pruning rounds on small data
    rnd = random.Random(seed)
    xs = [round(rnd.expovariate(0.3), 1) for _ in range(40)]
    starts, ends = _brute(xs, k)
    fisher = B.fisher_breaks(_vals(spark, xs), k).first().breaks
    jenks = B.jenks_breaks(_vals(spark, xs), k).first().breaks
    kmeans = B.optimal_kmeans_breaks(_vals(spark, xs), k).first().breaks
    assert fisher == pytest.approx(sorted({min(xs), *starts, max(xs)}))
    assert jenks == pytest.approx(sorted({min(xs), *ends, max(xs)}))
    assert kmeans == pytest.approx(sorted({min(xs), *[(a + b) / 2 for a, b in zip(ends, starts)], max(xs)}))


def test_quantile_type7(spark):
    rnd = random.Random(5)
    xs = [rnd.random() * 100 for _ in range(101)] + [3.0] * 7
    got = B.quantile_breaks(_vals(spark, xs), 4).first().breaks
    assert got == pytest.approx(list(np.percentile(xs, [0, 25, 50, 75, 100])))


def test_nested_means_geom_arith(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 10.0, 20.0, 40.0]
    m = np.mean(xs)
    lo, hi = [x for x in xs if x <= m], [x for x in xs if x > m]
    assert B.nested_means_breaks(_vals(spark, xs), 4).first().breaks == pytest.approx(
        sorted([1.0, np.mean(lo), m, np.mean(hi), 40.0]))
    r = (40.0 / 1.0) ** (1 / 4)
    assert B.geom_breaks(_vals(spark, xs), 4).first().breaks == pytest.approx([1.0, r, r * r, r ** 3, 40.0])
    r = 39.0 / 10
    assert B.arith_breaks(_vals(spark, xs), 4).first().breaks == pytest.approx([1.0, 1 + r, 1 + 3 * r, 1 + 6 * r, 40.0])
    # geometric breaks are undefined with a zero minimum: only [min, max] remain
    assert B.geom_breaks(_vals(spark, [0.0, 1.0, 5.0]), 4).first().breaks == [0.0, 5.0]


def test_cut_index_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 1.0, 1.5, 2.0, 3.0, 3.5, -1.0, None]], "x double")
    brk = F.array(*[F.lit(v) for v in [0.0, 1.0, 2.0, 3.0]])
    got = [r.c for r in df.select(B.cut_index(F.col("x"), brk, 3).alias("c")).collect()]
    assert got == [1, 1, 2, 2, 3, None, None, None]


@pytest.mark.parametrize("x", [0.5, 123.456789, 1234567.0, 0.000123456, 99999.5, 12.0, 100000.0, 9.87654e-7, -42.4242])
def test_format_g_matches_c(spark, x):
    got = spark.range(1).select(format_g(F.lit(x), 5).alias("t")).first().t
    assert got == "%.5g" % x


def test_interval_labels(spark):
    df = spark.createDataFrame([([0.0, 9.319168197672871, 13.294336612603031, 35.706438145462535],)], "b array<double>")
    got = df.select(interval_labels(F.col("b")).alias("l")).first().l
    assert got == ["[0,9.3192]", "(9.3192,13.294]", "(13.294,35.706]"]
    # neighbours that print alike at 5 digits get more digits
    df = spark.createDataFrame([([1.00001, 1.00002, 2.0],)], "b array<double>")
    assert df.select(interval_labels(F.col("b")).alias("l")).first().l == ["[1.00001,1.00002]", "(1.00002,2]"]


def test_bivariate_null_guard(spark):
    df = spark.createDataFrame([(1, 3), (None, 2)], "a int, b int")
    assert [r.c for r in df.select(B.bi_class(F.col("a"), F.col("b")).alias("c")).collect()] == ["1-3", None]


def test_kmeans_breaks_separate_clusters(spark):
    rnd = random.Random(4)
    xs = [rnd.gauss(c, 0.5) for c in (0, 10, 20, 40) for _ in range(30)]
    brk = B.kmeans_breaks(_vals(spark, xs), 4, groups=["x"]).first().breaks
    assert len(brk) == 5 and brk == sorted(brk)
    assert brk[0] == min(xs) and brk[-1] == max(xs)
    # each inner break lies in the gap between two neighbouring clusters
    for b, (lo, hi) in zip(brk[1:-1], [(5, 5), (15, 15), (30, 30)]):
        assert abs(b - lo) < 4


def test_degenerate_columns(spark):
    from epigrid.plans.pipelines import classify

    const = spark.createDataFrame([(float(i % 1), 2.0 + (i % 2)) for i in range(12)], "a double, b double")
    out = classify(const, ["a", "b"], ["quantile", "fisher", "jenks", "em", "arith", "geom"], 4).collect()
    assert len(out) == 12
    # a constant column has one break and no interval: no class label, never an error
    assert all(r.a_quantile is None and r.a_fisher is None for r in out)
    # two distinct values and four classes: each value still gets a class
    assert {r.b_fisher for r in out} == {"[2,3]"} or len({r.b_fisher for r in out}) == 2
    few = B.fisher_breaks(_vals(spark, [1.0, 1.0, 5.0]), 4).first().breaks
    assert few == [1.0, 5.0]
