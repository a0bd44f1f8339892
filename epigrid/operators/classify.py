"""Class breaks and binning.

Input to every ``*_breaks`` function is a long DataFrame ``(g, x)``: a group id
(e.g. the measure name) and a value.  NULL and NaN values are ignored.  Output
is one row per group, ``(g, breaks array<double>)``, sorted, without
duplicates.  Breaks are computed with Spark aggregates over the whole column;
only the k+1 break values per group are ever gathered into one row.

Method definitions (the reference calls an R classification package; these are
the rules we implement):

* quantile - type-7 interpolated quantiles at i/k (exact, from ranks);
* geom     - ``min * r^i`` with ``r = exp((log max - log min)/k)``, built by
             repeated multiplication; when ``min <= 0`` the progression is
             undefined and only ``[min, max]`` remain;
* arith    - ``r = (max - min)/(1 + ... + k)``; breaks ``min + r``, then
             ``+ 2r``, ``+ 3r`` ... (class widths grow arithmetically);
* em       - nested means: split at the mean, then every part at its own
             mean, log2(k) times; the first part is closed, the others
             left-open;
* kmeans   - 1-D k-means solved exactly (the optimum of the k-means objective,
             the same partition as fisher); breaks are the midpoints between one
             cluster's max and the next cluster's min.  ``kmeans_ml`` runs Spark
             ML's iterative k-means (fixed seed) instead;
* fisher   - exact minimum within-class sum of squares (Fisher 1958), breaks
             at the class minima plus the overall max;
* jenks    - the same optimum, breaks at the class maxima plus the overall min.

``cut_index`` assigns right-closed classes with the lowest break included;
values outside the breaks (or NULL) get NULL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.digits import bits_double, double_bits
from ..session import materialize
from .partition import optimal_starts

RADIX = 16      # bits of a double that one counting pass of the quantiles settles


# ----------------------------------------------------------------- helpers
def clean_values(df: DataFrame, g: str = "g", x: str = "x") -> DataFrame:
    return (df.select(F.col(g).alias("g"), F.col(x).cast("double").alias("x"))
              .where(F.col("x").isNotNull() & ~F.isnan("x")))


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Stack the named columns into ``(g, x)``, g = column name."""
    return clean_values(df.unpivot([], list(cols), "g", "x"))


def _finish(df: DataFrame, arr: Column) -> DataFrame:
    """Sort and de-duplicate (duplicate breaks would make empty classes)."""
    return df.select("g", F.array_distinct(F.array_sort(F.filter(arr, lambda b: b.isNotNull() & ~F.isnan(b))))
                     .alias("breaks"))


def store(df: DataFrame, name: str = "classify") -> DataFrame:
    """Store an intermediate table in the checkpoint folder and continue from it."""
    return materialize(df, name)


# ----------------------------------------------------------------- ranks
def ranked_histogram(values: DataFrame) -> DataFrame:
    """Distinct values per group with 1-based rank and running sums.

    Columns: ``g, x, w`` (count), ``idx`` (rank among distinct values),
    ``c1`` (running count), ``c2``/``c3`` (running sum of ``w*xc`` and
    ``w*xc^2``, where ``xc`` is x minus the group mean, for stable variances),
    ``n`` (distinct values in the group), ``tot`` (total count).

    Running sums are computed without moving the whole column into one task:
    values are range-partitioned, each partition sums its own rows, and a
    window over the (few) partition totals gives each partition's offset.
    """
    hist = values.groupBy("g", "x").agg(F.count(F.lit(1)).alias("w"))
    means = values.groupBy("g").agg(F.avg("x").alias("mu"))
    hist = hist.join(means, "g").withColumn("xc", F.col("x") - F.col("mu"))
    # stored once with its partition id: both uses below see the same split, whatever is re-planned or recomputed
    parts = store(hist.repartitionByRange("g", "x").withColumn("pid", F.spark_partition_id()), "histogram")
    tot = parts.groupBy("g", "pid").agg(
        F.count(F.lit(1)).alias("pn"), F.sum("w").alias("pw"),
        F.sum(F.col("w") * F.col("xc")).alias("p2"), F.sum(F.col("w") * F.col("xc") ** 2).alias("p3"))
    wo = Window.partitionBy("g").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy("g")
    offs = tot.select("g", "pid",
                      F.coalesce(F.sum("pn").over(wo), F.lit(0)).alias("o_n"),
                      F.coalesce(F.sum("pw").over(wo), F.lit(0)).alias("o1"),
                      F.coalesce(F.sum("p2").over(wo), F.lit(0.0)).alias("o2"),
                      F.coalesce(F.sum("p3").over(wo), F.lit(0.0)).alias("o3"),
                      F.sum("pn").over(wg).alias("n"), F.sum("pw").over(wg).alias("tot"))
    wl = Window.partitionBy("g", "pid").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    local = parts.select("g", "pid", "x", "w",
                         F.row_number().over(Window.partitionBy("g", "pid").orderBy("x")).alias("r"),
                         F.sum("w").over(wl).alias("l1"),
                         F.sum(F.col("w") * F.col("xc")).over(wl).alias("l2"),
                         F.sum(F.col("w") * F.col("xc") ** 2).over(wl).alias("l3"))
    ranked = local.join(offs, ["g", "pid"]).select(
        "g", "x", "w", (F.col("o_n") + F.col("r")).alias("idx"),
        (F.col("o1") + F.col("l1")).alias("c1"), (F.col("o2") + F.col("l2")).alias("c2"),
        (F.col("o3") + F.col("l3")).alias("c3"), "n", "tot")
    return store(ranked)


# ----------------------------------------------------------------- simple methods
def order_statistics(values: DataFrame, wanted: Sequence[tuple[str, Column]]) -> DataFrame:
    """(g, slot, n, x): the values at 1-based ranks, by radix selection.

    ``wanted`` names slots and gives their rank as a column of ``n``, the number of values
    of the group.  Doubles sort like their 64 bits once negative ones are turned round, so
    four counting passes settle 16 bits each: values under the prefixes still in question are
    counted by their next 16 bits (at most 65,536 counts a prefix), and each slot goes on
    with the bucket that holds its rank.  Only counts are shuffled, never values.
    """
    bits = double_bits(F.col("x") + 0.0)
    top = F.lit(2**63 - 1)
    keyed = values.select("g", F.when(bits < 0, bits.bitwiseXOR(top)).otherwise(bits).alias("u"))
    state = None
    for left in range(64 - RADIX, -1, -RADIX):
        pre = F.shiftright("u", left)
        if state is None:
            count = store(keyed.groupBy("g", pre.alias("pre")).agg(F.count("*").alias("w")), "radix").withColumn("up", F.lit(0).cast("long"))
            total = count.groupBy("g").agg(F.sum("w").alias("n"))
            slots = F.array(*[F.struct(F.lit(name).alias("slot"), rank.cast("long").alias("r")) for name, rank in wanted])
            state = total.select("g", "n", F.explode(slots).alias("s")).select("g", "n", "s.slot", "s.r", F.lit(0).cast("long").alias("up"))
        else:
            asked = state.select("g", "up").distinct()      # stored: its size is known when the join is planned
            under = keyed.withColumn("up", F.shiftright("u", left + RADIX)).join(asked, ["g", "up"], "left_semi")
            count = under.groupBy("g", "up", pre.alias("pre")).agg(F.count("*").alias("w"))
        before = F.coalesce(F.sum("w").over(Window.partitionBy("g", "up").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = count.withColumn("before", before)
        met = state.join(placed, ["g", "up"]).where((F.col("before") < F.col("r")) & (F.col("r") <= F.col("before") + F.col("w")))
        state = store(met.select("g", "n", "slot", (F.col("r") - F.col("before")).alias("r"), F.col("pre").alias("up")), "radix")
    u = F.col("up")
    return state.select("g", "slot", "n", bits_double(F.when(u < 0, u.bitwiseXOR(top)).otherwise(u)).alias("x"))


def quantile_breaks(values: DataFrame, k: int, ranked: DataFrame | None = None) -> DataFrame:
    """B1: type-7 quantiles at 0, 1/k, ..., 1, exact.

    Read off the ranks where a caller has them anyway, else by radix selection.
    """
    place = lambda n, t: (F.col(n) - 1) * F.lit(t / k) + 1
    aggs = []
    if ranked is None:
        wanted = [(f"{name}{t}", cut(place("n", t))) for t in range(k + 1) for name, cut in (("lo", F.floor), ("hi", F.ceil))]
        r, total = order_statistics(values, wanted), "n"
        aggs += [F.max(F.when(F.col("slot") == name, F.col("x"))).alias(name) for name, _ in wanted]
    else:
        r, total = ranked, "tot"
        for t in range(k + 1):
            for name, pos in (("lo", F.floor(place("tot", t))), ("hi", F.ceil(place("tot", t)))):
                covers = (F.col("c1") - F.col("w") < pos) & (pos <= F.col("c1"))
                aggs.append(F.max(F.when(covers, F.col("x"))).alias(f"{name}{t}"))
    aggs += [F.first(place(total, t) - F.floor(place(total, t))).alias(f"f{t}") for t in range(k + 1)]
    a = r.groupBy("g").agg(*aggs)
    qs = [F.col(f"lo{t}") + F.col(f"f{t}") * (F.col(f"hi{t}") - F.col(f"lo{t}")) for t in range(k + 1)]
    return _finish(a, F.array(*qs))


def _min_max(values: DataFrame) -> DataFrame:
    return values.groupBy("g").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))


def geom_breaks(values: DataFrame, k: int) -> DataFrame:
    """Geometric progression between min and max (``[min, max]`` if min <= 0)."""
    mm = _min_max(values)
    mn, mx = F.col("mn"), F.col("mx")
    r = F.exp((F.ln(mx) - F.ln(mn)) / k)
    steps, tmp = [], mn
    for _ in range(1, k):
        tmp = tmp * r
        steps.append(tmp)
    inner = F.when(mn > 0, F.array(*steps)).otherwise(F.array().cast("array<double>"))
    return _finish(mm, F.concat(F.array(mn, mx), inner))


def arith_breaks(values: DataFrame, k: int) -> DataFrame:
    """Arithmetic progression of class widths."""
    mm = _min_max(values)
    mn, mx = F.col("mn"), F.col("mx")
    r = (mx - mn) / (k * (k + 1) / 2)
    steps, tmp = [], mn
    for i in range(1, k):
        tmp = tmp + r * i
        steps.append(tmp)
    return _finish(mm, F.concat(F.array(mn, mx), F.array(*steps)))


def _class_of(x: Column, breaks: Column) -> Column:
    """Right-closed class of x (lowest break included) against a breaks column."""
    inside = (x >= F.element_at(breaks, 1)) & (x <= F.element_at(breaks, -1))
    return F.when(inside, F.greatest(F.size(F.filter(breaks, lambda b: b < x)), F.lit(1)))


def nested_means_breaks(values: DataFrame, k: int) -> DataFrame:
    """Nested means; k must be a power of two."""
    if k < 1 or k & (k - 1):
        raise ValueError("nested means need a power-of-two number of classes")
    mm = _min_max(values)
    cur = mm.select("g", F.array("mn", "mx").alias("breaks"))
    for _ in range(int(math.log2(k))):
        cls = values.join(cur, "g").select("g", "x", "breaks", _class_of(F.col("x"), F.col("breaks")).alias("c"))
        means = cls.groupBy("g", "c").agg(F.avg("x").alias("m"))
        new = means.groupBy("g").agg(F.collect_list("m").alias("ms"))
        cur = _finish(cur.join(new, "g", "left"),
                      F.concat(F.col("breaks"), F.coalesce(F.col("ms"), F.array().cast("array<double>"))))
    return cur


def kmeans_breaks(values: DataFrame, k: int, seed: int = 1, groups: Sequence[str] | None = None) -> DataFrame:
    """B2: breaks from a 1-D k-means per group (Spark ML, fixed seed).

    One model is fitted per group; ``groups`` names them (the measures being
    classified).  When omitted, the distinct group ids are fetched first.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    if groups is None:
        groups = [r["g"] for r in values.select("g").distinct().collect()]
    vec = VectorAssembler(inputCols=["x"], outputCol="features")

    def cluster_ranges(gid: str) -> DataFrame:
        part = vec.transform(values.where(F.col("g") == gid))
        model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="c").fit(part)
        return model.transform(part).groupBy("g", "c").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))

    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max(1, len(groups))) as pool:      # one independent fit per group
        fitted = list(pool.map(cluster_ranges, groups))
    ranges = fitted[0]
    for rg in fitted[1:]:
        ranges = ranges.unionByName(rg)
    per = ranges.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("r"))
    mids = F.transform(F.sequence(F.lit(1), F.size("r") - 1),
                       lambda i: (F.element_at("r", i).getField("hi") + F.element_at("r", i + 1).getField("lo")) / 2)
    arr = F.concat(F.array(F.element_at("r", 1).getField("lo"), F.element_at("r", -1).getField("hi")),
                   F.when(F.size("r") > 1, mids).otherwise(F.array().cast("array<double>")))
    return _finish(per, arr)


# ----------------------------------------------------------------- Fisher / Jenks
def _optimal_starts(values: DataFrame, k: int, ranked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Ranked histogram and, per group, the start ranks of classes 2..k."""
    ranked = ranked if ranked is not None else ranked_histogram(values)
    # groups with fewer than k distinct values: every value is its own class
    few = (ranked.where(F.col("n") < k).groupBy("g").agg(F.array_sort(F.collect_list("idx")).alias("all"))
                 .select("g", F.slice("all", 2, k).alias("path")))
    return ranked, optimal_starts(ranked, k).unionByName(few)


def _breaks_at(ranked: DataFrame, starts: DataFrame, kind: str) -> DataFrame:
    """Turn class start ranks into break values.

    ``kind``: ``min`` (each class's first value), ``max`` (the previous class's
    last value) or ``mid`` (halfway between the two); the overall min and max
    are always breaks.
    """
    pos = starts.select("g", F.explode("path").alias("i"))
    ends = ranked.groupBy("g").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    at = ranked.select("g", F.col("idx").alias("i"), F.col("x").alias("xi"))
    before = ranked.select("g", (F.col("idx") + 1).alias("i"), F.col("x").alias("xp"))
    cut = pos.join(at, ["g", "i"]).join(before, ["g", "i"])
    value = {"min": F.col("xi"), "max": F.col("xp"), "mid": (F.col("xp") + F.col("xi")) / 2}[kind]
    vals = cut.groupBy("g").agg(F.collect_list(value).alias("v"))
    out = ends.join(vals, "g", "left")
    return _finish(out, F.concat(F.array("mn", "mx"), F.coalesce("v", F.array().cast("array<double>"))))


def fisher_breaks(values: DataFrame, k: int, ranked: DataFrame | None = None) -> DataFrame:
    """Exact Fisher optimum; breaks = class minima + overall max."""
    ranked, starts = _optimal_starts(values, k, ranked)
    return _breaks_at(ranked, starts, "min")


def jenks_breaks(values: DataFrame, k: int, ranked: DataFrame | None = None) -> DataFrame:
    """Exact natural breaks; breaks = overall min + class maxima."""
    ranked, starts = _optimal_starts(values, k, ranked)
    return _breaks_at(ranked, starts, "max")


def optimal_kmeans_breaks(values: DataFrame, k: int, ranked: DataFrame | None = None) -> DataFrame:
    """B2: 1-D k-means solved exactly; breaks halfway between neighbouring clusters.

    In one dimension the k-means objective (least within-cluster sum of
    squares) has the same optimum as Fisher's partition (Wang & Song 2011), so
    this is deterministic, unlike iterative k-means from random starts.
    """
    ranked, starts = _optimal_starts(values, k, ranked)
    return _breaks_at(ranked, starts, "mid")


METHODS = {
    "quantile": quantile_breaks, "kmeans": optimal_kmeans_breaks, "kmeans_ml": kmeans_breaks, "fisher": fisher_breaks,
    "geom": geom_breaks, "arith": arith_breaks, "em": nested_means_breaks, "jenks": jenks_breaks,
}


RANKED_METHODS = ("quantile", "fisher", "jenks", "kmeans")
OPTIMAL_KINDS = {"fisher": "min", "jenks": "max", "kmeans": "mid"}


def class_breaks(values: DataFrame, k: int, method: str, ranked: DataFrame | None = None) -> DataFrame:
    """Breaks of ``(g, x)`` by method name; see the module docstring."""
    if method in RANKED_METHODS and ranked is not None:
        return METHODS[method](values, k, ranked=ranked)
    return METHODS[method](values, k)


def many_breaks(values: DataFrame, k: int, methods, groups: Sequence[str] | None = None) -> DataFrame:
    """Breaks for several methods at once: ``(method, g, breaks)``, stored in one write.

    Methods that need ranks share one ranked histogram.
    """
    from concurrent.futures import ThreadPoolExecutor

    ranked = ranked_histogram(values) if any(m in OPTIMAL_KINDS for m in methods) else None

    shared = [m for m in methods if m in OPTIMAL_KINDS]
    starts = _optimal_starts(values, k, ranked)[1] if len(shared) > 1 else None

    def one(m: str) -> DataFrame:
        if starts is not None and m in OPTIMAL_KINDS:       # one optimal partition serves all three
            br = _breaks_at(ranked, starts, OPTIMAL_KINDS[m])
        elif m == "kmeans_ml":
            br = kmeans_breaks(values, k, groups=groups)
        else:
            br = class_breaks(values, k, m, ranked=ranked)
        return br.select(F.lit(m).alias("method"), "g", "breaks")

    # methods with their own Spark jobs are independent, so they are submitted concurrently
    with ThreadPoolExecutor(max(1, len(methods))) as pool:
        parts = list(pool.map(one, methods))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return store(out, "breaks")


# ----------------------------------------------------------------- cut
def cut_index(x: Column, breaks: Column, k: int) -> Column:
    """Right-closed class index 1..k, lowest break included; outside -> NULL.

    ``breaks`` may be a scalar subquery (no higher-order function is used, the
    comparison is unrolled over the at most k+1 breaks).
    """
    size = F.size(breaks)
    inside = (x >= F.get(breaks, 0)) & (x <= F.get(breaks, size - 1))
    above = [F.when((F.lit(i) <= size - 2) & (x > F.get(breaks, i)), 1).otherwise(0) for i in range(1, k)]
    cls = F.lit(1)
    for a in above:
        cls = cls + a
    return F.when(inside, cls)


def bi_class(x_cls: Column, y_cls: Column) -> Column:
    """Bivariate class ``x-y``; NULL when either side has no class."""
    return F.when(x_cls.isNotNull() & y_cls.isNotNull(),
                  F.concat_ws("-", x_cls.cast("string"), y_cls.cast("string")))
