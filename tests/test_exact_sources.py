"""Exact digits, radix quantiles, pruned partitions, quoted line breaks and workbooks."""

import csv
import io as pyio
import itertools
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from epigrid.functions.digits import bits_double, double_bits
from epigrid.functions.labels import format_g
from epigrid.operators import classify as B
from epigrid.operators import partition
from epigrid.session import scratch_path
from epigrid.sources import io
from epigrid.sources.workbook import range_rows, read_workbook, workbook_bytes, write_workbooks


# -- B9 ----------------------------------------------------------------------------------------

def test_digits_equal_c(spark):
    random.seed(1)
    xs = [random.uniform(-1, 1) * 10.0 ** random.randint(-12, 15) for _ in range(8000)]
    xs += [struct.unpack("<d", struct.pack("<q", random.getrandbits(63)))[0] for _ in range(300)]
    ties = [(2 * random.randint(0, 10**6) + 1) / 2.0 ** random.randint(1, 12) for _ in range(1500)]
    xs += ties + [0.125, 0.00012345, 0.5, 1.5, 2.5, 99999.5, 9.9995, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 0.0, 1e22, 123456789012.5]
    xs = [x for x in xs if x == x and abs(x) != float("inf")]
    rows = [(x, 1 + k % 12) for k, x in enumerate(xs)] + [(x, d) for x in ties[:200] for d in range(1, 13)]
    got = spark.createDataFrame(rows, "x double, d int").repartition(8).select("x", "d", format_g(F.col("x"), F.col("d")).alias("t")).collect()
    assert [(r.x, r.d, r.t, f"%.{r.d}g" % r.x) for r in got if r.t != f"%.{r.d}g" % r.x] == []


def test_bits_round_trip(spark):
    xs = [0.1, -0.1, 5e-324, -1.7976931348623157e308, 1.0, 3.0000000000000004]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", bits_double(double_bits(F.col("x"))).alias("y")).collect()
    assert all(r.x == r.y for r in got)


# -- B1 ----------------------------------------------------------------------------------------

def test_quantiles_by_radix_selection(spark):
    rng = np.random.default_rng(3)
    data = {"normal": rng.normal(0, 1e3, 1001), "ties": rng.integers(-3, 3, 500).astype(float), "wide": np.exp(rng.normal(0, 60, 777)) * rng.choice([-1, 1], 777),
            "one": np.array([7.5]), "close": 1 + np.arange(300) * 2.0**-52, "zeros": np.array([-0.0, 0.0, 0.0, -1e-300])}
    rows = [(g, float(x)) for g, xs in data.items() for x in xs] + [("normal", None), ("normal", float("nan"))]
    values = B.clean_values(spark.createDataFrame(rows, "g string, x double").repartition(7))
    for k in (1, 4, 7):
        got = {r.g: r.breaks for r in B.quantile_breaks(values, k).collect()}
        by_rank = {r.g: r.breaks for r in B.quantile_breaks(values, k, B.ranked_histogram(values)).collect()}
        for g, xs in data.items():
            assert got[g] == by_rank[g]
            # numpy rounds an interpolation between values of opposite sign another way
            assert np.allclose(got[g], sorted(set(np.quantile(xs, np.arange(k + 1) / k).tolist())), rtol=1e-12, atol=0)
    assert B.quantile_breaks(values.limit(0), 4).count() == 0


def test_radix_selection_shuffles_counts_only(spark):
    values = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("x"))
    plans = []
    store = B.store
    try:
        B.store = lambda df, name="classify": (plans.append(df._jdf.queryExecution().executedPlan().toString()), store(df, name))[1]
        B.quantile_breaks(values, 4).collect()
    finally:
        B.store = store
    for plan in plans:
        for line in plan.splitlines():
            assert "Exchange hashpartitioning" not in line or " x#" not in line


# -- B3 ----------------------------------------------------------------------------------------

def brute(xs, k):
    """Least cost over all cuts of the sorted distinct values."""
    v, w = np.unique(xs, return_counts=True)
    def cost(a, b):
        m = np.average(v[a:b], weights=w[a:b])
        return float((w[a:b] * (v[a:b] - m) ** 2).sum())
    return min((sum(cost(a, b) for a, b in itertools.pairwise((0, *c, len(v)))), c) for c in itertools.combinations(range(1, len(v)), k - 1))


@pytest.mark.parametrize(("blocks", "k"), [(4, 3), (6, 4), (8, 2)])
def test_partition_by_pruning(spark, blocks, k):
    rng = np.random.default_rng(blocks)
    data = {"skew": np.round(rng.exponential(100, 60)), "normal": rng.normal(0, 5, 40), "even": np.arange(30.0), "few": np.array([1.0, 2.0]),
            "groups": np.concatenate([rng.normal(m, 1, 12) for m in (0, 50, 90)])}
    values = spark.createDataFrame([(g, float(x)) for g, xs in data.items() for x in xs], "g string, x double")
    ranked = B.ranked_histogram(values)
    got = {r.g: tuple(i - 1 for i in r.path) for r in partition.optimal_starts(ranked, k, blocks).collect()}
    whole = {r.g: tuple(i - 1 for i in r.path) for r in partition.optimal_starts(ranked, k).collect()}
    assert got == whole                      # ties too
    assert set(got) == {g for g, xs in data.items() if len(set(xs)) >= k}
    for g, cuts in got.items():
        want, _ = brute(data[g], k)
        v, w = np.unique(data[g], return_counts=True)
        mine = sum(float((w[a:b] * (v[a:b] - np.average(v[a:b], weights=w[a:b])) ** 2).sum()) for a, b in itertools.pairwise((0, *cuts, len(v))))
        assert mine <= want * (1 + 1e-9)


# -- S5 ----------------------------------------------------------------------------------------

def write_text(spark, folder, name, text):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    stream = path.getFileSystem(conf).create(path, True)
    stream.write(bytearray(text.encode()))
    stream.close()


@pytest.mark.parametrize("split", [64, 200, 1 << 20])
def test_quoted_line_breaks_across_splits(spark, split):
    random.seed(split)
    folder, want = scratch_path(spark, "t-breaks"), []
    for name, end in (("a.txt", "\n"), ("b.txt", "\r\n"), ("c.txt", "\n")):
        rows = []
        for k in range(120):
            cell = random.choice(["plain", 'a "quoted" word', f"two{chr(10)}lines", f"{chr(10)}{chr(10)}many lines{chr(10)}" * 3, 'odd " mark', ""]) if name != "c.txt" else "x"
            rows.append((f"{k:04d}", cell, "é" * (k % 5)))
        out = pyio.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end).writerows(rows)
        write_text(spark, folder, name, f'title with one " mark{end}{end}' + out.getvalue())
        want += [tuple(c or None for c in r) for r in rows]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        assert spark.read.text(folder).rdd.getNumPartitions() > (3 if split < 1000 else 0)
        got = io.read_sheet(spark, folder, 2, ["a", "b", "c"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("header", [True, False])
def test_line_list_with_quoted_breaks(spark, header):
    random.seed(11)
    folder, want = scratch_path(spark, "t-list-breaks"), []
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n"), ("empty.csv", "\n")):
        rows = [(f"{k:04d}", random.choice(["plain", 'a "quoted"; word', f"two{chr(10)}lines", f"{chr(10)}{chr(10)}NA", "odd \" mark", "NA", ""]),
                 random.choice(["7", "-3", "x", "", "NA"]), random.choice(["2021-03-04", "no date", "NA"])) for k in range(0 if name == "empty.csv" else 150)]
        out = pyio.StringIO()
        csv.writer(out, delimiter=";", lineterminator=end).writerows([("id", "cell", "n", "day")] * header + rows)
        write_text(spark, folder, name, out.getvalue() + end * (name == "a.csv"))     # a blank line at the end
        want += [(a, None if b in ("NA", "") else b, int(c) if c in ("7", "-3") else None, d if d[0] == "2" else None) for a, b, c, d in rows]
    names = None if header else ["id", "cell", "n", "day"]
    with_splits = {"spark.sql.files.maxPartitionBytes": 200, "spark.sql.files.openCostInBytes": 1}
    for key, value in with_splits.items():
        spark.conf.set(key, value)
    try:
        df = io.read_delimited(spark, folder, "cciD", names, sep=";", header=header, quoted_breaks=True)
        got = df.withColumn("day", F.col("day").cast("string")).collect()
        some = io.read_delimited(spark, folder, "cciD", names, sep=";", header=header, columns=["n"], quoted_breaks=True)
        assert some.columns == ["n"] and some.count() == len(want)
    finally:
        for key in with_splits:
            spark.conf.unset(key)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_workbooks(spark):
    rows = [(f"{k:06d}", None if k % 4 == 0 else f"<d> & é {k % 7}", None if k % 5 else "NA", " spaced ") for k in range(1000)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    path = write_workbooks(df.repartition(3), scratch_path(spark, "t-xlsx"), ["title", "", "", "note", ""])
    want = sorted(((a, b, None, d) for a, b, _, d in rows), key=str)
    for size in (1 << 16, 37):      # one task a workbook, then many row ranges
        got = read_workbook(spark, path, ["a", "b", "c", "d"], skip=5, rows_per_task=size)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_workbook_cells():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = workbook_bytes([("x",)], sheet="One")
    out = pyio.BytesIO()
    import zipfile
    with zipfile.ZipFile(pyio.BytesIO(book)) as old, zipfile.ZipFile(out, "w") as new:
        for n in old.namelist():
            if "sheet1" not in n and "shared" not in n:
                new.writestr(n, old.read(n))
        new.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>")
        new.writestr("xl/worksheets/sheet1.xml", f"""<worksheet {ns}><sheetData>
          <row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2"><v>1.50</v></c><c r="AB2"><v>9</v></c></row>
          <row><c t="inlineStr"><is><t>in</t></is></c><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c></row>
          <row r="9"/><row r="10"><c r="B10" t="str"><f>A1</f><v>calc</v></c></row></sheetData></worksheet>""")
    content = out.getvalue()
    assert range_rows(content, 1, 1, 99, 3) == [["rich", None, "1.50"], ["in", "TRUE", None], [None, "calc", None]]
    assert range_rows(content, "One", 3, 10, 3) == [["in", "TRUE", None]]
    with pytest.raises(ValueError, match="no sheet"):
        range_rows(content, "Two", 1, 9, 3)
