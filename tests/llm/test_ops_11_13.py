"""Phrase automata, periodic runs and importance resampling against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from epigrid.llm import periods, phrases, queries, resample

SF = "/root/testdata/sf0.001"
COLS = "doc_id long, text string, score string, n_words int, at double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table_of(spark, rows):
    """Documents with columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, "x", 1, 0.5) for i, t in rows], COLS).selectExpr(
        "*", "'k' AS dig", "1 AS chunk", "2 AS kind", "'w' AS kept", "3 AS part", "true AS eligible", "4 AS runs", "5 AS h")


def stored(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


ODD = [(1, "a plain text"), (1, "a plain text"), (2, None), (None, "text without an id"), (3, ""), (None, None), (4, " \t\n ")]


# -- op11 --------------------------------------------------------------------------------------

def phrases_left(rows, window=13):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    rank = {i: math.inf if i is None else i for i, _ in rows}
    for i, w in words:
        for k in range(len(w) - window + 1):
            g = tuple(w[k: k + window])
            first[g] = min(first.get(g, math.inf), rank[i])
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k: k + window])] < rank[i]:
                gone[k: k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("letters", "longest"), [(1 << 20, 64), (300, 64), (1 << 20, 3)])
def test_phrases(spark, monkeypatch, letters, longest):
    monkeypatch.setattr(phrases, "LONGEST", longest)
    random.seed(5)
    base = [f"w{i}é" for i in range(80)]
    rows = stored(spark) if letters > 300 else stored(spark)[:60]
    rows += [(5000, " ".join(base)), (5001, "\t".join(base)), (5002, "x " * 300), (5003, "x " * 40 + "  ".join(base[20:50]) + " y"), (5004, " ".join(base)),
             (None, " ".join(base[:30])), (None, " ".join(base[:30])), (5006, " ".join(base[:12])), (5007, " ".join(base[:12])), (5008, "\n".join(base[:13])),
             (5009, " ".join(base[:13])), (5009, " ".join(base[5:30]))] + ODD
    for i in range(40):     # few words: anchors, windows and passages repeat in many ways
        rows.append((6000 + i, " ".join(random.choices(["a", "b"], k=random.randint(0, 60)))))
    got = phrases.repeated_phrases(table_of(spark, rows), letters=letters).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode()) for r in got), key=str) == phrases_left(rows)


def test_phrases_in_very_long_texts(spark):
    random.seed(6)
    long = [str(random.randint(0, 400)) for _ in range(150_000)]
    rows = [(1, " ".join(long)), (2, " ".join(["z", *long[70_000: 70_100], "z"])), (3, " ".join(long[:100_000]))]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in phrases.repeated_phrases(table_of(spark, rows)).collect()}
    assert got == {1: (150_000, 0), 2: (102, 100), 3: (100_000, 100_000)}


# -- op12 --------------------------------------------------------------------------------------

def brute_runs(w, least=24, power=3):
    """All (start, length, period): every period is tried, and a stretch with a smaller period is left out."""
    found = {}
    for q in range(1, len(w) // power + 1):
        k = q
        while k < len(w):
            if w[k] != w[k - q]:
                k += 1
                continue
            a = k - q
            while k < len(w) and w[k] == w[k - q]:
                k += 1
            found.setdefault((a, k - a), q)        # smallest period first
    return sorted(((a, n, q) for (a, n), q in found.items() if n >= max(least, power * q)
                   and not any(all(w[i] == w[i - p] for i in range(a + p, a + n)) for p in range(1, q))), key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    random.seed(7)
    for _ in range(400):
        kind = random.random()
        if kind < 0.3:
            w = random.choices("ab", k=random.randint(0, 90))
        elif kind < 0.6:
            unit = random.choices("abcd", k=random.randint(1, 12))
            w = random.choices("abcd", k=random.randint(0, 20)) + unit * random.randint(1, 12) + random.choices("abcd", k=random.randint(0, 20))
        else:
            w = []
            while len(w) < 200:
                unit = random.choices("abc", k=random.randint(1, 6))
                inner = unit * random.randint(1, 9) + random.choices("abc", k=random.randint(0, 3))
                w += inner * random.randint(1, 4)
        assert periods.document_runs(w) == brute_runs(w)
        assert sorted(periods.word_runs(w, 6, 2), key=lambda r: (r[0], r[2])) == brute_runs(w, 6, 2)


def digest_row(doc, words):
    found = brute_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(found), *head, sha("".join(f"{a},{n},{q}\n" for a, n, q in found)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_query_of_periodic_runs(spark):
    want = []
    for doc, text in stored(spark):
        w, h = WORD.findall(text or ""), zlib.crc32(str(doc).encode())
        if len(w) > 1500:
            continue
        if h % 10 == 0 and w:
            a = (h // 10) % len(w)
            p = 1 + (len(w) - a) // (3 + (h // 10) % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        want.append(digest_row(doc, w))
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(stored(spark)) and len(want) > 150
    for row in want:
        assert got[row[0]] == row
    assert any(r[1] for r in want)


def test_strongest_run_of_equal_exponents(spark):
    rows = [(1, " ".join(["a"] * 24 + ["c"] + ["b"] * 24)), (2, " ".join("ab" * 30 + "c" + "x" * 30)), (3, " ".join(("ab" * 14 + "c") * 3))]
    got = {r.doc_id: tuple(r) for r in periods.digests(periods.periodic_runs(table_of(spark, rows))).collect()}
    assert got == {i: digest_row(i, t.split()) for i, t in rows}
    assert got[1][1:6] == (2, 0, 24, 1, 24000)


def test_runs_over_a_very_long_text(spark):
    unit = [f"u{i}" for i in range(9000)]
    row = periods.periodic_runs(table_of(spark, [(1, " ".join(["s", *unit * 5, "t"]))])).first()
    assert [tuple(r) for r in row.runs] == [(1, 45000, 9000)] and bytes(row.collapsed).decode().split() == ["s", *unit, "t"]


# -- op13 --------------------------------------------------------------------------------------

def brute_resample(docs, bench, percent=10, least=20):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    s, t = {}, {}
    for some, into in (([x for _, x in docs], s), (bench, t)):
        for text in some:
            for w in words(text):
                k = zlib.crc32(w) % 10000
                into[k] = into.get(k, 0) + 1
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda k: math.floor(1000 * math.log((t.get(k, 0) + 1) * (s_all + 10000) / ((s.get(k, 0) + 1) * (t_all + 10000))))
    rows = []
    for i, text in docs:
        w = words(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(zlib.crc32(x) % 10000) for x in w)
        rows.append((i, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = able[: percent * len(able) // 100]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in able[len(drawn):]] + [(*r, None) for r in rows if r[1] < least], key=str)


@pytest.mark.parametrize("pieces", [1, 7, 40])
def test_resampling(spark, pieces):
    rows = stored(spark)
    rows += [(7000 + k % 3, " ".join(f"T{k % 5} é{k}" for k in range(30))) for k in range(9)] + [(None, "Many words " * 15)] * 3 + ODD
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [r.text for r in bench.collect()] + [None]
    target = spark.createDataFrame([(t, 1) for t in texts], "text string, at int")
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 30)      # one stored file per run
    try:
        got = resample.importance_resample(table_of(spark, rows).repartition(pieces), target).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got), key=str) == brute_resample(rows, texts)


def test_ranks_of_many_ties(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("doc_id"), F.lit(1).cast("long").alias("n_features"), F.lit(2).cast("long").alias("weight"),
                                   (F.col("id") % 3).alias("score"), (F.col("id") % 10 != 0).alias("eligible")).repartition(16)
    rows = resample.ranked(df, lambda n: n // 2).collect()
    drawn = sorted((r for r in rows if r.rank), key=lambda r: r.rank)
    assert len(rows) == 20000 and [r.rank for r in drawn] == list(range(1, 9001))
    assert all((-a.score, a.doc_id) <= (-b.score, b.doc_id) for a, b in zip(drawn, drawn[1:], strict=False))


def test_segments_keep_their_bound(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), int(s)) for i, s in enumerate(rng.normal(0, 1000, 30000))]
    df = spark.createDataFrame(rows, "doc_id long, score long").repartition(12).sortWithinPartitions(F.desc("score"), "doc_id")
    df = resample.store(df.withColumn("at", F.monotonically_increasing_id()), "t")
    cuts = resample.splitters(df, 30000, 12)
    place = np.searchsorted([c[0] for c in cuts], [-s for _, s in rows])
    assert len(cuts) == 11 and np.bincount(place).max() <= 2 * 30000 // 12


def test_longer_features():
    n, at = resample.features("Ab c d".encode(), 1 << 30, 2)
    assert n == 3 and sorted(at.tolist()) == sorted(zlib.crc32(x) % (1 << 30) for x in (b"ab", b"c", b"d", b"ab c", b"c d"))


# -- all ---------------------------------------------------------------------------------------

OPS = {"op11": phrases.repeated_phrases, "op12": lambda d: periods.digests(periods.periodic_runs(d, rewrite=queries.planted_tail)),
       "op13": lambda d: resample.importance_resample(d, d)}


@pytest.mark.parametrize("op", OPS)
def test_one_row_for_each_row(spark, op):
    big = [(2**53 + 1, "one two"), (2**53, "one two"), (None, "x")]
    got = OPS[op](table_of(spark, ODD + big)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD + big)
    assert OPS[op](table_of(spark, [])).count() == 0
    assert OPS[op](table_of(spark, [(None, None)])).count() == 1


def test_every_key_has_an_oracle_or_a_brute_force_test():
    rows_only = {"op1_suffix_array_dedup", "op2_toxicity", "op5_html_extraction", "op6_sentencepiece", "op8_url_filter", "op9_quality",
                 "op12_periodic_runs"}
    assert set(queries.QUERIES) - set(queries.ORACLE_SQL) == rows_only and len(queries.QUERIES) == 13
