"""op3: recall against exact containment over whole texts, with words put in, left out and changed."""

import random
import re

import duckdb

from epigrid.llm import licenses

SF = "/root/testdata/sf0.001"


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def shingles(text):
    w = re.findall(r"[^\s!-/:-@\[-`{-~]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(texts):
    known = {name: shingles(t) for name, t in licenses.TEMPLATES}
    return {(i, name) for i, t in enumerate(texts) for name, s in known.items() if len(s & shingles(t)) >= 0.8 * len(s)}


def damaged(rng, text, how, times):
    w = text.split()
    for _ in range(times):
        at = rng.randrange(len(w))
        if how == "put":
            w[at:at] = [f"new{rng.random()}"[:9].replace(".", "") for _ in range(rng.choice([1, 4, 10]))]
        elif how == "drop":
            w[at:at + 1] = [] if len(w) > 1 else w
        else:
            w[at] = "other"
    return " ".join(w)


def test_damaged_licenses_are_found(spark):
    rng = random.Random(8)
    filler = [f"word{i}" for i in range(500)]
    texts = []
    for _, text in licenses.TEMPLATES:
        for how in ("put", "drop", "change"):
            for times in (0, 1, 2, 5, 9):
                texts.append(" ".join([*rng.choices(filler, k=rng.randint(0, 300)), damaged(rng, text, how, times), *rng.choices(filler, k=rng.randint(0, 300))]))
    grant = dict(licenses.TEMPLATES)["MIT-grant"].split()
    for n in (4, 10):
        texts += [" ".join(["x"] * k + grant[:6] + ["in"] * n + grant[6:]) for k in range(14)]
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(docs_of(spark, texts)).collect()}
    want = brute(texts)
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 150, (len(got), len(want))


def test_sql_gives_the_same_rows(spark):
    rows = licenses.scan_licenses(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(map(tuple, rows)) == sorted(db.execute(licenses.sql()).fetchall()) and rows


def test_rows_of_one_id_and_other_columns(spark):
    grant = dict(licenses.TEMPLATES)["MIT-grant"]
    w = grant.split()
    rows = [(1, " ".join(w[:15]), 5), (1, " ".join(w[11:]), 6), (2, grant + " " + "x y z " * 30_000 + grant, 0), (2, grant, 0), (None, grant, 0), (3, "", 1), (4, None, 2)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, license int")).collect()
    assert sorted((r.doc_id, r.license, r.containment, r.first_word) for r in got) == [(1, "MIT-grant", 1.0, 0), (2, "MIT-grant", 1.0, 0)]
