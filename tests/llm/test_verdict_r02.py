"""Ids, repeated rows and clashing names that earlier rounds got wrong."""

import random

import numpy as np

import corpus_pipeline
from epigrid.llm import html, quality, setjoin, topk, toxicity

BIG = 2**53 + 1


def test_large_ids_beside_null_ids(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(BIG, "some text"), (None, "some text"), (2**53, "other")], "doc_id long, text string").coalesce(1)
    for got in (toxicity.toxicity_scores(docs, labels), quality.quality_scores(docs, labels)):
        assert {r.doc_id for r in got.collect()} == {BIG, 2**53, None} and got.schema["doc_id"].dataType.simpleString() == "bigint"
    pages = docs.selectExpr("doc_id AS page_id", "'http://a.org' AS url", "concat('<p>', text) AS html")
    assert {r.page_id for r in html.extract_text(pages).collect()} == {BIG, 2**53, None}


def test_candidates_with_close_ids_and_one_vector(spark):
    rows = [(0, [1.0]), (2**53, [2.0]), (BIG, [2.0]), (BIG, [2.0]), (BIG, [3.0])]
    got = topk.topk_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.score >> 20) for r in got if r.query_id == 0) == [(2**53, 2), (BIG, 2), (BIG, 3)]


def test_two_texts_of_one_id_join_their_groups(spark):
    random.seed(3)
    a, b, c = ([f"{k}{random.randint(0, 10**6)}" for _ in range(60)] for k in "abc")
    near = lambda w, k: " ".join([*w[:k], "other", *w[k + 1:]])
    rows = [(1, near(a, 2)), (2, near(b, 2)), (5, near(a, 57)), (5, near(b, 57)), (6, " ".join(c)), (None, near(c, 58)), (None, "lone words"), (7, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in setjoin.jaccard_components(docs).collect()}
    assert got == {(1, 56): 1, (2, 56): 1, (5, 56): 1, (6, 56): 6, (None, 56): 6, (None, 1): None, (7, 0): 7, (5, 0): 5}


def test_stage_keeps_one_row_of_each_group(spark):
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(None, words)] * 3 + [(4, words + " x"), (4, words + " x"), (9, "lone words"), (9, "lone words"), (8, ""), (8, "")]
    docs = spark.createDataFrame([(*r, 1, "a") for r in rows], "doc_id long, text string, n_chars long, source string")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(4, words + " x"), (8, ""), (8, ""), (9, "lone words")]


def test_stage_columns_that_clash(spark, tmp_path):
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(1, "a text", 0.5, 1, True, BIG), (None, "b text", None, None, None, None)],
                                 "doc_id long, text string, score double, predicted int, held_out boolean, n_chars long").coalesce(1)
    out = corpus_pipeline.quality_stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    assert all(r.n_chars in (BIG, None) for r in out.collect())


def test_long_texts_in_slices_equal_the_whole(spark):
    random.seed(4)
    text = " ".join(random.choice(["é" * random.randint(1, 30), "ab ab", "x", "日本" * 9, " ", "\n"]) for _ in range(20_000)) + "y" * 3000 + " ab ab"
    raw = text.encode()
    whole = quality.passages([text])[0]
    for most in (400, 1600, 50_000, 1 << 20):
        assert np.array_equal(np.concatenate(list(quality.sliced_passages(raw, most))), whole)
