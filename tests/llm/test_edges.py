"""Nulls, empty tables, repeated rows and clashing column names, for every operator and the pipeline."""

import pytest

import corpus_pipeline
from epigrid.llm import decontaminate, dedup, html, licenses, pieces, quality, setjoin, topk, toxicity, urls

ROWS = [(1, "a plain text of some words that stands here", "x", 1, 0.5), (1, "a plain text of some words that stands here", "x", 1, 0.5),
        (2, None, None, None, None), (None, "text without an id", "y", 2, 0.1), (3, "", "z", None, None), (None, None, None, None, None)]
COLS = "doc_id long, text string, score string, n_bytes int, component_id double"


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, COLS).selectExpr("*", "'k' AS dig", "1 AS chunk", "2 AS kind", "'w' AS words", "0 AS item_id")


def labels(spark, rows=((1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def bench(spark, rows=((1, "some item text"), (None, None))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPS = {
    "op1": lambda s, d: dedup.repeated_spans(d),
    "op2": lambda s, d: toxicity.toxicity_scores(d, labels(s)),
    "op6": lambda s, d: pieces.encode(d),
    "op9": lambda s, d: quality.quality_scores(d, labels(s)),
    "op10": lambda s, d: setjoin.jaccard_components(d),
}


@pytest.mark.parametrize("op", OPS)
def test_one_row_for_each_row(spark, op):
    got = OPS[op](spark, docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)
    assert OPS[op](spark, docs(spark, [])).count() == 0


def test_matchers(spark):
    for rows in (ROWS, []):
        assert licenses.scan_licenses(docs(spark, rows)).count() == 0
        assert decontaminate.find_leaks(docs(spark, rows), bench(spark)).count() == 0
        assert decontaminate.find_leaks(docs(spark, rows), bench(spark, [])).count() == 0


def test_pages_and_vectors(spark):
    rows = [(1, None, None, "h"), (1, None, None, "h"), (None, "http://a.org/x", "<p>t", "h")]
    for some in (rows, []):
        df = spark.createDataFrame(some, "page_id long, url string, html string, host string").selectExpr("*", "'n' AS noise", "1 AS salt", "'r' AS rule")
        assert html.extract_text(df).count() == urls.url_filter(df).count() == len(some)
    vec = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (None, [2.0]), (1, [2.0])], "vec_id long, embedding array<float>").selectExpr("*", "1 AS shard", "2 AS block", "3 AS vec")
    assert [tuple(r) for r in topk.topk_search(vec).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert topk.topk_search(vec.limit(0)).count() == 0


def test_pipeline_stages_keep_columns(spark, tmp_path):
    sf = str(tmp_path)
    labels(spark).write.parquet(f"{sf}/labels.parquet")
    bench(spark).write.parquet(f"{sf}/benchmark.parquet")
    for rows in (ROWS, []):
        d = spark.createDataFrame([(r[0], r[1], "en", r[2], r[3]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, d, sf)
            assert out.columns == d.columns and out.count() <= len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, d, sf).count() == len(rows)


def test_pipeline_decisions(spark, tmp_path):
    sf = str(tmp_path)
    item = " ".join(f"b{i}" for i in range(20))
    bench(spark, [(1, item)]).write.parquet(f"{sf}/benchmark.parquet")
    long = " ".join(f"q{i}" for i in range(40))
    near = long.replace("q7 ", "r7 ")
    rows = [(1, "start " + long), (2, "start " + long), (3, "start " + near), (4, "other words before " + long[:120] + " and after"), (5, "x " + item)]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stay = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, d, sf).collect()}
    assert stay == {r.doc_id for r in setjoin.jaccard_components(d).collect() if r.component_id == r.doc_id} and {2} & stay == set()
    cut = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeats_stage(spark, d, sf).collect()}
    assert 2 not in cut and cut[1] == (rows[0][1], len(rows[0][1])) and cut[4][0].startswith("other words before") and cut[4][1] < len(rows[3][1])
    assert {r.doc_id for r in corpus_pipeline.decontamination_stage(spark, d, sf).collect()} == {1, 2, 3, 4}
