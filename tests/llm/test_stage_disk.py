"""What a stage of the pipeline still holds on disk while it joins whole rows."""

import corpus_pipeline


def test_repeats_are_stored_before_rows_are_joined(spark):
    line = "".join(chr(97 + k * k % 23) for k in range(60))
    rows = [(3, line + " first"), (5, "é" + line), (5, "é" + line), (7, line), (None, "lone " + line), (None, "lone " + line), (9, None)]
    docs = spark.createDataFrame([(*r, -1) for r in rows], "doc_id long, text string, n_chars int")
    out = corpus_pipeline.repeats_stage(spark, docs, "")
    assert "FlatMapCoGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.doc_id or 99, r.text or "", r.n_chars) for r in out.collect()))
    assert got == [(3, line + " first", -1), (5, "é", 1), (5, "é", 1), (9, "", -1), (99, "lone ", 5), (99, "lone ", 5)]
    assert out.schema.simpleString() == docs.schema.simpleString()


def test_stage_without_repeats_gives_its_rows_back(spark):
    docs = spark.createDataFrame([(1, "a text"), (None, None), (1, "a text")], "doc_id long, text string")
    assert sorted(map(str, corpus_pipeline.repeats_stage(spark, docs, "").collect())) == sorted(map(str, docs.collect()))
