"""Memory that tasks give back, and texts sent once."""

import inspect
import tracemalloc

import numpy as np
import pandas as pd
import zstandard

from epigrid.llm import chunks, common, dedup, quality


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_range_hash_works_in_place():
    n = 1 << 20
    buf = np.random.default_rng(0).integers(0, 256, n).astype(np.uint8)
    common.RangeHash(buf)       # the powers are there
    tracemalloc.start()
    h = common.RangeHash(buf)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2.5 * 8 * n
    assert h(np.array([0, 5]), np.array([5, 9]))[1] == common.RangeHash(buf[5:9])(np.array([0]), np.array([4]))[0]


def test_groups_give_memory_back():
    def two(key, pdf):
        return key, common.RangeHash(pdf)

    work = common.thrifty(two)
    assert len(inspect.getfullargspec(work).args) == 2 and work(1, np.zeros(1 << 18, np.uint8))[0] == 1
    assert not common._POWERS
    assert len(inspect.getfullargspec(common.thrifty(lambda a: a)).args) == 1

    def batches(given):
        for x in given:
            common.RangeHash(x)
            yield x

    assert len(list(common.thrifty_batches(batches)(iter([np.zeros(9, np.uint8)] * 3)))) == 3 and not common._POWERS


def test_kept_texts_are_sent_once(spark):
    docs = docs_of(spark, ["good text here", None, "x " * 500])
    labels = spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels, keep=("doc_id", "text"), prefix="_p")
    assert "_ptext_" not in got._jdf.queryExecution().toString()
    rows = {r.doc_id: r for r in got.collect()}
    plain = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert {i: r["_pscore"] for i, r in rows.items()} == plain and rows[1].text is None and rows[2].text == "x " * 500


def test_anchors_fall_evenly_into_buckets():
    texts = [np.random.default_rng(k).integers(97, 123, 4000).astype(np.uint8) for k in range(50)]
    lens = np.array([len(t) for t in texts])
    keys = np.unique(dedup.pieces(np.concatenate(texts), np.cumsum(lens) - lens, lens)[3])
    sizes = [e - s for _, s, e in chunks.bucket_slices(keys, 24)]
    assert len(sizes) == 24 and max(sizes) < 1.5 * len(keys) / 24      # the smallest hashes crowded the first


def test_windows_are_marked_text_by_text():
    rng = np.random.default_rng(1)
    for n in (50, 51, 400):
        starting = rng.random(n) < 0.01
        starting[n - 49:] = False
        want = [any(starting[max(0, i - 49): i + 1]) for i in range(n)]
        assert dedup._covered(starting, 50).tolist() == want
    assert not len(dedup._covered(np.zeros(0, bool), 50))


def test_answers_are_read_some_at_a_time(spark, monkeypatch):
    line = "".join(chr(97 + k * k % 23) for k in range(300))
    texts = [line[k: k + 120] + f" {k * 7919} " + line[-90 - k:] for k in range(40)]
    plain = sorted(map(tuple, dedup.repeated_spans(docs_of(spark, texts)).collect()))
    told = []
    real = dedup._told
    monkeypatch.setattr(dedup, "AT_ONCE", 2)
    heads = pd.DataFrame({"a": [np.arange(6, dtype=np.int64).tobytes()] * 5, "b": [zstandard.compress(np.arange(4, 9).tobytes())] * 5})
    for part in real(heads):
        told.append([x.tolist() for x in part])
    assert len(told) > 1 and sum(len(x[0]) for x in told) == 10 and told[0][3][:5] == [4, 5, 6, 7, 8]
    assert not list(real(heads[:0]))
    assert sorted(map(tuple, dedup.repeated_spans(docs_of(spark, texts)).collect())) == plain and any(r[2] for r in plain)
