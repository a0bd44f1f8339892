"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, dedup, html, licenses, periods, phrases, pieces, quality, resample, setjoin, topk, toxicity, urls
from .common import table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.topk_search(table(spark, sf_dir, "embeddings"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_components(table(spark, sf_dir, "documents")).drop("dig", "stays")


def op11_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = phrases.repeated_phrases(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's input: a tenth of the documents (by crc32 of the id; null as empty text) end in a periodic tail."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(periods.periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted_tail))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TOPK_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM e a JOIN e b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
r AS (SELECT doc_id AS x, doc_id AS m FROM n UNION SELECT l.y, r.m FROM r JOIN l ON l.x = r.x)
SELECT r.x AS doc_id, n.n AS n_shingles, min(m) AS component_id FROM r JOIN n ON n.doc_id = r.x GROUP BY 1, 2
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_array_dedup, op2_toxicity, op3_license_scan, op4_benchmark_decontamination, op5_html_extraction,
        op6_sentencepiece, op7_topk_search, op8_url_filter, op9_quality, op10_jaccard_join, op11_phrase_automata, op12_periodic_runs,
        op13_importance_resampling)
}
ORACLE_SQL = {
    "op3_license_scan": licenses.sql(),
    "op4_benchmark_decontamination": decontaminate.SQL,
    "op7_topk_search": TOPK_SQL,
    "op10_jaccard_join": JACCARD_SQL,
    "op11_phrase_automata": phrases.SQL,
    "op13_importance_resampling": resample.SQL,
}
