"""Resampling towards a target distribution by hashed n-gram importance weights, exact over the whole corpus.

1. Every task counts the hashed n-grams of its texts in one array of ``buckets`` numbers;
   the arrays of the corpus and of the target are summed by bucket.  The gain of a bucket
   is the log ratio of its smoothed shares, so the model is one array of fixed size.
2. A second scan scores each text by looking its buckets up in that array (the weight) and
   adds Gumbel noise from a hash of the id (the score): the highest scores are a sample
   without replacement in proportion to the weights.
3. Ranks come from parallel sorting by regular sampling.  Scored rows are packed into runs
   that are sorted where they lie and stored with their position.  Each of the p runs
   gives rows at regular positions; sorted samples of about sqrt(p) runs are merged and
   thinned, the rest is merged once more and gives p - 1 splitters.  Rows go to the segment
   between two splitters, which holds at most about twice its share because positions make
   all keys different.  Segments merge their sorted pieces, and the sum of the counts of
   all earlier segments turns places into ranks.  Segments beyond the last drawn rank are
   not sorted at all.

What reaches the driver: two arrays of ``buckets`` numbers, p - 1 splitters and p counts.
Every step starts from stored tables, so a lost executor repeats one step.

Defined results: null and empty texts have no features and weight 0; a null id is hashed as
the empty text and ranks behind all ids of its score; repeated rows take part one by one and
get ranks of their own; an empty corpus gives no rows; an empty target counts as a target
without features; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

BUCKETS, SEED, LEAST_WORDS, PERCENT = 10000, 2024, 20, 10
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"
RANKED = "doc_id long, n_features long, weight long, score long, rank long"
_POSITION = (1 << 33) - 1       # monotonically_increasing_id: partition above, row below


def features(text: bytes | None, buckets: int, longest: int) -> tuple[int, np.ndarray]:
    """(number of words, bucket of each n-gram of 1 to ``longest`` words); only A-Z are lower-cased."""
    words = _WORD.findall((text or b"").lower())
    grams = words if longest == 1 else itertools.chain(words, *(
        map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False)) for n in range(2, longest + 1)))
    return len(words), np.fromiter(map(zlib.crc32, grams), np.int64) % buckets


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, longest: int) -> np.ndarray:
    """How many n-grams of all texts fall in each bucket."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(features(text.as_py(), buckets, longest)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    per = texts.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in per.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down."""
    size = len(source)
    s_all, t_all = float(source.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def importance_scores(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    def score(batches):
        for batch in batches:
            rows = []
            for text in batch.column(2):
                words, at = features(text.as_py(), len(gain), longest)
                rows.append((words, len(at), int(gain[at].sum())))
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in batch.column(1).to_pylist()]
            weight = [r[2] for r in rows]
            columns = ([r[0] for r in rows], [r[1] for r in rows], weight, [w + n for w, n in zip(weight, noise, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), h.alias("h"), F.col(text_col).cast("binary").alias("text")).mapInArrow(score, SCORED)


def _keys(table: pa.Table | pa.RecordBatch) -> list[tuple]:
    """Sort keys, highest score first: ties to the smaller id, null ids last, then the place in the runs."""
    return [(-s, d is None, d or 0, at) for s, d, at in zip(*(table.column(c).to_pylist() for c in ("score", "doc_id", "at")), strict=True)]


def _merged(table: pa.Table) -> list[int]:
    """Row numbers in order; the rows of each run are laid end to end first, so that the sort merges sorted pieces."""
    keys = _keys(table)
    pieces = np.argsort(table.column("at").to_numpy(), kind="stable").tolist()
    return sorted(pieces, key=keys.__getitem__)


def splitters(runs: DataFrame, rows: int, n: int) -> list[tuple]:
    """n - 1 sort keys that cut all rows into segments of about equal size."""
    step, wide = max(1, rows // (n * n)), math.isqrt(n - 1) + 1
    picked = runs.filter((F.col("at").bitwiseAND(_POSITION) % step) == 0).select(
        "doc_id", "score", "at", F.floor(F.shiftright("at", 33) / wide).alias("part"))

    def thin(table: pa.Table) -> pa.Table:
        return table.take(_merged(table)[wide // 2::wide] if table.num_rows > wide else _merged(table))

    def cut(table: pa.Table) -> pa.Table:
        order = _merged(table)
        at = sorted({len(order) * k // n for k in range(1, n)})
        return table.take([order[k] for k in at])

    schema = "doc_id long, score long, at long, part long"
    some = picked.groupBy("part").applyInArrow(thin, schema).withColumn("part", F.lit(0).cast("long"))
    found = some.groupBy("part").applyInArrow(cut, schema).collect()
    return sorted((-r.score, r.doc_id is None, r.doc_id or 0, r.at) for r in found)


def ranked(scored: DataFrame, draw) -> DataFrame:
    """``scored`` with rank 1, 2, 3... of the first ``draw(number of eligible rows)`` of the eligible rows, else null."""
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id")]
    # scored rows are small: reading them again packs many scan tasks' rows into one run
    runs = store(store(scored, "scored").sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "runs")
    some = runs.filter("eligible")
    rows, n = some.agg(F.count("*"), F.count_distinct(F.shiftright("at", 33))).first()
    last = draw(rows)
    cuts = splitters(some, rows, n) if n > 1 else []
    marks = [np.array(c, np.int64) for c in zip(*cuts, strict=True)] or [np.zeros(0, np.int64)] * 4

    def deal(batches):
        for batch in batches:
            doc = batch.column(batch.schema.get_field_index("doc_id"))
            keys = (-batch.column(batch.schema.get_field_index("score")).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False),
                    doc.fill_null(0).to_numpy(), batch.column(batch.schema.get_field_index("at")).to_numpy())
            both = [np.concatenate((m, k)) for m, k in zip(marks, keys, strict=True)]
            by = np.lexsort(both[::-1])              # a splitter comes before the row it was taken from
            part = np.empty(len(by), np.int64)
            part[by] = np.cumsum(by < len(cuts))
            yield batch.append_column("part", pa.array(part[len(cuts):]))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in some.schema.fields)
    dealt = some.mapInArrow(deal, f"{fields}, part long")
    held = dict(dealt.groupBy("part").count().collect())
    before = dict(zip(range(n), itertools.accumulate((held.get(k, 0) for k in range(n)), initial=0), strict=False))
    full = max((k for k in before if before[k] < last), default=-1)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.take(_merged(table))
        first = before[key[0].as_py()] + 1
        rank = pa.array([r if r <= last else None for r in range(first, first + table.num_rows)], pa.int64())
        return table.select(["doc_id", "n_features", "weight", "score"]).append_column("rank", rank)

    plain = ["doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")]
    drawn = dealt.filter(F.col("part") <= full).groupBy("part").applyInArrow(merge, RANKED)
    return drawn.unionByName(dealt.filter(F.col("part") > full).select(*plain)).unionByName(runs.filter("NOT eligible").select(*plain))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
                        buckets: int = BUCKETS, longest: int = 1, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; rank is null for rows that are not drawn.

    ``percent`` of the rows with at least ``least_words`` words are drawn, rounded down.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))
    scored = importance_scores(docs, gain, id_col, text_col, longest, seed)
    scored = scored.select("doc_id", "n_features", "weight", "score", (F.col("n_words") >= least_words).alias("eligible"))
    return ranked(scored, lambda rows: percent * rows // 100)


SQL = r"""
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS tab
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS w FROM d),
bw AS (SELECT unnest(w) AS w FROM b),
v AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
h AS (
  SELECT w, xor(4294967295, list_reduce(
    list_transform(range(length(x) // 2), lambda i: CAST(16 * strpos('0123456789ABCDEF', substr(x, 2 * i + 1, 1)) + strpos('0123456789ABCDEF', substr(x, 2 * i + 2, 1)) - 17 AS BIGINT)),
    lambda c, y: xor(c >> 8, tab[1 + (xor(c, y) & 255)]), CAST(4294967295 AS BIGINT))) % 10000 AS k FROM v, crc),
s AS (SELECT k, count(*) AS s FROM dw JOIN h USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM bw JOIN h USING (w) GROUP BY k),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
g AS (
  SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
                                 / ((coalesce(s, 0) + 1.0::DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (k), n),
a AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN h USING (w) JOIN g USING (k) GROUP BY doc_id),
r AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    list_reduce(list_transform(range(8), lambda i: CAST(strpos('0123456789abcdef', substr(sha256('2024:' || doc_id), i + 1, 1)) - 1 AS BIGINT)), lambda x, y: 16 * x + y) AS h
  FROM d LEFT JOIN a USING (doc_id)),
c AS (
  SELECT doc_id, n_features, weight,
    weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) OVER (PARTITION BY n_features >= 20) AS rows FROM c)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * rows // 100 THEN place END AS rank FROM o
"""
