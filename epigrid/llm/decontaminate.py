"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

Two fixed masks pick six of eight consecutive words and ignore the others, so a
substituted word does not spoil every hash around it.  The masked hashes of all
benchmark items meet those of all documents in an equi-join; a hit fixes an alignment
of item and document, and each alignment is verified word by word.  An item is found
when some window of 13 of its words has at least 11 equal to the aligned words of the
document.  The two masks hit every such window (a test tries all pairs of
substitutions), so nothing is lost to the hashing.

Items of 8 to 12 words must be found whole; items shorter than the mask's span are no
evidence of leakage and take no part.

Scale: the benchmark's hash table is stored and counted; up to ``broadcast_rows`` rows
(24 bytes each) it is broadcast, beyond that both sides are shuffled by hash.  Hits are
reduced to distinct alignments before documents are read again.

Defined results: null or empty texts have no words and match nothing; rows with a null
id are never reported; repeated rows are reported once; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store
from .words import let, starts, word_hashes, words

MASKS = ((0, 1, 2, 3, 6, 7), (0, 1, 3, 5, 6, 7))
SPAN, WINDOW, NEEDED = 8, 13, 11


def _seeds(df: DataFrame, key: str, at: str) -> DataFrame:
    """(key, position, masked hash) of every seed; ``df`` has key and text."""
    def one(h: Column, k: int, mask: tuple[int, ...]) -> Column:
        return F.transform(starts(F.size(h), SPAN), lambda i: F.struct(
            i.alias("at"), F.xxhash64(F.lit(k), *[F.get(h, i + o) for o in mask]).alias("seed")))

    def masked(h: Column) -> Column:
        return F.concat(*[one(h, k, mask) for k, mask in enumerate(MASKS)])

    # the outer form: the inner one would add a filter that works the arrays out twice
    return df.select(key, F.inline_outer(let(word_hashes(F.col("text")), masked)).alias(at, "seed"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, n_equal, doc_word, item_word): each found item of each document.

    ``n_equal`` is the most equal words in any window; ``doc_word`` and ``item_word``
    say where the best alignment stands (its first word pair inside the document).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).filter("item_id IS NOT NULL")
    tests = store(_seeds(items, "item_id", "item_at").filter("seed IS NOT NULL"), "seeds")
    if tests.count() <= broadcast_rows:
        tests = F.broadcast(tests)
    hits = (_seeds(rows, "doc_id", "doc_at").join(tests, "seed")
            .select("doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct())
    hits = store(hits, "hits")
    item_words = items.select("item_id", words(F.col("text")).alias("item")).distinct()
    by_doc = hits.groupBy("doc_id").agg(F.collect_set(F.struct("item_id", "shift")).alias("at"))   # of one document
    # always by shuffle, so that the plan is the same at every size
    found = (rows.join(by_doc.hint("merge"), "doc_id").select("doc_id", words(F.col("text")).alias("doc"), F.explode("at").alias("at"))
             .select("doc_id", "doc", F.col("at.item_id").alias("item_id"), F.col("at.shift").alias("shift")))
    def best_window(same: Column) -> Column:
        return F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(F.size(same) - WINDOW, F.lit(0))),
                                       lambda s: F.aggregate(F.slice(same, s + 1, F.lit(WINDOW)), F.lit(0), lambda a, x: a + x)))

    equal = F.transform(F.sequence(F.lit(0), F.size("item") - 1),
                        lambda i: F.when(F.get(F.col("doc"), i + F.col("shift")) == F.get(F.col("item"), i), 1).otherwise(0))
    scored = found.join(item_words, "item_id").select(
        "doc_id", "item_id", "shift", F.size("item").alias("n"), let(equal, best_window).alias("n_equal"))
    kept = scored.filter(F.col("n_equal") >= F.when(F.col("n") >= WINDOW, F.lit(NEEDED)).otherwise(F.col("n")))
    best = F.max_by(F.col("shift"), F.struct(F.col("n_equal"), -F.col("shift")))
    return (kept.groupBy("doc_id", "item_id").agg(F.max("n_equal").alias("n_equal"), best.alias("shift"))
            .select("doc_id", "item_id", "n_equal", F.greatest("shift", F.lit(0)).alias("doc_word"),
                    F.greatest(-F.col("shift"), F.lit(0)).alias("item_word")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in whose text an item is found; each row is judged by its own id and text, null ids too."""
    text = F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)
    rows = docs.withColumn("_row", F.concat_ws(":", text, F.col("doc_id").cast("string")))
    leaks = find_leaks(rows, benchmark, id_col="_row").select(F.col("doc_id").alias("_row")).distinct()
    return rows.join(leaks, "_row", "left_anti").select(docs.columns)


#: the same rows from equal words alone, without hashes: every alignment with enough equal words in a window
SQL = rf"""
WITH cleaned AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[\x09-\x0D!-/:-@\[-`{{-~]', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
items AS (
  SELECT item_id, list_filter(string_split(regexp_replace(lower(text), '[\x09-\x0D!-/:-@\[-`{{-~]', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
dw AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM cleaned),
iw AS (SELECT item_id, len(w) AS n, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS j FROM items WHERE len(w) >= {SPAN}),
eq AS (SELECT doc_id, item_id, n, i - j AS shift, j, count(*) OVER (PARTITION BY doc_id, item_id, i - j) AS c
       FROM dw JOIN iw USING (w)),
win AS (SELECT doc_id, item_id, n, shift,
               count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j RANGE BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS k
        FROM eq WHERE c >= least(n, {NEEDED})),
al AS (SELECT doc_id, item_id, shift, max(k) AS n_equal FROM win
       GROUP BY doc_id, item_id, shift, n HAVING max(k) >= CASE WHEN n >= {WINDOW} THEN {NEEDED} ELSE n END)
SELECT doc_id, item_id, n_equal, CAST(greatest(shift, 0) AS INTEGER) AS doc_word, CAST(greatest(-shift, 0) AS INTEGER) AS item_word
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, shift) AS r FROM al) WHERE r = 1
"""
