"""A training-corpus pipeline over ``documents``: five stages, each written and read again.

Order: quality classifier, n-gram Jaccard join, suffix-array dedup, benchmark
decontamination, SentencePiece encoding.  Every stage works on all rows its predecessor kept,
and all but the last return the columns of ``documents``.

Defined results of every stage: null texts count as empty and stay (the quality classifier
judges them like any empty text); null ids stay null and are larger than all others; of
repeated rows the near-duplicate stage keeps one, the others treat each alike; ties go to the
smaller id; texts of any length are read whole; an empty table gives an empty table; further
columns of any name are handed on unchanged (names that begin with an underscore may not
repeat a stage's own helpers ``_dig``, ``_id``, ``_cut``, ``_often`` and ``_kept``).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epigrid.llm.common import store, table
from epigrid.llm.decontaminate import decontaminate
from epigrid.llm.dedup import repeated_spans
from epigrid.llm.pieces import encode
from epigrid.llm.quality import quality_scores
from epigrid.llm.setjoin import jaccard_components
from epigrid.session import remove_scratch, scratch_mark, scratch_since

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: scratch folders of the stage that ran last
_LEFT: list[str] = []


def frugal(work: Stage) -> Stage:
    """A stage that first removes what the stage before it stored on the way.

    A stage's result is written before the next stage runs, so nothing reads those folders any
    more; folders that the given documents still read stay.
    """
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        remove_scratch(spark, [p for p in _LEFT if not any(os.path.basename(p) in f for f in read)])
        mark = scratch_mark()
        out = work(spark, docs, sf_dir)
        _LEFT[:] = scratch_since(mark)
        return out

    return stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    mark = "_" + max(docs.columns, key=len)         # no column of the input starts like this
    scored = quality_scores(docs, table(spark, sf_dir, "labels"), keep=tuple(docs.columns), prefix=mark)
    return scored.filter(F.col(f"{mark}predicted") == 1).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once (null ids after all others)."""
    found = store(jaccard_components(docs), "components")
    gone = found.filter("NOT stays").select("doc_id", "dig").distinct().withColumn("often", F.lit(False))
    often = (found.filter("stays AND n_shingles > 0").groupBy("doc_id", "dig").agg(F.count("*").alias("n")).filter("n > 1")
             .select("doc_id", "dig", F.lit(True).alias("often")))
    marks = gone.unionByName(often).select(F.col("doc_id").alias("_id"), F.col("dig").alias("_cut"), F.col("often").alias("_often"))
    dig = F.unhex(F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256))
    rows = docs.withColumn("_dig", dig)
    same = rows["doc_id"].eqNullSafe(marks["_id"]) & (rows["_dig"] == marks["_cut"])
    if often.isEmpty():
        return rows.join(marks, same, "left_anti").select(docs.columns)
    marked = rows.join(marks, same, "left")
    once = marked.filter("_often").dropDuplicates(["doc_id", "_dig"])
    return marked.filter("_often IS NULL").select(docs.columns).unionByName(once.select(docs.columns))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes repeated from documents with smaller ids go; a text that loses everything goes with its row.

    What is left of the shortened texts is stored, so the operator's shuffle files are gone before whole rows are joined.
    """
    found = (repeated_spans(docs, with_text=True).filter("n_removed > 0")
             .select(F.col("doc_id").alias("_id"), F.col("dig").alias("_cut"), F.col("kept").alias("_kept")))
    cut = store(found, "cut").distinct()
    rows = docs.withColumn("_dig", F.unhex(F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)))
    same = rows["doc_id"].eqNullSafe(cut["_id"]) & (rows["_dig"] == cut["_cut"])
    joined = rows.join(cut, same, "left").filter("_kept IS NULL OR _kept <> ''")
    text = F.coalesce("_kept", "text")
    columns = {c: F.col(c) for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("_kept").isNotNull(), F.length("_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.select(*[v.alias(c) for c, v in columns.items()])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document."""
    return encode(docs)


STAGES = [
    ("quality", frugal(quality_stage)),
    ("near_duplicates", frugal(near_duplicate_stage)),
    ("repeats", frugal(repeats_stage)),
    ("decontamination", frugal(decontamination_stage)),
    ("encoding", frugal(encoding_stage)),
]

#: the stages train a model, solve a join and encode: no SQL; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs, name)
    return docs
