"""Toxicity scores by non-negative positive-unlabelled learning.

A linear model over hashed word features (each distinct lower-case word and its first
five to seven letters, present or not) is trained in numpy from confirmed toxic texts
and unlabelled ones.  The risk is ``pi R_P+ + max(0, R_U- - pi R_P-)`` with the class
prior ``pi`` taken from the labelled training rows; when the bracket falls below zero
the step goes against it, so the model cannot explain the unlabelled texts away.  A
soft threshold keeps weights of uninformative features at zero, so long texts gather no
noise.  The unlabelled texts' labels are never read.

The training sample is bounded by ``positives`` and ``unlabelled`` rows, taken in order
of a hash of their id; scoring reads every whole text of the table.

Defined results: a null or empty text has no words and scores the model's intercept;
documents without label rows are scored alike; of several label rows for one id the
largest counts; without any confirmed toxic training row all scores are 0; repeated
rows stay repeated; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod
from .nets import GROUPS, WORD, sigmoid, word_features

POSITIVES, UNLABELLED, STEPS = 3_000, 9_000, 160


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    out: set[int] = set()
    for w in set(WORD.findall((text or "").lower())):
        out.update(word_features(w))
    return np.fromiter(sorted(out), np.int32, len(out))


class Rows:
    """Sparse 0/1 rows: products with a weight vector and sums back to it."""

    def __init__(self, rows: list[np.ndarray], width: int):
        lens = np.array([len(r) for r in rows], np.int64)
        self.idx = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
        self.row = np.repeat(np.arange(len(rows)), lens)
        self.n, self.width = len(rows), width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.idx], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.idx, weights=g[self.row], minlength=self.width)


def train_nnpu(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, steps: int = STEPS,
               rate: float = 0.15, shrink: float = 4e-4, beta: float = 0.0, gamma: float = 1.0) -> tuple[np.ndarray, float]:
    """(weights over GROUPS features, intercept) minimising the non-negative PU risk."""
    seen = np.bincount(np.concatenate([*pos, *unl]).astype(np.int64), minlength=GROUPS) if pos or unl else np.zeros(GROUPS)
    used = np.flatnonzero(seen >= 3)
    place = np.full(GROUPS, -1, np.int64)
    place[used] = np.arange(len(used))
    pick = lambda rows: Rows([p[p >= 0] for p in (place[r] for r in rows)], len(used))
    P, U = pick(pos), pick(unl)
    w, b = np.zeros(len(used)), -2.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for t in range(1, steps + 1):
        zp, zu = P.dot(w) + b, U.dot(w) + b
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gn_w = U.back(su) / U.n - prior * P.back(sp) / P.n
        gn_b = su.mean() - prior * sp.mean()
        if negative >= -beta:
            g, gb = gn_w + prior * P.back(sp - 1) / P.n, gn_b + prior * (sp - 1).mean()
        else:
            g, gb = -gamma * gn_w, -gamma * gn_b
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        mb += 0.1 * (gb - mb)
        vb += 0.01 * (gb * gb - vb)
        c, d = 1 - 0.9**t, 1 - 0.99**t
        pace = rate / (np.sqrt(v / d) + 1e-5)
        w -= pace * m / c
        w = np.sign(w) * np.maximum(0.0, np.abs(w) - np.minimum(pace, 1e3) * shrink * rate)
        b -= rate * (mb / c) / (np.sqrt(vb / d) + 1e-5)
    full = np.zeros(GROUPS)
    full[used] = w
    return full, float(b)


class Scorer:
    """Scores of whole texts; a word's weight is worked out once and kept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.memo = weights, bias, {}

    def __call__(self, text: str | None) -> float:
        memo, total, seen = self.memo, self.bias, set()
        if len(memo) > 400_000:
            memo.clear()
        for w in set(WORD.findall((text or "").lower())):
            got = memo.get(w)
            if got is None:
                got = memo[w] = tuple((i, float(self.weights[i])) for i in word_features(w) if self.weights[i])
            for i, x in got:
                if i not in seen:
                    seen.add(i)
                    total += x
        return float(sigmoid(total))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
                    positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; labels of fold 0 are never read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_mod("doc_id", folds) != 0))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n, n_toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    by_hash = F.xxhash64("doc_id")
    toxic_ids = known.filter("toxic = 1").orderBy(by_hash, "doc_id").limit(positives).select("doc_id")
    some_ids = (rows.filter(F.col("doc_id").isNotNull() & (crc_mod("doc_id", folds) != 0)).select("doc_id").distinct()
                .orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(unlabelled))
    wanted = toxic_ids.withColumn("kind", F.lit(1)).unionByName(some_ids.withColumn("kind", F.lit(0)))

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"kind": pdf["kind"], "f": [features(t).tobytes() for t in pdf["text"]]})

    got = rows.join(wanted, "doc_id").select("kind", "text").mapInPandas(featurise, "kind int, f binary").collect()
    pos = [np.frombuffer(r["f"], np.int32) for r in got if r["kind"] == 1]
    unl = [np.frombuffer(r["f"], np.int32) for r in got if r["kind"] == 0]
    if pos and unl:
        weights, bias = train_nnpu(pos, unl, min(0.9, max(1e-3, n_toxic / n)))
    else:
        weights, bias = np.zeros(GROUPS), -60.0
    model = rows.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))   # 2**18 numbers

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*model.value)
        for pdf in batches:
            s = np.array([scorer(t) for t in pdf["text"]])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    # ids travel as text: pandas would turn a column with nulls to floats, which cannot hold large ids
    return (rows.select(F.col("doc_id").cast("string").alias("doc_id"), (crc_mod("doc_id", folds) == 0).alias("held_out"), "text")
            .mapInPandas(score, "doc_id string, held_out boolean, score double, predicted int")
            .withColumn("doc_id", F.col("doc_id").cast("long")))
