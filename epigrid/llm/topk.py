"""Exact top-k search by inner product, MaxScore over sharded dimensions.

Every dimension is a term and its column a posting list.  Within a shard each
query bounds a dimension's contribution from the column's least and greatest
value.  The dimensions are split by those bounds: a tail whose summed spread
cannot lift a vector to the current k-th score is non-essential.  The essential
columns are traversed for all vectors; the others are probed, a few at a time,
only for vectors that can still reach the k-th score.  Shards are merged by a
ranked window.  Pruning keeps every vector whose bound equals the k-th score, so
ties are whole and the result is exact.

Queries meet the shards in blocks: each (query block, shard) pair is one task of
bounded size, whatever the table's size.

Defined results: vectors that are null or hold null or non-finite components take
no part; an empty vector is valid and scores 0; missing components of a shorter
vector count as 0; rows with a null id take no part; repeated rows count once;
an empty table gives no rows; other columns are ignored.  Scores beyond 64 bits
saturate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces_for

BLOCK = 8192        # rows of a shard, and queries of a block
STEP = 8            # non-essential dimensions probed at a time
SEED = 256          # vectors scored in full to get a first k-th score


def _matrix(vecs, scale: int) -> np.ndarray:
    dim = max((len(v) for v in vecs), default=0)
    out = np.zeros((len(vecs), dim))
    for i, v in enumerate(vecs):
        out[i, : len(v)] = v
    return np.floor(scale * out)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best by (score descending, id ascending)."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def maxscore_shard(X: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int,
                   lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of ``X`` for one query, its own id left out.

    ``X`` holds one posting column per dimension; all values are whole numbers
    small enough that float sums are exact.
    """
    a, b = q * lo, q * hi
    least, spread = np.minimum(a, b), np.abs(a - b)
    order = np.argsort(-spread, kind="stable")
    tail = np.append(np.cumsum(spread[order][::-1])[::-1], 0.0)   # spread of dims from i on
    rest = np.append(np.cumsum((least + spread)[order][::-1])[::-1], 0.0)  # upper bound of dims from i on
    seed = np.flatnonzero(ids[:SEED] != own)
    theta = -np.inf
    if len(seed) >= k:
        theta = np.partition(X[seed] @ q, len(seed) - k)[len(seed) - k]
    need = theta - least.sum()
    essential = int(np.argmax(tail < need)) if np.isfinite(need) and (tail < need).any() else len(q)
    dims = order[:essential]
    alive = np.flatnonzero(ids != own)
    part = X[:, dims] @ q[dims] if essential < len(q) else X @ q
    part = part[alive]
    at = essential
    while True:
        keep = part + rest[at] >= theta
        alive, part = alive[keep], part[keep]
        if at >= len(q):
            break
        dims = order[at: at + STEP]
        part = part + X[np.ix_(alive, dims)] @ q[dims]
        at += len(dims)
        if len(part) > k:   # partial score plus the rest's least value is a score surely reached
            low = np.partition(part, len(part) - k)[len(part) - k] + least[order[at:]].sum()
            theta = max(theta, low)
    top = _best(part, ids[alive], k)
    return ids[alive[top]], part[top]


def _exact(X, ids, q, own, k):
    """The same for values whose sums a float cannot hold: Python whole numbers."""
    rows = [(sum(int(a) * int(b) for a, b in zip(x, q, strict=True)), int(i)) for x, i in zip(X, ids, strict=True) if i != own]
    rows.sort(key=lambda r: (-r[0], r[1]))
    top = rows[:k]
    return [i for _, i in top], [max(-2**63, min(2**63 - 1, s)) for s, _ in top]


def _pair(k: int, scale: int):
    def run(queries: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(cands):
            both = _matrix([*queries["vec"], *cands["vec"]], scale)
            Q, X = both[: len(queries)], both[len(queries):]
            qid, ids = queries["vec_id"].to_numpy(np.int64), cands["vec_id"].to_numpy(np.int64)
            # repeated rows count once; ids and vectors are compared by their bits (+ 0.0: no negative zero)
            _, first = np.unique(np.column_stack([ids, (np.ascontiguousarray(X) + 0.0).view(np.int64).reshape(len(ids), -1)]), axis=0, return_index=True) \
                if len(np.unique(ids)) < len(ids) else (None, np.arange(len(ids)))
            X, ids = np.asfortranarray(X[first]), ids[first]
            exact = np.abs(X).max(initial=0) * np.abs(Q).max(initial=0) * max(1, X.shape[1]) < 2.0**52
            lo, hi = (X.min(0), X.max(0)) if X.shape[1] else (np.zeros(0), np.zeros(0))
            seen = set()
            for q, own in zip(Q, qid, strict=True):
                if (key := (own, q.tobytes())) in seen:
                    continue
                seen.add(key)
                got = maxscore_shard(X, ids, q, own, k, lo, hi) if exact else _exact(X, ids, q, own, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": got[0], "score": np.array(got[1], np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    return run


def topk_search(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
                scale: int = 1024, query_every: int = 100, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query.

    Queries are the rows whose id is divisible by ``query_every``; every row is a
    candidate.  Components count as floor(scale * x).
    """
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(~bad))
    is_query = F.col("vec_id") % query_every == 0
    n, nq = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, blocks = pieces_for(n, block, 12), pieces_for(nq, block, 1)
    of = lambda parts, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    cands = rows.select("*", of(shards, 1).alias("shard")).select("*", every(blocks).alias("block"))
    queries = rows.filter(is_query).select("*", of(blocks, 2).alias("block")).select("*", every(shards).alias("shard"))
    found = (queries.groupBy("shard", "block").cogroup(cands.groupBy("shard", "block"))
             .applyInPandas(_pair(k, scale), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
