"""Exact optimal partition of ranked values into k classes (Fisher 1958), by pruning with bounds.

The cost of a class is its sum of squares about its mean, read off running sums.  A cut
after rank p ends a class at p.  Instead of weighing every rank against every other, each
round works on at most about ``BLOCKS`` blocks of ranks per group:

* the best partition whose cuts lie on block ends is a real partition: an upper bound;
* a class from a cut inside block a to a cut inside block b holds all ranks of the blocks
  between, and leaving values out of a class never raises its cost.  The chain of these
  partial costs, forwards and backwards, bounds from below every partition with its t-th
  cut inside a block;
* blocks whose lower bound exceeds the upper bound cannot hold a cut of any optimal
  partition.  Only the others are cut finer in the next round.

When every block left is a single rank the upper bound is the optimum itself, ties included.
Groups with at most ``BLOCKS`` distinct values are solved at once.  Near the optimum the cost
rises with the square of the distance, so the ranks left grow like the root of all ranks, and
the number of rounds like the logarithm.  A round reads the running sums at the block ends
by one equi-join and hands each group's ends (never its values) to one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BLOCKS = 4096


class _Sums:
    """Running sums at the block ends 0 = e[0] < e[1] < ... < e[m]; ``ok[b]`` tells whether block b (1..m) may hold a cut."""

    def __init__(self, end: np.ndarray, ok: np.ndarray, c1: np.ndarray, c2: np.ndarray, c3: np.ndarray):
        self.end, self.ok = np.concatenate(([0], end)), np.concatenate(([False], ok))
        self.c1, self.c2, self.c3 = (np.concatenate(([0.0], c)) for c in (c1, c2, c3))
        self.m = len(end)

    def cost(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Cost of a class of the ranks after end a up to end b; 0 where there are none."""
        w = self.c1[b] - self.c1[a]
        s = self.c2[b] - self.c2[a]
        return np.where(w > 0, (self.c3[b] - self.c3[a]) - s * s / np.where(w > 0, w, 1), 0.0)


def _least(rows: np.ndarray, cols: np.ndarray, value) -> tuple[np.ndarray, np.ndarray]:
    """Per row the least ``value(row, cols)`` and the first column that reaches it, a slice of rows at a time."""
    best, at = np.empty(len(rows)), np.empty(len(rows), np.int64)
    step = max(1, (1 << 21) // max(1, len(cols)))
    for lo in range(0, len(rows), step):
        v = value(rows[lo: lo + step, None], cols[None, :])
        k = v.argmin(1)
        at[lo: lo + step] = cols[k]
        best[lo: lo + step] = v[np.arange(len(k)), k]
    return best, at


def _on_ends(s: _Sums, k: int) -> tuple[float, list[int]]:
    """The least cost of k classes with cuts on block ends, and the ends of the first k - 1 classes.

    Ties go to the smallest start of the last class, then of the class before it.
    """
    if s.m < k:                     # too few ends for k classes: no bound yet
        return float("inf"), []
    ends = np.arange(1, s.m + 1)
    cost, back = s.cost(np.zeros(s.m, np.int64), ends), []
    for t in range(2, k + 1):
        at = ends[t - 1:] if t < k else ends[-1:]                   # ends of the t-th class
        prev = np.concatenate(([np.inf], cost))                     # by end, 0 cannot end a class
        cols = ends[t - 2: -1]
        low, came = _least(at, cols, lambda j, i, prev=prev: np.where(i < j, prev[i] + s.cost(i, j), np.inf))
        cost = np.full(s.m, np.inf)
        cost[at - 1] = low
        step = np.zeros(s.m + 1, np.int64)
        step[at] = came
        back.append(step)
    path, j = [], s.m
    for step in reversed(back):
        j = int(step[j])
        path.append(j)
    return float(cost[s.m - 1]), path[::-1]


def _possible(s: _Sums, k: int, upper: float) -> np.ndarray:
    """Blocks that may hold a cut of a partition that costs at most ``upper``."""
    blocks = np.flatnonzero(s.ok)
    first = s.cost(np.zeros(len(blocks), np.int64), np.maximum(blocks - 1, 0))
    ahead = [first]                                                 # the t-th cut lies in the block, classes up to it
    after = [s.cost(blocks, np.full(len(blocks), s.m))]             # and from it, last cut first
    def between(i, j):
        return np.where(i <= j, s.cost(np.minimum(i, j), np.maximum(np.minimum(i, j), j - 1)), np.inf)

    for _ in range(k - 2):
        full = np.full(s.m + 1, np.inf)
        full[blocks] = ahead[-1]
        ahead.append(_least(blocks, blocks, lambda j, i, full=full: full[i] + between(i, j))[0])
        back = np.full(s.m + 1, np.inf)
        back[blocks] = after[-1]
        after.append(_least(blocks, blocks, lambda i, j, back=back: back[j] + between(i, j))[0])
    bound = np.min([a + b for a, b in zip(ahead, reversed(after), strict=True)], axis=0)
    if upper == float("inf"):
        return blocks
    slack = 1e-9 * abs(upper) + 1e-11 * abs(float(s.c3[-1]))        # rounding of the running sums
    return blocks[bound <= upper + slack]


def _round(pdf: pd.DataFrame, k: int, blocks: int) -> tuple[bool, list[int], list[int], list[bool]]:
    """(done, start ranks of classes 2..k, next ends, whether the block before each end may hold a cut)."""
    pdf = pdf.sort_values("idx")
    s = _Sums(*(pdf[c].to_numpy(t) for c, t in (("idx", np.int64), ("ok", bool), ("c1", float), ("c2", float), ("c3", float))))
    upper, cuts = _on_ends(s, k)
    width = np.diff(s.end)
    if (width[s.ok[1:]] <= 1).all():
        return True, [int(s.end[c]) + 1 for c in cuts], [], []
    keep = _possible(s, k, upper)
    if (width[keep - 1] <= 1).all():        # single ranks already weighed as ends
        return True, [int(s.end[c]) + 1 for c in cuts], [], []
    step = max(1, -(-int(width[keep - 1].sum()) // blocks))
    ends = {int(s.end[s.m]): False}
    for b in keep.tolist():
        lo, hi = int(s.end[b - 1]), int(s.end[b])
        if lo:
            ends.setdefault(lo, False)
        part = min(step, -(-(hi - lo) // 2))         # every block gets smaller, however many are left
        ends |= dict.fromkeys([*range(lo + part, hi, part), hi], True)
    order = sorted(ends)
    return False, [], order, [ends[e] for e in order]


def optimal_starts(ranked: DataFrame, k: int, blocks: int = BLOCKS) -> DataFrame:
    """(g, path): the start ranks of classes 2..k of the partition into k classes with the least cost.

    ``ranked`` has g, idx (1..n), n and the running sums c1 (weights), c2 and c3 (of centred
    values and their squares).  Groups with fewer than k values are left out.
    """
    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        done, path, ends, ok = _round(pdf, k, blocks)
        return pd.DataFrame({"g": [key[0]], "done": [done], "path": [path], "ends": [ends], "ok": [ok]})

    kind = ranked.schema["g"].dataType.simpleString()
    schema = f"g {kind}, done boolean, path array<long>, ends array<long>, ok array<boolean>"
    step = F.greatest(F.lit(1), F.ceil(F.col("n") / blocks))
    columns = ["g", "idx", F.col("c1").cast("double").alias("c1"), "c2", "c3"]
    at = ranked.where((F.col("n") >= k) & ((F.col("idx") % step == 0) | (F.col("idx") == F.col("n")))).select(*columns, F.lit(True).alias("ok"))
    found = None
    while True:
        solved = materialize(at.groupBy("g").applyInPandas(solve, schema), "partition")
        done = solved.where("done").select("g", "path")
        found = done if found is None else found.unionByName(done)
        rest = solved.where("NOT done")
        if rest.isEmpty():
            return found
        ends = rest.select("g", F.explode(F.arrays_zip("ends", "ok")).alias("e")).select("g", F.col("e.ends").alias("idx"), F.col("e.ok").alias("ok"))
        at = ranked.join(ends, ["g", "idx"]).select(*columns, "ok")
