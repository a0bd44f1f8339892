"""Periodic runs of words inside documents: suffix automaton with link-cut access.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``least`` words and ``power`` periods long, that no neighbouring word extends.

Words are appended to a suffix automaton one by one.  Its link tree is kept as a link-cut
tree whose preferred paths are the stretches of equal last occurrence: when word i is
appended, the path from the root to the new state is recoloured with i, and each old segment
(last end p, greatest length L) that the access passes tells that the last L words also ended
at p.  With d = i - p <= L these two copies are a square of period d that reaches L + d words
back from i.  No longer copy ends at p, so the stretch cannot grow to the left, and no later
copy exists, so d is its smallest period.  A stretch that the next word does not carry on is
a whole run.

A run is covered by word windows of length ``least - least // power`` that stand twice in the
document: each window within its first or last (length - q) words has a copy q words away.
Words outside such windows are in no run and cannot extend one, so the automaton only reads
the maximal stretches inside (found by window hashes, which can only let too much in).

Documents are independent: one narrow pass over the table, nothing shuffled.  The automaton
takes about 0.6 KB for each word of the stretch that it reads.

Defined results: null and empty texts have no words, no runs and an empty collapsed text;
repeated rows give repeated results; null ids stay null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, mix64, runs

LEAST, POWER = 24, 3
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    ("collapsed", pa.binary())])


class LinkTree:
    """The automaton's link tree; each path of equal last end is one splay tree, deeper states to the right.

    State 0 stands for none.  Only the root of a splay tree holds its path's last end.
    """

    def __init__(self):
        self.left, self.right, self.up, self.last = array("i", [0]), array("i", [0]), array("i", [0]), array("i", [-1])

    def add(self, parent: int) -> None:
        self.left.append(0)
        self.right.append(0)
        self.up.append(parent)
        self.last.append(-1)

    def splay(self, x: int) -> None:
        left, right, up, last = self.left, self.right, self.up, self.last
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            # turn p first when x and p lean the same way, else x twice
            for y in ((p, x) if inner and (left[g] == p) == (left[p] == x) else (x, x) if inner else (x,)):
                q = up[y]
                o = up[q]
                if o and left[o] == q:
                    left[o] = y
                elif o and right[o] == q:
                    right[o] = y
                else:
                    last[y] = last[q]
                if left[q] == y:
                    b = left[q] = right[y]
                    right[y] = q
                else:
                    b = right[q] = left[y]
                    left[y] = q
                if b:
                    up[b] = q
                up[q] = y
                up[y] = o

    def insert_above(self, x: int, new: int) -> None:
        """``new`` becomes the parent of x, with the last end of x."""
        self.splay(x)
        low = self.left[x]
        self.left[new] = low
        if low:
            self.up[low] = new
        self.left[x] = new
        self.up[new] = x

    def access(self, new: int, end: int) -> Iterator[tuple[int, int]]:
        """Recolour the path from the root to the new leaf; gives (deepest state, last end) of each old segment."""
        right, up, last = self.right, self.up, self.last
        below, x = new, up[new]
        while x:
            self.splay(x)
            yield x, last[x]
            cut = right[x]
            if cut:
                last[cut] = last[x]
            right[x] = below
            below, x = x, up[x]
        self.splay(new)
        last[new] = end


def word_runs(words: list, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in the order of their ends."""
    found, n = [], len(words)
    tree = LinkTree()
    size, link, step = array("i", [0, 0]), array("i", [0, 0]), [{}, {}]     # state 1 is the root
    tree.add(0)
    state = 1
    for i, w in enumerate(words):
        cur = len(size)
        size.append(i + 1)
        link.append(1)
        step.append({})
        p = state
        while p and w not in step[p]:
            step[p][w] = cur
            p = link[p]
        tree.add(1)
        if p:
            q = step[p][w]
            if size[p] + 1 != size[q]:
                twin = cur + 1
                size.append(size[p] + 1)
                link.append(link[q])
                step.append(step[q].copy())
                tree.add(0)
                tree.insert_above(q, twin)
                while p and step[p].get(w) == q:
                    step[p][w] = twin
                    p = link[p]
                link[q] = q = twin
            link[cur] = tree.up[cur] = q
        state = cur
        for x, p in tree.access(cur, i):
            d, long = i - p, size[x]
            if long >= (power - 1) * d and long + d >= least and (i + 1 == n or words[i + 1] != words[i + 1 - d]):
                found.append((i + 1 - long - d, long + d, d))
    return found


def repeated_stretches(words: list, span: int) -> list[tuple[int, int]]:
    """(first, end) of the maximal stretches of words that lie in windows of ``span`` words that stand twice."""
    n = len(words) - span + 1
    if n < 2:
        return []
    one = mix64(np.fromiter(map(hash, words), np.int64, len(words)).view(U64))
    with np.errstate(over="ignore"):
        h = np.zeros(n, U64)
        for k in range(span):
            h = h * U64(0x9E3779B97F4A7C15) + one[k: k + n]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + span, -1)
    inside = np.cumsum(cover[:-1]) > 0
    starts, lens = runs(inside)
    return [(int(s), int(s + k)) for s, k in zip(starts, lens, strict=True) if inside[s]]


def document_runs(words: list, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of a document's runs, by start and period."""
    out = []
    for a, b in repeated_stretches(words, least - least // power):
        out += [(a + s, k, q) for s, k, q in word_runs(words[a:b], least, power)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run holds beyond its first period."""
    gone = np.zeros(len(words), bool)
    for start, length, period in found:
        gone[start + period: start + length] = True
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, power: int = POWER,
                  rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` are (start, length, period) by start and period; ``collapsed`` is the text that is
    left when each run is cut to its first period, words joined by one space, as bytes.
    ``rewrite(id, words)`` may change a document's words before the search.
    """
    def work(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [[], [], [], []]
                for doc, text in zip(part.column(0), part.column(1), strict=True):
                    doc, words = doc.as_py(), _WORD.findall(text.as_py() or b"")
                    if rewrite:
                        words = rewrite(doc, words)
                    found = document_runs(words, least, power)
                    rows[0].append(doc)
                    rows[1].append(len(words))
                    rows[2].append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                    rows[3].append(b" ".join(collapse(words, found) if found else words))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _ARROW, strict=True)], schema=_ARROW)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        work, f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary")


def strongest(found: Column) -> Column:
    """The run with the greatest exact length / period; ties to the smallest start, then period; null without runs."""
    def better(best: Column, r: Column) -> Column:
        a, b = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (a > b), r).otherwise(best)      # runs come by start, then period

    return F.aggregate(found, F.lit(None).cast(RUN), better)


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, the strongest run, runs_sha256, collapsed_sha256) of ``periodic_runs``."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
