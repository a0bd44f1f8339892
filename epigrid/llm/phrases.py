"""Removal of repeated word windows, exact over the whole corpus, by repeated-phrase automata.

A word goes when some window of 13 words that covers it also starts in a document with a
smaller id.

1. Every window is filed under the smallest hash of its four-word strings (its anchor).
   Consecutive windows of a document with one anchor form a passage of at most 64 windows,
   about 18 words.  Chunk tasks ask buckets which anchors other texts hold too.
2. Chunk tasks send their distinct passages of shared anchors, with the smallest and the
   greatest document id, to shards by anchor.  Equal windows have equal anchors, so a shard
   sees all copies of a window; it confirms them word for word and answers each chunk with
   the passages of which some window stands in an earlier document, and the smallest id of
   each of their windows.
3. A chunk compiles its confirmed passages into Aho-Corasick automata, in shards of at most
   ``LETTERS`` letters (two letters a word, so no state has more successors than the root of
   the vocabulary), streams all its documents through each of them, and marks the windows of
   every occurrence whose smallest id is below the document's own.

A chunk sends a passage once however many of its documents hold it, so a passage that stands
in a third of all documents is one entry per chunk.  Exact copies of a text never enter this
exchange: only the copy with the smallest id does.

Defined results: null text is empty; a null id is larger than all others and is returned as
null (the id 2**63 - 1 stands for it); rows that repeat an id and its text are repeated in the
result (neither is smaller); texts under 13 words stay; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ANSWER, NO_ID, Chunk, ask_shared, bucket_slices, chunk_count, first_copies, first_rows, packed, prepared, shared_mask
from .common import RangeHash, U64, mix64, ranges, runs, store

WINDOW, ANCHOR, LONGEST, REGION, LETTERS = 13, 4, 64, 1 << 17, 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = [U64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(32)]
_HIGH, _LOW = 0x100, 0x6000          # first code points of a word's two letters, below the surrogates
COLS = ["chunk", "kind", "bucket", "doc_id", "dig", "a", "b"]


class Words:
    """The words of texts that lie end to end: bytes with one space after each, places, hashes, and the first word of each text."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray):
        text, size, hashed, bounds = [], [], [], [np.zeros(1, np.int64)]
        k = total = 0
        while k < len(lens):
            j = k + 1
            while j < len(lens) and starts[j] + lens[j] - starts[k] <= REGION:
                j += 1
            lo, hi = int(starts[k]), int(starts[j - 1] + lens[j - 1])
            part = buf[lo:hi]
            space = _SPACE[part]
            edge = np.zeros(len(part) + 1, bool)
            edge[starts[k:j] - lo] = True
            before = np.concatenate(([True], space[:-1])) | edge[:-1] if len(part) else space
            after = np.concatenate((space[1:], [True])) | np.concatenate((edge[1:-1], [True])) if len(part) else space
            begin, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
            if len(begin):
                flat = np.full(int((end - begin).sum()) + len(begin), 32, np.uint8)
                flat[np.flatnonzero(~space) - np.repeat(begin - np.cumsum(end - begin + 1) + (end - begin + 1), end - begin)] = part[~space]
                text.append(flat)
                size.append(end - begin)
                hashed.append(RangeHash(part)(begin, end))
            bounds.append(total + np.searchsorted(begin, np.append(starts[k + 1: j], hi) - lo))
            total += len(begin)
            k = j
        self.text = np.concatenate(text) if text else np.zeros(0, np.uint8)
        self.size = np.concatenate(size) if size else np.zeros(0, np.int64)
        self.hash = np.concatenate(hashed) if hashed else np.zeros(0, U64)
        self.first = np.concatenate(bounds)
        self.at = np.concatenate(([0], np.cumsum(self.size + 1)))

    def cut(self, a: int, b: int) -> bytes:
        return self.text[self.at[a]: self.at[b]].tobytes()


def sliding_minimum(x: np.ndarray, span: int) -> np.ndarray:
    size = 1
    while 2 * size <= span:
        x, size = np.minimum(x[:-size], x[size:]), 2 * size
    return np.minimum(x[: len(x) - (span - size)], x[span - size:]) if size < span else x


def passages(w: Words, window: int, anchor: int):
    """(document, first word, windows, anchor, content hash) of the passages that hold all windows."""
    n = np.diff(w.first)
    count = np.maximum(0, n - window + 1)
    if not count.sum():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, U64))
    with np.errstate(over="ignore"):
        grams = np.zeros(len(w.hash) - anchor + 1, U64)
        for k in range(anchor):
            grams += w.hash[k: k + len(grams)] * _STEP[k]
    low = sliding_minimum(mix64(grams), window - anchor + 1)
    at = ranges(w.first[:-1], count)
    doc = np.repeat(np.arange(len(n)), count)
    low = low[at]
    fresh = np.concatenate(([True], (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])))
    start = np.flatnonzero(fresh)
    place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
    start = np.flatnonzero(place % LONGEST == 0)
    size = np.diff(np.append(start, len(at)))
    return doc[start], at[start], size, low[start], RangeHash(w.hash)(at[start], at[start] + size + window - 1)


def confirm(bodies: list[bytes], low: list[int], window: int) -> list[np.ndarray]:
    """The smallest id of each window of each distinct passage of one anchor, given each passage's smallest id."""
    cut = []
    for body in bodies:
        space = np.flatnonzero(np.frombuffer(body, np.uint8) == 32) + 1
        edge = [0, *space.tolist()]
        cut.append([body[edge[k]: edge[k + window]] for k in range(len(edge) - window)])
    first: dict[bytes, int] = {}
    for windows, i in zip(cut, low, strict=True):
        for x in windows:
            if first.get(x, NO_ID) >= i:
                first[x] = i
    return [np.array([first[x] for x in windows], np.int64) for windows in cut]


def occurrences(w: Words, found: list[bytes], letters: int = LETTERS):
    """(passage, first word) of every occurrence of the passages in the texts, by sharded automata."""
    out_p, out_w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    order = sorted(range(len(found)), key=found.__getitem__)        # shared prefixes meet in one automaton
    lens = np.array([found[k].count(b" ") for k in order], np.int64)
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    part = np.cumsum(2 * lens) // letters
    for p in np.unique(part):
        mine = [order[k] for k in np.flatnonzero(part == p)]
        size = lens[part == p]
        raw = [found[k] for k in mine]
        n = np.array([len(x) for x in raw], np.int64)
        v = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(n) - n, n)
        known = np.unique(v.hash)
        base = max(1, int(np.ceil(np.sqrt(len(known)))))

        def spell(ids: np.ndarray, base: int = base) -> str:
            pair = np.empty((len(ids), 2), np.uint32)
            pair[:, 0], pair[:, 1] = _HIGH + ids // base, _LOW + ids % base
            return pair.tobytes().decode("utf-32-le")

        auto = ahocorasick.Automaton()
        ids = np.searchsorted(known, v.hash)
        for k, (a, b) in enumerate(zip(v.first[:-1].tolist(), v.first[1:].tolist(), strict=True)):
            auto.add_word(spell(ids[a:b]), k)
        auto.make_automaton()
        # documents are streamed in stretches of words that some passage holds; nothing else can match
        ids = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
        held = known[ids] == w.hash
        s, m = runs(np.where(held, doc, -1 - np.arange(len(doc))))
        least = int(size.min())
        for a, k in zip(s[m >= least].tolist(), m[m >= least].tolist(), strict=True):
            hits = list(auto.iter(spell(ids[a: a + k])))
            if hits:
                end, which = np.array(hits, np.int64).T
                out_p.append(np.array(mine, np.int64)[which])
                out_w.append(a + (end + 1) // 2 - size[which])
    return np.concatenate(out_p), np.concatenate(out_w)


def repeated_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
                     letters: int = LETTERS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` are the words left, joined by one space, as bytes."""
    rows = prepared(docs, id_col, text_col)
    n = chunk_count(rows)
    text = F.col("text").cast("string")
    ids = rows.select("doc_id", "dig", F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"), "text")
    short = F.when(F.col("n_words") < window, F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")).cast("binary"))
    ids = ids.select("doc_id", "dig", "n_words", short.alias("kept"))
    firsts = store(first_copies(rows.select("doc_id", "dig")), "firsts")
    holds = first_rows(firsts, n)
    chunks = packed(rows, n)

    def keys_of(c: Chunk):
        doc, _, _, h, _ = passages(Words(c.buf, c.starts, c.lens), window, anchor)
        order = np.argsort(h, kind="stable")
        h, doc = h[order], doc[order]
        s, _ = runs(h)
        if not len(s):
            return h, np.zeros(0, bool)
        return h[s], np.maximum.reduceat(doc, s) != np.minimum.reduceat(doc, s)

    answers = ask_shared(chunks, holds, n, keys_of)

    def send(key, pdf: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(pdf, right[right["kind"] == 0])
        w = Words(c.buf, c.starts, c.lens)
        doc, first, count, h, content = passages(w, window, anchor)
        keys = np.unique(h)
        keep = shared_mask(right, keys, n)[0][np.searchsorted(keys, h)]
        doc, first, count, h, content = (x[keep] for x in (doc, first, count, h, content))
        order = np.lexsort((content, h))        # stable: equal passages stay in the order of their documents
        doc, first, count, h, content = (x[order] for x in (doc, first, count, h, content))
        s, _ = runs(content)
        s = np.union1d(s, runs(h)[0])
        top = np.maximum.reduceat(doc, s) if len(s) else s
        doc, first, count, h = doc[s], first[s], count[s], h[s]
        press, out = zstandard.ZstdCompressor(level=1), []
        for b, i, j in bucket_slices(h, 8 * n):
            begin = w.at[first[i:j]]
            size = w.at[first[i:j] + count[i:j] + window - 1] - begin
            head = np.stack([h[i:j].view(np.int64), c.ids[doc[i:j]], c.ids[top[i:j]], size])
            out.append((b, key[0], head.tobytes(), press.compress(w.text[ranges(begin, size)].tobytes())))
        return pd.DataFrame(out, columns=["shard", "chunk", "head", "body"])

    def shard(key, pdf: pd.DataFrame) -> pd.DataFrame:
        undo, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        heads = [np.frombuffer(h, np.int64).reshape(4, -1) for h in pdf["head"]]
        of, low, which = {}, [], []             # distinct (anchor, passage)
        for head, body in zip(heads, pdf["body"], strict=True):
            body, at, mine = undo.decompress(body), 0, []
            for h, i, _, size in head.T.tolist():
                k = of.setdefault((h, body[at: at + size]), len(low))
                at += size
                if k == len(low):
                    low.append(i)
                elif i < low[k]:
                    low[k] = i
                mine.append(k)
            which.append(mine)
        by: dict[int, list[tuple[bytes, int]]] = {}
        for (h, body), k in of.items():
            by.setdefault(h, []).append((body, k))
        minima: list = [None] * len(low)
        for group in by.values():
            if len(group) == 1:                  # no other passage of this anchor: one id holds for all windows
                body, k = group[0]
                minima[k] = np.full(body.count(b" ") - window + 1, low[k], np.int64)
            else:
                for (_, k), got in zip(group, confirm([b for b, _ in group], [low[k] for _, k in group], window), strict=True):
                    minima[k] = got
        texts, out = list(of), []
        for chunk, head, mine in zip(pdf["chunk"], heads, which, strict=True):
            told, body = [], []
            for k, top in zip(mine, head[2].tolist(), strict=True):
                if minima[k].min() < top:       # else no document of the chunk loses a word here
                    told.append(minima[k])
                    body.append(texts[k][1])
            if told:
                sizes = np.array([[len(t), len(b)] for t, b in zip(told, body, strict=True)], np.int64)
                out.append((chunk, 2, key[0], 0, None, press.compress(b"".join(body)),
                            np.concatenate(([len(told)], sizes.ravel(), *told)).astype(np.int64).tobytes()))
        return pd.DataFrame(out, columns=COLS)

    def finish(key, pdf: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(pdf, right[right["kind"] == 0])
        w = Words(c.buf, c.starts, c.lens)
        undo, found, minima = zstandard.ZstdDecompressor(), [], []
        for a, b in zip(right.loc[right["kind"] == 2, "a"], right.loc[right["kind"] == 2, "b"], strict=True):
            body, told, at = undo.decompress(a), np.frombuffer(b, np.int64), 0
            sizes = told[1: 1 + 2 * told[0]].reshape(-1, 2)
            minima.append(told[1 + 2 * told[0]:])
            for size in sizes[:, 1].tolist():
                found.append(body[at: at + size])
                at += size
        count = np.array([f.count(b" ") - window + 1 for f in found], np.int64)
        flat, off = np.concatenate(minima) if minima else np.zeros(0, np.int64), np.cumsum(count) - count
        owner = np.repeat(c.ids, np.diff(w.first))
        which, first = occurrences(w, found, letters) if found else (count, count)
        start = ranges(first, count[which])
        gone = flat[ranges(off[which], count[which])] < owner[start]
        start = start[gone]
        cover = np.zeros(len(w.size) + 1, np.int32)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + window, -1)
        removed = np.cumsum(cover)[:-1] > 0
        out = []
        for k, (i, _) in enumerate(c.keys):
            a, b = int(w.first[k]), int(w.first[k + 1])
            lost = int(removed[a:b].sum())
            at = w.text[w.at[a]: w.at[b]]
            kept = at[np.repeat(~removed[a:b], w.size[a:b] + 1)] if lost else at
            out += [(i, b - a, lost, kept[:-1].tobytes())] * c.times[k]
        got = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
        return got.assign(doc_id=pd.array([None if r[0] == NO_ID else r[0] for r in out], dtype="Int64"))

    sent = chunks.groupBy("chunk").cogroup(holds.unionByName(answers).groupBy("chunk")).applyInPandas(
        send, "shard int, chunk int, head binary, body binary")
    told = sent.groupBy("shard").applyInPandas(shard, ANSWER)
    own = chunks.groupBy("chunk").cogroup(holds.unionByName(told).groupBy("chunk")).applyInPandas(
        finish, "doc_id long, n_words long, n_removed long, kept binary")
    whole = F.col("n_words") >= window
    copies = (ids.join(firsts, "dig").filter("doc_id > first")
              .select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_words",
                      F.when(whole, F.col("n_words")).otherwise(0).alias("n_removed"), F.coalesce("kept", F.lit(b"")).alias("kept")))
    return own.unionByName(copies)


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM w)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS low FROM x) WHERE low < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM m),
k AS (SELECT doc_id, i, w[i] AS w FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM w)),
l AS (SELECT k.doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY k.i) AS t FROM k ANTI JOIN c USING (doc_id, i) GROUP BY k.doc_id)
SELECT doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN l USING (doc_id)
"""
