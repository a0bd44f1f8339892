"""Removal of repeated byte strings, exact over the whole corpus, by sharded suffix arrays.

A byte goes when some 50-byte string that covers it also starts in a document with a
smaller id.  Every 50-byte window is filed under its smallest 20-byte string by hash
(its anchor); consecutive windows with one anchor form a piece of at most 80 bytes.
Equal windows have equal anchors, so a shard that gets all pieces of an anchor sees all
copies of a window.  Anchors are mixed once more, as the smallest of many hashes would crowd
the first buckets and shards.

1. Chunk tasks send their distinct anchor hashes to buckets, which answer those that
   several texts hold (8 bytes an anchor, about one anchor in 16 bytes of text).
2. Chunk tasks send the distinct pieces of shared anchors to shards, with the smallest
   document id that holds each.
3. A shard lays its distinct pieces end to end, classifies suffixes, sorts the
   leftmost-smaller substrings recursively, induces the shard's suffix array, and computes
   permuted common prefixes.  Suffixes with 50 common bytes are copies of one window; the
   group's smallest id answers for each of them.
4. Chunk tasks mark windows whose smallest id is below the document's own, some pieces at a
   time, join the bytes they cover into spans, text by text, and hash what is left.

Anchors that ``hot`` chunks or more hold are filed window by window under the window's own
hash, so a passage that stands in a third of all documents does not meet in one shard.
Exact copies of a text never enter this exchange.

Defined results: null text is empty; a null id is larger than all others and is returned as
null; rows that repeat an id and its text are repeated in the result (neither is smaller);
texts under 50 bytes stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ANSWER, NO_ID, Chunk, ask_shared, bucket_slices, chunk_count, first_copies, first_rows, packed, prepared, shared_mask
from .common import RangeHash, U64, mix64, ranges, runs, store, thrifty
from .suffixes import common_prefixes, suffix_array

WINDOW, ANCHOR, REGION, HOT = 50, 20, 1 << 15, 1024     # regions of a size that stays in cache
AT_ONCE = 1 << 14           # pieces that are marked at a time, each of 31 windows at most
LOW = U64((1 << 22) - 1)
COLS = ["chunk", "kind", "bucket", "doc_id", "dig", "a", "b"]
PIECE = "shard int, chunk int, head binary, body binary"


def _regions(starts: np.ndarray, lens: np.ndarray, window: int):
    """(first byte, end, document, first window, windows) batches that cover every window of every text once."""
    batch, lo = [], 0
    for d, (s, n) in enumerate(zip(starts.tolist(), lens.tolist(), strict=True)):
        for a in range(0, max(0, n - window + 1), REGION):
            w = min(REGION, n - window + 1 - a)
            if batch and s + a + w + window - 1 - lo > 2 * REGION:
                yield lo, batch
                batch = []
            if not batch:
                lo = s + a
            batch.append((d, s + a, w))
    if batch:
        yield lo, batch


def pieces(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """(document, first byte, windows, anchor hash, content hash) of all pieces, in text order."""
    out = [[] for _ in range(5)]
    span = window - anchor + 1
    for lo, batch in _regions(starts, lens, window):
        doc, first, count = (np.array(x, np.int64) for x in zip(*batch, strict=True))
        hi = int((first + count).max()) + window - 1
        ranged = RangeHash(buf[lo:hi])
        h = ranged.every(anchor)
        low = (h & ~LOW) | np.arange(len(h), dtype=U64)      # ties go to the left
        m, size = low, 1
        while 2 * size <= span:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < span:
            m = np.minimum(m[: len(m) - (span - size)], m[span - size:])
        at = ranges(first - lo, count)
        best = (m[at] & LOW).astype(np.int64)
        part = np.repeat(np.arange(len(doc)), count)
        s, n = runs(best + part * (4 * REGION))
        out[0].append(doc[part[s]])
        out[1].append(at[s] + lo)
        out[2].append(n)
        out[3].append(mix64(h[best[s]]))    # smallest hashes lie close to zero: mixed, they fall evenly into ranges
        out[4].append(ranged(at[s], at[s] + n + window - 1))
    return [np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, (np.int64, np.int64, np.int64, U64, U64), strict=True)]


def shard_minima(bodies: list[bytes], docs: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(smallest id of each window, windows of each body) over distinct bodies with the smallest id of each."""
    lens = np.array([len(b) for b in bodies], np.int64)
    s = np.zeros(int(lens.sum()) + len(lens) + 1, np.uint16)
    starts = np.cumsum(lens + 1) - lens - 1
    s[ranges(starts, lens)] = np.frombuffer(b"".join(bodies), np.uint8).astype(np.uint16) + 2
    s[starts + lens] = 1                                      # ends of bodies; the last symbol is 0
    sa = suffix_array(s, 258)
    lcp = common_prefixes(s, sa)
    count = lens - window + 1
    at = ranges(starts, count)
    is_window = np.zeros(len(s), bool)
    is_window[at] = True
    owner = np.zeros(len(s), np.int64)
    owner[at] = np.repeat(docs, count)
    # windows in suffix order; a group ends where the common prefix with the window before is short
    runs_of = np.cumsum(lcp[sa] < window)
    keep = is_window[sa]
    pos, group = sa[keep], runs_of[keep]
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    low = np.minimum.reduceat(owner[pos], start)
    owner[pos] = np.repeat(low, np.diff(np.append(start, len(pos))))
    return owner[at], count


def _split_hot(doc, first, count, anchor, content, hot: np.ndarray, buf: np.ndarray, window: int):
    """Pieces of hot anchors as single windows filed under their own hash."""
    if not hot.any():
        return doc, first, count, anchor, content
    at, d = ranges(first[hot], count[hot]), np.repeat(doc[hot], count[hot])
    lo = int(at.min())
    own = RangeHash(buf[lo: int(at.max()) + window])(at - lo, at - lo + window)
    one = np.ones(len(at), np.int64)
    again = mix64(own ^ U64(0x5851F42D4C957F2D))
    join = [np.concatenate(x) for x in ((doc[~hot], d), (first[~hot], at), (count[~hot], one), (anchor[~hot], again), (content[~hot], own))]
    order = np.argsort(join[1], kind="stable")
    join = [x[order] for x in join]
    return join


def _told(rows: pd.DataFrame):
    """(anchors, content hashes, windows, smallest id of each window) of the shards' answers, some of them at a time."""
    undo = zstandard.ZstdDecompressor()
    done = np.cumsum([len(a) for a in rows["a"]]) // (24 * AT_ONCE) if len(rows) else np.zeros(0, np.int64)
    for _, part in rows.groupby(done, sort=False):
        heads = [np.frombuffer(a, np.int64).reshape(3, -1) for a in part["a"]]
        k_h, k_c, k_n = (np.concatenate([x[i] for x in heads]) for i in range(3))
        yield k_h.view(U64), k_c.view(U64), k_n, np.concatenate([np.frombuffer(undo.decompress(b), np.int64) for b in part["b"]])


def _covered(starting: np.ndarray, window: int) -> np.ndarray:
    """Which bytes of a text its windows cover, by the windows' first bytes."""
    at = np.flatnonzero(starting)
    step = np.zeros(len(starting) + 1, np.int32)
    step[at] += 1
    step[at + window] -= 1
    return np.cumsum(step, dtype=np.int32, out=step)[:-1] > 0


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
                   hot: int = HOT, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, and with ``with_text`` (dig, kept).

    ``kept`` is the remaining text where bytes were removed (a character that lost bytes
    goes whole), else null; ``dig`` is the digest of the input text.
    """
    rows = prepared(docs, id_col, text_col)
    n = chunk_count(rows)
    ids = rows.select("doc_id", "dig", F.octet_length("text").cast("long").alias("n_bytes"))
    firsts = store(first_copies(ids), "firsts")
    holds = first_rows(firsts, n)
    chunks = packed(rows, n)

    def keys_of(c: Chunk):
        doc, _, _, h, _ = pieces(c.buf, c.starts, c.lens, window, anchor)
        order = np.argsort(h, kind="stable")
        h, doc = h[order], doc[order]
        s, _ = runs(h)
        if not len(s):
            return h, np.zeros(0, bool)
        return h[s], np.maximum.reduceat(doc, s) != np.minimum.reduceat(doc, s)

    answers = ask_shared(chunks, holds, n, keys_of)

    def send(key, pdf: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(pdf, right[right["kind"] == 0])
        doc, first, count, h, content = pieces(c.buf, c.starts, c.lens, window, anchor)
        keys = np.unique(h)
        shared, level = shared_mask(right, keys, n)
        many = level >= np.log2(hot)
        where = np.searchsorted(keys, h)
        keep, is_hot = shared[where], many[where]
        out = []
        hot_keys = keys[shared & many]
        if len(hot_keys):
            out.append((-1 - key[0], key[0], hot_keys.tobytes(), b""))
        doc, first, count, h, content = _split_hot(*(x[keep] for x in (doc, first, count, h, content)), is_hot[keep], c.buf, window)
        order = np.lexsort((content, h))        # stable: within equal pieces documents stay in order
        doc, first, count, h, content = (x[order] for x in (doc, first, count, h, content))
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (content[1:] != content[:-1]))) if len(h) else np.zeros(0, bool)
        s = np.flatnonzero(new)
        top = np.maximum.reduceat(doc, s) if len(s) else s
        doc, first, count, h, content = doc[s], first[s], count[s], h[s], content[s]
        low_id, top_id, size = c.ids[doc], c.ids[top], count + window - 1
        for b, i, j in bucket_slices(h, 8 * n):
            head = np.stack([h[i:j].view(np.int64), content[i:j].view(np.int64), low_id[i:j], top_id[i:j], size[i:j]])
            out.append((b, key[0], head.tobytes(), c.buf[ranges(first[i:j], size[i:j])].tobytes()))
        return pd.DataFrame(out, columns=["shard", "chunk", "head", "body"])

    def shard(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            return pd.DataFrame([(c, 3, 0, 0, None, h, None) for c, h in zip(pdf["chunk"], pdf["head"], strict=True)], columns=COLS)
        heads = [np.frombuffer(h, np.int64).reshape(5, -1) for h in pdf["head"]]
        index, bodies, low, which = {}, [], [], []
        for head, body in zip(heads, pdf["body"], strict=True):
            at = 0
            for d, size in zip(head[2].tolist(), head[4].tolist(), strict=True):
                text = body[at: at + size]
                at += size
                k = index.setdefault(text, len(bodies))
                if k == len(bodies):
                    bodies.append(text)
                    low.append(d)
                elif d < low[k]:
                    low[k] = d
                which.append(k)
        # a piece that is its anchor's only one has no other context: its smallest id holds for all its windows
        anchors = np.zeros(len(bodies), np.int64)
        anchors[which] = np.concatenate([h[0] for h in heads])
        low = np.array(low, np.int64)
        _, of, times = np.unique(anchors, return_inverse=True, return_counts=True)
        several = np.flatnonzero(times[of] > 1)
        count = np.array([len(b) for b in bodies], np.int64) - window + 1
        minima = np.repeat(low, count)
        if len(several):
            got, _ = shard_minima([bodies[k] for k in several], low[several], window)
            minima[ranges((np.cumsum(count) - count)[several], count[several])] = got
        offset = np.cumsum(count) - count
        smallest = np.minimum.reduceat(minima, offset)
        out, at, press = [], 0, zstandard.ZstdCompressor(level=1)      # mostly one id over and over
        for chunk, head in zip(pdf["chunk"], heads, strict=True):
            mine = np.array(which[at: at + head.shape[1]], np.int64)
            at += head.shape[1]
            use = smallest[mine] < head[3]          # else no document of the chunk loses a byte here
            if use.any():
                got = mine[use]
                out.append((chunk, 2, key[0], 0, None, np.concatenate([head[:2, use].ravel(), count[got]]).tobytes(),
                            press.compress(minima[ranges(offset[got], count[got])].tobytes())))
        return pd.DataFrame(out, columns=COLS)

    def finish(key, pdf: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(pdf, right[right["kind"] == 0])
        doc, first, count, h, content = pieces(c.buf, c.starts, c.lens, window, anchor)
        hot_keys = [np.frombuffer(x, U64) for x in right.loc[right["kind"] == 3, "a"]]
        if hot_keys:
            doc, first, count, h, content = _split_hot(doc, first, count, h, content, np.isin(h, np.concatenate(hot_keys)), c.buf, window)
        order = np.argsort(content, kind="stable")
        ordered = content[order]
        starting = np.zeros(len(c.buf), bool)                   # first bytes of windows that go
        for k_h, k_c, k_n, low in _told(right[right["kind"] == 2]):
            off = np.cumsum(k_n) - k_n
            lo = np.searchsorted(ordered, k_c, "left")
            times = np.searchsorted(ordered, k_c, "right") - lo
            mine, of = order[ranges(lo, times)], np.repeat(np.arange(len(k_c)), times)
            same = h[mine] == k_h[of]
            mine, of = mine[same], of[same]
            for k in range(0, len(mine), AT_ONCE):
                p, q = mine[k: k + AT_ONCE], of[k: k + AT_ONCE]
                gone = low[ranges(off[q], count[p])] < np.repeat(c.ids[doc[p]], count[p])
                starting[ranges(first[p], count[p])[gone]] = True
        out = []
        for k, (i, dig) in enumerate(c.keys):
            s, n = int(c.starts[k]), int(c.lens[k])
            gone = _covered(starting[s: s + n], window)
            lost = int(gone.sum())
            n_spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            left = c.buf[s: s + n][~gone].tobytes()
            row = (None if i == NO_ID else i, n, lost, n_spans, hashlib.sha256(left).hexdigest(), dig,
                   left.decode("utf-8", "ignore") if lost and with_text else None)
            out += [row] * c.times[k]
        got = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "dig", "kept"])
        return got.assign(doc_id=pd.array([r[0] for r in out], dtype="Int64"))

    sent = chunks.groupBy("chunk").cogroup(holds.unionByName(answers).groupBy("chunk")).applyInPandas(thrifty(send), PIECE)
    minima = sent.groupBy("shard").applyInPandas(thrifty(shard), ANSWER)
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, dig binary, kept string"
    own = chunks.groupBy("chunk").cogroup(holds.unionByName(minima).groupBy("chunk")).applyInPandas(thrifty(finish), result)
    whole = F.col("n_bytes") >= window
    copies = (ids.join(firsts, "dig").filter("doc_id > first")
              .select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_bytes",
                      F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"), whole.cast("long").alias("n_spans"),
                      F.when(whole, hashlib.sha256(b"").hexdigest()).otherwise(F.lower(F.hex("dig"))).alias("kept_sha256"), "dig",
                      F.when(whole & F.lit(with_text), F.lit("")).alias("kept")))
    both = own.unionByName(copies)
    return both if with_text else both.drop("dig", "kept")
