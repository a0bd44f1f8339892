"""Texts in chunks, and the ask-and-answer exchange between chunks and key buckets.

A corpus is dealt into chunks of about ``CHUNK_BYTES`` by a hash of the document id; a
chunk's texts travel as compressed blobs.  Chunk tasks send their distinct 64-bit keys to
buckets by key range, and bucket tasks answer which keys other texts hold too.  A key
that a third of all documents hold is one entry per chunk, so no bucket gathers a hot
group's rows.

Exact copies of a text are found first, by a digest and a map-side combined minimum; only
the copy with the smallest id (null ids last) takes part in what follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, pieces_for, thrifty, thrifty_batches

CHUNK_BYTES = 8 << 20
NO_ID = 2**63 - 1           # stands for a null id: after all others


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text as bytes, digest); null ids become NO_ID, null texts empty."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    return rows.withColumn("dig", F.unhex(F.sha2("text", 256)))


def first_copies(rows: DataFrame) -> DataFrame:
    """(dig, first): the smallest id of each distinct text."""
    return rows.groupBy("dig").agg(F.min("doc_id").alias("first"))


def chunk_of(id_col: str, n: int):
    return F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int")


def chunk_count(rows: DataFrame) -> int:
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    return pieces_for(total, CHUNK_BYTES, 24)


def packed(rows: DataFrame, n: int) -> DataFrame:
    """(chunk, ids, digs, lens, blob): the texts of each batch by chunk, compressed."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for pdf in batches:
            out = []
            for chunk, g in pdf.groupby("chunk", sort=False):
                out.append((chunk, g["doc_id"].to_numpy(np.int64).tobytes(), b"".join(g["dig"]),
                            np.array([len(t) for t in g["text"]], np.int64).tobytes(), press.compress(b"".join(g["text"]))))
            yield pd.DataFrame(out, columns=["chunk", "ids", "digs", "lens", "blob"])

    return rows.select(chunk_of("doc_id", n).alias("chunk"), "doc_id", "text", "dig").mapInPandas(
        thrifty_batches(pack), "chunk int, ids binary, digs binary, lens binary, blob binary")


class Chunk:
    """The texts of a chunk's first copies, in the order of their ids."""

    def __init__(self, pdf: pd.DataFrame, firsts: pd.DataFrame):
        wanted = set(zip(firsts["doc_id"], firsts["dig"], strict=True))
        got = {}
        undo = zstandard.ZstdDecompressor()
        for r in pdf.itertuples():
            ids, lens, raw = np.frombuffer(r.ids, np.int64), np.frombuffer(r.lens, np.int64), undo.decompress(r.blob)
            at = 0
            for k, (i, n) in enumerate(zip(ids.tolist(), lens.tolist(), strict=True)):
                dig = r.digs[32 * k: 32 * k + 32]
                if (i, dig) in wanted:
                    got[i, dig] = got.get((i, dig), (raw[at: at + n], 0))[0], got.get((i, dig), (b"", 0))[1] + 1
                at += n
        self.keys = sorted(got)
        self.ids = np.array([i for i, _ in self.keys], np.int64)
        self.times = [got[k][1] for k in self.keys]         # repeated rows of one id and text
        texts = [got[k][0] for k in self.keys]
        self.lens = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.buf = np.frombuffer(b"".join(texts), np.uint8)


def bucket_slices(keys: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted 64-bit keys dealt by range into n buckets."""
    if not len(keys):
        return
    b = ((keys >> U64(32)) * U64(n)) >> U64(32)
    edge = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
    for s, e in zip(edge, np.append(edge[1:], len(b)), strict=True):
        yield int(b[s]), int(s), int(e)


ASK = "bucket int, chunk int, keys binary, flags binary"
# doc_id is never null here: pandas would turn the column to floats, which cannot hold large ids
ANSWER = "chunk int, kind int, bucket int, doc_id long, dig binary, a binary, b binary"


def first_rows(firsts: DataFrame, n: int) -> DataFrame:
    """First copies as rows for the chunk that holds them (kind 0)."""
    return firsts.select(chunk_of("first", n).alias("chunk"), F.lit(0).alias("kind"), F.lit(0).alias("bucket"), F.col("first").alias("doc_id"),
                         "dig", F.lit(None).cast("binary").alias("a"), F.lit(None).cast("binary").alias("b"))


def ask_shared(chunks: DataFrame, firsts: DataFrame, buckets: int, keys_of) -> DataFrame:
    """Answers (kind 1): which of a chunk's sorted keys other texts hold (a), and log2 of the chunks that hold each of these (b).

    ``keys_of(Chunk)`` gives sorted distinct keys and whether several texts of the chunk hold each.
    """
    def ask(key, pdf: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys, several = keys_of(Chunk(pdf, right))
        return pd.DataFrame([(b, key[0], keys[s:e].tobytes(), np.packbits(several[s:e]).tobytes()) for b, s, e in bucket_slices(keys, buckets)],
                            columns=["bucket", "chunk", "keys", "flags"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, U64) for k in pdf["keys"]]
        flags = [np.unpackbits(np.frombuffer(f, np.uint8), count=len(k)) for f, k in zip(pdf["flags"], keys, strict=True)]
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        start = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        count = np.diff(np.append(start, len(ordered)))
        shared = (count > 1) | (np.maximum.reduceat(np.concatenate(flags)[order], start) > 0)
        level = np.log2(count).astype(np.uint8)
        of = np.empty(len(flat), np.int64)
        of[order] = np.repeat(np.arange(len(start)), count)
        out, at = [], 0
        for chunk, bucket, k in zip(pdf["chunk"], pdf["bucket"], keys, strict=True):
            mine = of[at: at + len(k)]
            at += len(k)
            out.append((chunk, 1, bucket, 0, None, np.packbits(shared[mine]).tobytes(), level[mine[shared[mine]]].tobytes()))
        return pd.DataFrame(out, columns=["chunk", "kind", "bucket", "doc_id", "dig", "a", "b"])

    asked = chunks.groupBy("chunk").cogroup(firsts.groupBy("chunk")).applyInPandas(thrifty(ask), ASK)
    return asked.groupBy("bucket").applyInPandas(thrifty(answer), ANSWER)


def shared_mask(right: pd.DataFrame, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(held by other texts, log2 of the chunks that hold it) of a chunk's sorted keys, from the answers it got."""
    got = {r.bucket: (r.a, r.b) for r in right[right["kind"] == 1].itertuples()}
    shared, level = np.zeros(len(keys), bool), np.zeros(len(keys), np.uint8)
    for b, s, e in bucket_slices(keys, buckets):
        shared[s:e] = np.unpackbits(np.frombuffer(got[b][0], np.uint8), count=e - s).astype(bool)
        level[s:e][shared[s:e]] = np.frombuffer(got[b][1], np.uint8)
    return shared, level
