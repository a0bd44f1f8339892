"""Exact Jaccard join on five-word shingles by universe partitioning.

Sets whose sizes lie in one band are cut into the same segments: the 64-bit shingle hash
range is split evenly, so a segment of a sorted set is a slice.  With J >= 0.8 two sets
differ in at most (|x| + |y|) / 9 shingles; a band has one segment more than its largest
such number, so some segment is equal in both (pigeonhole).  A tenth of the segments also
index their one-deletion neighbourhoods; these forgive one difference and count twice,
which lets a probing set leave out segments as long as what it keeps covers its own bound
plus one.

1. Chunk tasks ask buckets which segment signatures other texts hold, and in how many
   chunks: the lengths of the inverted lists.
2. Each set allocates its probes by that cost: signatures nobody shares are free, the
   longest lists are left out first.  What remains goes to list tasks with the set's size
   and a parity bitmap (two bits a shingle).
3. In a list, a pair whose bitmaps already differ in more bits than its sizes allow cannot
   link.  The other pairs join into groups of possible links; a list reports only a tree
   of each group, never its pairs.
4. The shingle sets of each group are compared exactly.  Groups over ``block`` documents
   are split: all blocks meet the first one, then only blocks that still hold different
   components meet each other, so every pair that could join two components is compared.

Components come from the exact links.  A node is a distinct text, numbered by its chunk and
its place there; ids come in at the end, when the texts of one id are joined.

Defined results: null, empty and wordless texts have an empty set and link with nothing; a
null id is larger than all others (the id 2**63 - 1 stands for it), its rows are documents of
their own, and a component of nulls alone has a null id; rows that share one id are one
document for linking, whatever their texts; repeated rows stay repeated; an empty table gives
no rows; other columns are ignored.  Shingles are compared by 64-bit hash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import NO_ID, Chunk, ask_shared, bucket_slices, chunk_count, chunk_of, first_copies, first_rows, packed, prepared, shared_mask
from .common import RangeHash, U64, mix64, pieces_for, ranges, runs, store, thrifty, thrifty_batches
from .graph import components

SHINGLE, REGION, BLOCK = 5, 1 << 17, 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = [U64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(SHINGLE + 1)]

# size bands: [EDGE[b], EDGE[b + 1])
EDGE = [1]
while EDGE[-1] < 1 << 40:
    EDGE.append(max(EDGE[-1] + 1, math.ceil(1.5 * EDGE[-1])))
EDGE = np.array(EDGE, np.int64)
#: segments of a band, and how many of them index one-deletion neighbourhoods
PARTS = (((EDGE[1:] - 1) + (EDGE[1:] - 1) * 5 // 4) // 9 + 1).astype(np.int64)
LOOSE = -(-PARTS // 10)


def shingle_sets(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray):
    """(sorted distinct shingle hashes of all texts, their number per text)."""
    out, size = [], np.zeros(len(lens), np.int64)
    k = 0
    while k < len(lens):
        j = k + 1
        while j < len(lens) and starts[j] + lens[j] - starts[k] <= REGION:
            j += 1
        lo, hi = int(starts[k]), int(starts[j - 1] + lens[j - 1])
        text = _LOWER[buf[lo:hi]]
        space = _SPACE[text]
        edge = np.zeros(len(text) + 1, bool)
        edge[starts[k:j] - lo] = True
        edge[hi - lo] = True
        before = np.concatenate(([True], space[:-1])) | edge[:-1]
        after = np.concatenate((space[1:], [True])) | edge[1:]
        begin, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
        word = RangeHash(text)(begin, end) if len(text) else np.zeros(0, U64)
        bounds = np.searchsorted(begin, np.append(starts[k:j], hi) - lo)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(word), U64)
            n = len(word) - SHINGLE + 1
            if n > 0:
                for i in range(SHINGLE):
                    sums[:n] += word[i: i + n] * _STEP[i]
                sums[:n] = mix64(sums[:n] + U64(SHINGLE))
            for d in range(j - k):
                a, b = int(bounds[d]), int(bounds[d + 1])
                if b - a >= SHINGLE:
                    x = np.sort(sums[a: b - SHINGLE + 1])
                    x = x[np.concatenate(([True], x[1:] != x[:-1]))]
                elif b > a:
                    x = mix64(np.array([sum((word[a + i] * _STEP[i] for i in range(b - a)), U64(0)) + U64(b - a)], U64))
                else:
                    continue
                out.append(x)
                size[k + d] = len(x)
        k = j
    return (np.concatenate(out) if out else np.zeros(0, U64)), size


def band_of(size: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGE, size, side="right") - 1


def bitmaps(flat: np.ndarray, first: np.ndarray, size: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps (rows of 64-bit words) of equally long sets' slices."""
    doc = np.repeat(np.arange(len(size)), size)
    x = flat[ranges(first, size)]
    at = (mix64(x ^ U64(0x9E3779B97F4A7C15)) % U64(bits)).astype(np.int64)
    count = np.bincount(doc * bits + at, minlength=len(size) * bits).astype(np.uint8) & 1
    return np.packbits(count.reshape(len(size), bits), axis=1).view(U64)


def bits_of(band: int) -> int:
    return max(64, 1 << int(2 * EDGE[band] - 1).bit_length())


class Signatures:
    """Segment signatures of a chunk's sets under every band in which they take part."""

    def __init__(self, flat: np.ndarray, size: np.ndarray):
        self.flat, self.size, self.first = flat, size, np.cumsum(size) - size
        own = band_of(size)
        doc = np.flatnonzero(size > 0)
        use = [(doc, own[doc])]
        k = 1
        while True:     # lower bands that hold sets of at least 0.8 of the size
            low = doc[(own[doc] - k >= 0)]
            low = low[EDGE[own[low] - k + 1] - 1 >= -(-4 * size[low] // 5)]
            if not len(low):
                break
            use.append((low, own[low] - k))
            k += 1
        self.doc, self.band = np.concatenate([d for d, _ in use]), np.concatenate([b for _, b in use])
        self.index = np.concatenate([np.ones(len(doc), bool), np.zeros(len(self.doc) - len(doc), bool)])
        self.parts = PARTS[self.band]
        self._sign()

    def _sign(self):
        sig, part, loose, width = [], [], [], 1 << 16
        offset = np.cumsum(self.parts) - self.parts
        k = 0
        total = np.cumsum(self.size[self.doc])
        while k < len(self.doc):
            j = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + width, side="right")))
            d, m, b = self.doc[k:j], self.parts[k:j], self.band[k:j]
            who = np.repeat(np.arange(j - k), self.size[d])
            x = self.flat[ranges(self.first[d], self.size[d])]
            seg = (((x >> U64(32)) * m[who].astype(U64)) >> U64(32)).astype(np.int64)
            base = offset[k:j] - offset[k]
            g = base[who] + seg
            n = int(m.sum())
            count = np.bincount(g, minlength=n)
            with np.errstate(over="ignore"):
                token = mix64(x * U64(0xC2B2AE3D27D4EB4F))
                run = np.zeros(len(x) + 1, U64)
                np.cumsum(token, out=run[1:])
                end = np.cumsum(count)
                sums = run[end] - run[end - count]
                of = np.repeat(np.arange(j - k), m)
                tag = (np.arange(n) - base[of]).astype(U64) * _STEP[1] + b[of].astype(U64) * _STEP[2]
                sig.append(mix64(sums + tag + count.astype(U64) * _STEP[3]))
                part.append(np.arange(n) + offset[k])
                loose.append(np.zeros(n, bool))
                near = seg < LOOSE[b][who]
                sig.append(mix64(sums[g[near]] - token[near] + tag[g[near]] + (count[g[near]] - 1).astype(U64) * _STEP[3]))
                part.append(g[near] + offset[k])
                loose.append(np.ones(int(near.sum()), bool))
            k = j
        self.sig = np.concatenate(sig) if sig else np.zeros(0, U64)
        self.part = np.concatenate(part) if part else np.zeros(0, np.int64)
        self.loose = np.concatenate(loose) if loose else np.zeros(0, bool)
        self.entry = np.repeat(np.arange(len(self.doc)), self.parts)    # entry (document, band) of each part
        self.seg = np.arange(len(self.entry)) - np.repeat(offset, self.parts)

    def allocate(self, cost: np.ndarray) -> np.ndarray:
        """Which signatures probe, given the list length class of each (0: nobody else)."""
        dear = np.zeros(len(self.entry), np.int64)
        np.maximum.at(dear, self.part, cost.astype(np.int64))
        weight = np.where(self.seg < LOOSE[self.band[self.entry]], 2, 1)
        size = self.size[self.doc]
        bound = (size + np.minimum(size, EDGE[self.band + 1] - 1)) // 9 + 1
        order = np.lexsort((dear, self.entry))          # cheapest parts of each entry first
        w = weight[order]
        before = np.cumsum(w) - w
        start = np.cumsum(self.parts) - self.parts
        before -= np.repeat(before[start], self.parts) if len(start) else 0
        keep = np.zeros(len(self.entry), bool)
        keep[order] = before < bound[self.entry[order]]
        return keep[self.part]


def possible_groups(sig: np.ndarray, node: np.ndarray, flag: np.ndarray, size: np.ndarray, first: np.ndarray, width: np.ndarray,
                    pool: np.ndarray) -> dict[int, int]:
    """Parent of each node in the forest of pairs that share a signature and pass the bitmaps.

    An entry's bitmap is ``pool[first: first + width]``; entries of one signature are of one band and width.
    """
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    order = np.argsort(sig, kind="stable")
    start, _ = runs(sig[order])
    for s, e in zip(start, np.append(start, len(sig))[1:], strict=True):
        if e - s < 2:
            continue
        at = order[s:e]
        at = at[np.unique(node[at], return_index=True)[1]] if len(np.unique(node[at])) < e - s else at
        if len(at) < 2 or not ((flag[at] & 2) > 0).any():
            continue
        at = at[np.argsort(node[at], kind="stable")]
        if len({find(int(x)) for x in node[at]}) == 1:
            continue
        words = pool[first[at][:, None] + np.arange(width[at[0]])]
        sz, fl = size[at], flag[at]
        rest = np.arange(len(at))
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            root = int(node[at[queue[0]]])
            while queue and len(rest):
                p = queue.pop()
                ok = np.where(sz[rest] <= sz[p], (fl[rest] & 1 > 0) & (fl[p] & 2 > 0), False)
                ok |= np.where(sz[rest] >= sz[p], (fl[rest] & 2 > 0) & (fl[p] & 1 > 0), False)
                differ = np.bitwise_count(words[rest] ^ words[p]).sum(1)
                ok &= differ <= (sz[rest] + sz[p]) // 9
                ok &= 5 * np.minimum(sz[rest], sz[p]) >= 4 * np.maximum(sz[rest], sz[p])
                for q in rest[ok]:
                    a, b = find(root), find(int(node[at[q]]))
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        parent.setdefault(min(a, b), min(a, b))
                queue += rest[ok].tolist()
                rest = rest[~ok]
    return {x: find(x) for x in parent}


def exact_links(ids: np.ndarray, sets: list[np.ndarray], label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A forest of the pairs with J >= 0.8; pairs of one label are known to be connected."""
    n = len(ids)
    if n < 2:
        return []
    flat, size = np.concatenate(sets), np.array([len(s) for s in sets], np.int64)
    _, inv, df = np.unique(flat, return_inverse=True, return_counts=True)
    doc = np.repeat(np.arange(n), size)
    keep = df[inv] > 1
    doc, inv = doc[keep], inv[keep]
    used, inv = np.unique(inv, return_inverse=True)
    both = np.zeros((n, n), np.float32)
    step = 4096
    order = np.argsort(inv, kind="stable")
    doc, inv = doc[order], inv[order]
    for lo in range(0, len(used), step):
        a, b = np.searchsorted(inv, [lo, lo + step])
        m = np.zeros((n, step), np.float32)
        m[doc[a:b], inv[a:b] - lo] = 1
        both += m @ m.T
    both = both.astype(np.int64)
    union = size[:, None] + size[None, :] - both
    link = np.triu(100 * both >= 80 * union, 1)
    if label is not None:
        link &= label[:, None] != label[None, :]
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(*np.nonzero(link), strict=True):
        x, y = find(a), find(b)
        if x != y:
            parent[y] = x
            out.append((int(ids[a]), int(ids[b])))
    return out


def _verify(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    for _, g in pdf.groupby("comp", sort=False):
        g = g.drop_duplicates("node")
        out += exact_links(g["node"].to_numpy(np.int64), [np.frombuffer(x, U64) for x in g["words"]], g["label"].to_numpy(np.int64))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _sets(members: DataFrame, sets: DataFrame) -> DataFrame:
    return members.join(sets, "node").groupBy("key").applyInPandas(_verify, "a long, b long")


def _list_groups(key, pdf: pd.DataFrame) -> pd.DataFrame:
    undo = zstandard.ZstdDecompressor()
    entries, held = [[] for _ in range(6)], 0
    pool = np.empty(sum(zstandard.frame_content_size(c) for c in pdf["c"]) // 8, U64)     # room for all bitmaps, a little too large
    for a, b, c in zip(pdf["a"], pdf["b"], pdf["c"], strict=True):
        n = len(a) // 8
        raw, rows = undo.decompress(b), undo.decompress(c)
        at = np.frombuffer(raw, np.uint32, n)
        k = int(at.max()) + 1
        table = np.frombuffer(rows, np.int64, 3 * k).reshape(3, k)
        first = held + np.cumsum(table[2]) - table[2]
        columns = (np.frombuffer(a, U64), table[0][at], np.frombuffer(raw, np.uint8, n, 4 * n), table[1][at].astype(np.int32), first[at], table[2][at].astype(np.int32))
        for into, x in zip(entries, columns, strict=True):
            into.append(x)
        bits = np.frombuffer(rows, U64, -1, 24 * k)
        pool[held: held + len(bits)] = bits
        held += len(bits)
    flat = []
    while entries:
        flat.append(np.concatenate(entries.pop(0)))
    forest = possible_groups(*flat, pool)
    return pd.DataFrame([(a, b) for a, b in forest.items() if a != b], columns=["a", "b"], dtype="int64")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, dig, stays) of every row.

    ``dig`` is the digest of its text; ``stays`` marks the id and text that stand for its
    component, and all rows that link with nothing because they have no words.
    """
    rows = prepared(docs, id_col, text_col)
    n = chunk_count(rows)
    lists = max(24, n // 4)
    ids = rows.select("doc_id", "dig")
    firsts = store(first_copies(ids), "firsts")
    holds = first_rows(firsts, n)
    chunks = packed(rows, n)

    def signed(c: Chunk) -> Signatures:
        return Signatures(*shingle_sets(c.buf, c.starts, c.lens))

    def keys_of(c: Chunk):
        s = signed(c)
        owner = s.doc[s.entry[s.part]]
        order = np.argsort(s.sig, kind="stable")
        sig, owner = s.sig[order], owner[order]
        start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.zeros(0, np.int64)
        if not len(start):
            return sig, np.zeros(0, bool)
        return sig[start], np.maximum.reduceat(owner, start) != np.minimum.reduceat(owner, start)

    def send(key, pdf: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(pdf, right[right["kind"] == 0])
        s = signed(c)
        out = [(0, key[0], c.ids.tobytes(), np.array(s.size, np.int64).tobytes(), b"".join(d for _, d in c.keys))]
        keys = np.unique(s.sig)
        shared, level = shared_mask(right, keys, n)
        at = np.searchsorted(keys, s.sig)
        cost = np.where(shared[at], level[at].astype(np.int64) + 1, 0)
        probe = s.allocate(cost)
        entry = s.entry[s.part]
        use = shared[at] & (s.index[entry] | probe)
        use &= ~(s.loose & ~probe & ~s.index[entry])
        sig, entry, flag = s.sig[use], entry[use], s.index[entry[use]] * 1 + probe[use] * 2
        order = np.argsort(sig, kind="stable")
        sig, entry, flag = sig[order], entry[order], flag[order]
        words = {}
        for b in np.unique(s.band[entry]):
            e = np.unique(entry[s.band[entry] == b])
            for lo in range(0, len(e), 256):
                part = e[lo: lo + 256]
                d = s.doc[part]
                words |= dict(zip(part.tolist(), bitmaps(s.flat, s.first[d], s.size[d], bits_of(int(b))), strict=True))
        press = zstandard.ZstdCompressor(level=1)
        for b, i, j in bucket_slices(sig, lists):
            mine, at = np.unique(entry[i:j], return_inverse=True)      # a set's size and bitmap once per list task
            d = s.doc[mine]
            table = np.stack([(int(key[0]) << 32) + d, s.size[d], np.array([len(words[e]) for e in mine.tolist()], np.int64)])
            out.append((1, b, sig[i:j].tobytes(), press.compress(at.astype(np.uint32).tobytes() + flag[i:j].astype(np.uint8).tobytes()),
                        press.compress(table.tobytes() + np.concatenate([words[e] for e in mine.tolist()]).tobytes())))
        return pd.DataFrame(out, columns=["kind", "list", "a", "b", "c"])

    answers = ask_shared(chunks, holds, n, keys_of)
    sent = store(chunks.groupBy("chunk").cogroup(holds.unionByName(answers).groupBy("chunk")).applyInPandas(
        thrifty(send), "kind int, list int, a binary, b binary, c binary"), "signatures")

    possible = sent.filter("kind = 1").groupBy("list").applyInPandas(thrifty(_list_groups), "a long, b long")
    found = components(possible).withColumnRenamed("label", "comp")
    members = store(found.join(found.groupBy("comp").agg(F.count("*").alias("n")), "comp"), "members")

    def member_sets(key, pdf: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(pdf, right)
        flat, size = shingle_sets(c.buf, c.starts, c.lens)
        end = np.cumsum(size)
        node = dict(zip(zip(right["doc_id"], right["dig"], strict=True), right["node"], strict=True))
        return pd.DataFrame([(node[k], flat[e - n: e].tobytes()) for k, e, n in zip(c.keys, end.tolist(), size.tolist(), strict=True)],
                            columns=["node", "words"])

    def unpack_nodes(batches):
        for pdf in batches:
            for chunk, a, b, c in zip(pdf["list"], pdf["a"], pdf["b"], pdf["c"], strict=True):
                yield pd.DataFrame({"node": (int(chunk) << 32) + np.arange(len(a) // 8), "first": np.frombuffer(a, np.int64),
                                    "n_shingles": np.frombuffer(b, np.int64), "dig": [c[i: i + 32] for i in range(0, len(c), 32)]})

    nodes = sent.filter("kind = 0").select("list", "a", "b", "c").mapInPandas(thrifty_batches(unpack_nodes), "node long, first long, n_shingles long, dig binary")
    nodes = store(nodes, "nodes")        # used several times; the signatures beside it are large
    wanted = nodes.join(members.select("node"), "node", "left_semi").select(
        F.shiftright("node", 32).cast("int").alias("chunk"), F.col("first").alias("doc_id"), "dig", "node")
    sets = chunks.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInPandas(thrifty(member_sets), "node long, words binary")
    sets = store(sets, "sets")
    total, in_large = members.agg(F.count("*"), F.count(F.when(F.col("n") > block, 1))).first()
    bins = pieces_for(total, 512, 24)
    dealt = lambda col, parts: F.pmod(F.xxhash64(col), parts)
    small = members.filter(F.col("n") <= block).select(
        F.concat(F.lit("s"), dealt("comp", F.lit(bins))).alias("key"), "node", "comp", F.col("node").alias("label"))
    blocks = F.ceil(F.col("n") / block)
    large = members.filter(F.col("n") > block).withColumn("blk", dealt("node", blocks))
    first = large.select("comp", "node", F.explode(
        F.when(F.col("blk") == 0, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array("blk"))).alias("to"))
    first = first.select(F.concat_ws("-", F.lit("f"), "comp", "to").alias("key"), "node", "comp", F.col("node").alias("label"))
    links = store(_sets(small.unionByName(first), sets), "links")
    if in_large:
        known = components(links).select("node", "label")
        rest = large.select("comp", "node").join(known, "node", "left").select("comp", "node", F.coalesce("label", "node").alias("label"))
        weight = rest.groupBy("comp", "label").agg(F.count("*").alias("w"))
        few = weight.filter(F.col("w") <= block).groupBy("comp").agg(F.sum("w").alias("few"))
        weight = weight.join(few, "comp", "left")
        # large components fill blocks of their own; documents of small ones share blocks
        own = F.concat_ws("-", F.lit("a"), "label", dealt("node", F.ceil(F.col("w") / block)))
        shared = F.concat_ws("-", F.lit("b"), dealt("label", F.ceil(F.col("few") / block)))
        rest = store(rest.join(weight, ["comp", "label"]).select(
            "comp", "node", "label", F.when(F.col("w") > block, own).otherwise(shared).alias("blk")), "rest")
        kinds = rest.groupBy("comp", "blk").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        one, two = kinds.alias("x"), kinds.alias("y")
        pairs = (one.join(two, (F.col("x.comp") == F.col("y.comp")) & (F.col("x.blk") <= F.col("y.blk")))
                 .filter((F.col("x.lo") != F.col("x.hi")) | (F.col("y.lo") != F.col("y.hi")) | (F.col("x.lo") != F.col("y.lo")))
                 .select(F.col("x.comp").alias("comp"), F.concat_ws("-", F.lit("p"), "x.comp", "x.blk", "y.blk").alias("key"),
                         F.explode(F.array_distinct(F.array("x.blk", "y.blk"))).alias("blk")))
        more = _sets(pairs.join(rest, ["comp", "blk"]).select("key", "node", "comp", "label"), sets)
        links = links.unionByName(more)
    # the texts of one id are one document
    worded = nodes.filter("n_shingles > 0")
    several = (ids.filter(F.col("doc_id") != NO_ID).groupBy("doc_id").agg(F.min("dig").alias("lo"), F.max("dig").alias("hi"))
               .filter("lo <> hi").select("doc_id"))
    if not several.isEmpty():
        texts = ids.join(several, "doc_id").distinct().join(worded.select("dig", "node"), "dig").select("doc_id", "node")
        links = links.unionByName(texts.join(texts.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b"))
    final = components(links)
    linked = worded.join(final, "node")
    named = linked.groupBy("label").agg(F.min(F.struct("first", "dig")).alias("rep"))
    linked = linked.join(named, "label").select("dig", "n_shingles", "rep")
    alone = nodes.join(final, "node", "left_anti").select("dig", "n_shingles", F.struct("first", "dig").alias("rep"))
    out = ids.join(linked.unionByName(alone), "dig")
    bare = F.col("n_shingles") == 0
    component = F.when(bare, F.col("doc_id")).otherwise(F.col("rep.first"))
    stays = bare | ((F.col("doc_id") == F.col("rep.first")) & (F.col("dig") == F.col("rep.dig")))
    real = lambda c: F.when(c != NO_ID, c)
    return out.select(real(F.col("doc_id")).alias("doc_id"), "n_shingles", real(component).alias("component_id"), "dig", stays.alias("stays"))
