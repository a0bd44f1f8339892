"""SentencePiece encoding and decoding through a relational lattice.

A word is a run of spaces with what follows it up to the next space.  No piece holds a
space after another character (a vocabulary with such a piece is refused), so no piece
crosses from one word into the next, and the best paths of the words make up the best
path of the whole text.  The distinct words of the corpus become a lattice: their substrings up to the longest
piece are exploded and equi-joined to the piece table, and Viterbi is folded over the edges
in order of their ends, a block of words at a time: best sum
of piece scores, ties to the later start.  Words of over 192 characters (texts without
spaces) would make rows of quadratic size; the chunk that holds one folds the same Viterbi
over it position by position, whole and in linear time (``Fold``).  Characters that no piece covers fall back to the
byte pieces of their UTF-8 form, so decoding gives back every text exactly.

The vocabulary's scores are read as in SentencePiece's unigram model.  (For a vocabulary
that was trained by merging, the library's own encoder applies merges instead and may split
a word differently; decoding is the same.)

Chunks ask for the words they hold and get their ids back, so each distinct word of up to
192 characters is worked out once and no task holds the corpus' vocabulary.  A chunk's words go
to buckets by hash; only numbers come back, in the order in which the chunk asked.  The piece table is bounded
by the vocabulary file and broadcast.

Defined results: null and empty texts have no tokens; a literal U+2581 is written as its
bytes; null ids stay null; repeated rows stay repeated; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import NO_ID, chunk_count, packed, prepared
from .common import ranges, runs, thrifty, thrifty_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
LONGEST = 192       # characters of a word that goes through the relational lattice
BLOCK = 1 << 18     # edges that are folded at once, at least
CHARACTER = 1 << 22     # from here on an edge's name is a character that no piece covers
_WORD = re.compile(" +[^ ]*")
_LITERAL = re.compile(f"({SPACE})")


class Vocabulary:
    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.byte_id, self.text, self.rows = [0] * 256, [b""] * n, []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.text[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i] = piece.replace(SPACE, " ").encode()
                self.rows.append((piece, i, model.get_score(i)))
        across = [p for p, _, _ in self.rows if SPACE in p.lstrip(SPACE)]
        if across:
            raise ValueError(f"pieces over several words: {across[:3]}")
        self.longest = max(len(p) for p, _, _ in self.rows)
        self.scores = [0.0] * n
        for _, i, score in self.rows:
            self.scores[i] = score
        self.fallback = min(s for _, _, s in self.rows if s > -1e8) - 10.0
        self.width = np.uint16 if n <= 1 << 16 else np.int32       # how ids travel

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "piece string, id int, score double")

    def decode(self, ids) -> str:
        text = self.text
        return b"".join([text[i] for i in ids])[1:].decode("utf-8")


def is_plain(text: str) -> bool:
    """A text whose words lie between single spaces."""
    return text != "" and SPACE not in text and "  " not in text and text[0] != " "


def words_of(text: str) -> list[str]:
    """Keys of a text's words: the word without the first space of its run (the text's first word has one before it, too).

    What follows a literal U+2581 without a space is U+2581 and the word; a literal
    U+2581 is that character alone.
    """
    if not text:
        return []
    if is_plain(text):
        return text.split(" ")
    words = [w[1:] for w in _WORD.findall(" " + text)]
    if SPACE not in text:
        return words
    out = []
    for w in words:
        first, *parts = _LITERAL.split(w)
        out.append(first)
        out += [p if p == SPACE else SPACE + p for p in parts if p]
    return out


def lattice_word(key: str) -> str:
    return key[1:] if key[:1] == SPACE else SPACE + key.replace(" ", SPACE)


class Fold:
    """Viterbi over one word of any length, with the scores and ties of ``lattice_ids``."""

    def __init__(self, rows: list[tuple[str, int, float]], fallback: float, byte_id: list[int]):
        self.pieces = {p: (i, s) for p, i, s in rows}
        self.begins = {p[:n] for p, _, _ in rows for n in range(1, len(p) + 1)}
        self.fallback, self.byte_id = fallback, byte_id

    def __call__(self, word: str) -> np.ndarray:
        n, pieces, begins = len(word), self.pieces, self.begins
        best, start, name = [-math.inf] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            e, here = s + 1, best[s]
            part = word[s]
            i, score = pieces.get(part, (-1, self.fallback))
            if here + score >= best[e]:         # a later start wins a tie
                best[e], start[e], name[e] = here + score, s, i
            while part in begins and e < n:
                e += 1
                part = word[s:e]
                got = pieces.get(part)
                if got is not None and here + got[1] >= best[e]:
                    best[e], start[e], name[e] = here + got[1], s, got[0]
        out, e = [], n
        while e:
            out += [name[e]] if name[e] >= 0 else [self.byte_id[b] for b in reversed(word[start[e]].encode())]
            e = start[e]
        return np.array(out[::-1], np.int32)


def lattice_edges(words: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(w, e): the edges of each word's lattice, all edges of a word in one partition, one after the other.

    A word is its bucket times 2**32 and its number.  An edge is one number: end, start, and the id of a piece or (from ``CHARACTER`` on) a character.
    """
    starts = words.select("bucket", "number", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
    subs = starts.select("bucket", "number", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(vocab.longest), F.length("word") - F.col("start")))).alias("n"), "word").select(
        "bucket", "number", "start", "n", F.col("word").substr(F.col("start") + 1, F.col("n")).alias("piece"))
    word = F.col("bucket").cast("long") * (1 << 32) + F.col("number")
    edge = (F.col("start") + F.col("n")).cast("long") * (1 << 40) + F.col("start").cast("long") * (1 << 24)
    # joined by hash, which takes a third of the time that whole texts as keys take, and then compared
    known = vocab.table(words.sparkSession).select(F.xxhash64("piece").alias("h"), F.col("piece").alias("known"), "id")
    same = F.startswith("known", "piece") & F.startswith("piece", "known")
    got = subs.withColumn("h", F.xxhash64("piece")).alias("s").join(F.broadcast(known).alias("k"), (F.col("s.h") == F.col("k.h")) & same, "left")
    return got.filter("id IS NOT NULL OR n = 1").select(word.alias("w"), (edge + F.coalesce("id", F.ascii("piece") + CHARACTER)).alias("e"))


def viterbi(first: np.ndarray, e: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names on each word's best path, their number by word) from the edges of a block of words.

    ``first`` has where each word's edges begin; they come by start, then end.  ``scores`` has
    the score of each id and, last, that of a character without a piece.
    """
    many = np.diff(np.append(first, len(e)))
    end, start, name = (e >> 40).astype(np.int32), (e >> 24).astype(np.int32) & 0xFFFF, e.astype(np.int32) & 0xFFFFFF
    size = np.maximum.reduceat(end, first)
    base = np.cumsum(size + 1, dtype=np.int32) - size - 1
    order = np.argsort(end.astype(np.uint16), kind="stable")        # by end, then word, then start
    of = np.repeat(base, many)
    come, go, gain = (of + start)[order], (of + end)[order], scores[np.minimum(name, len(scores) - 1)][order]
    group = np.flatnonzero(np.concatenate(([True], go[1:] != go[:-1])))     # edges into one place
    into = go[group]
    edges_of = np.diff(np.append(group, len(e)))
    ends = end[order][group]
    cuts = np.searchsorted(ends, np.arange(1, int(size.max()) + 2))
    best, sums = np.zeros(int(size.sum()) + len(size)), np.empty(len(e))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        lo, hi = group[a], group[b] if b < len(group) else len(e)
        sums[lo:hi] = best[come[lo:hi]] + gain[lo:hi]
        best[into[a:b]] = np.maximum.reduceat(sums[lo:hi], group[a:b] - lo)
    won = np.flatnonzero(sums == np.repeat(best[into], edges_of))
    last = np.zeros(len(best), np.int32)
    last[go[won]] = order[won]      # of equal sums the later start is written last
    at, todo, who, names = size.copy(), np.arange(len(size)), [], []
    while len(todo):
        k = last[base[todo] + at[todo]]
        who.append(todo)
        names.append(name[k])
        at[todo] = start[k]
        todo = todo[at[todo] > 0]
    who, names = np.concatenate(who[::-1]), np.concatenate(names[::-1])
    return names[np.argsort(who, kind="stable")], np.bincount(who, minlength=len(size))


def spelled(names: np.ndarray, count: np.ndarray, byte_id: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Names with the byte pieces of characters that no piece covers in their place."""
    odd = np.flatnonzero(names >= CHARACTER)
    if not len(odd):
        return names, count
    chars, of = np.unique(names[odd], return_inverse=True)
    forms = [[byte_id[b] for b in chr(c - CHARACTER).encode()] for c in chars.tolist()]
    long = np.array([len(x) for x in forms], np.int64)
    size = np.ones(len(names), np.int64)
    size[odd] = long[of]
    out = np.repeat(names, size)
    out[ranges((np.cumsum(size) - size)[odd], long[of])] = np.concatenate(forms)[ranges((np.cumsum(long) - long)[of], long[of])]
    return out, np.add.reduceat(size, np.cumsum(count) - count)


def lattice_ids(words: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(bucket, number, counts, ids) of runs of words: the first word's number, how many ids each has, and the ids, compressed.

    ``words`` has bucket, number and word (a space before it as U+2581), distinct and by number in each bucket.
    Explode and the broadcast join are narrow, so a word's edges stay together.
    """
    scores, byte_id = np.array([*vocab.scores, vocab.fallback]), vocab.byte_id
    width = vocab.width

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        held, rows = [], 0

        def folded(w: np.ndarray, e: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            w = w[first]
            if (w[1:] <= w[:-1]).any():
                raise ValueError("edges of one word came apart")
            ids, count = spelled(*viterbi(first, e, scores), byte_id)
            begin = np.append(0, np.cumsum(count))
            cut = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1] + 1, [True])))
            out = [(int(w[a] >> 32), int(w[a] & 0xFFFFFFFF), press.compress(count[a:b].astype(np.uint16).tobytes()),
                    press.compress(ids[begin[a]: begin[b]].astype(width).tobytes())) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                              ["bucket", "number", "counts", "ids"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(c.to_numpy() for c in batch.columns))
            rows += batch.num_rows
            if rows >= BLOCK:
                w, e = (np.concatenate(x) for x in zip(*held, strict=True))
                done = int(np.searchsorted(w, w[-1]))       # the last word may go on
                if done:
                    yield folded(w[:done], e[:done])
                held, rows = [(w[done:], e[done:])], len(w) - done
        if held:
            yield folded(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return lattice_edges(words, vocab).mapInArrow(thrifty_batches(fold), "bucket int, number int, counts binary, ids binary")


def _texts(pdf: pd.DataFrame) -> list[tuple[int, str]]:
    """(id, text) of a chunk: plain texts first, always in the same order."""
    out, undo = [], zstandard.ZstdDecompressor()
    for r in pdf.itertuples():
        raw, at = undo.decompress(r.blob), 0
        for i, n in zip(np.frombuffer(r.ids, np.int64).tolist(), np.frombuffer(r.lens, np.int64).tolist(), strict=True):
            out.append((i, raw[at: at + n].decode("utf-8", "replace")))
            at += n
    return sorted(out, key=lambda r: (not is_plain(r[1]), *r))


def _lattice_words(keys: pa.Array) -> pa.Array:
    """``lattice_word`` of many keys."""
    text = pa.large_string()
    spaced = pc.binary_join_element_wise(pa.scalar(SPACE, text), pc.replace_substring(keys, " ", SPACE), pa.scalar("", text))
    return pc.if_else(pc.starts_with(keys, SPACE), pc.utf8_slice_codeunits(keys, 1), spaced)


class ChunkWords:
    """The words of a chunk's texts in order, as numbers of its distinct words, and the words it asks each bucket for."""

    def __init__(self, texts: list[str], buckets: int):
        plain = [t for t in texts if is_plain(t)]
        cut = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        rest = [words_of(t) for t in texts[len(plain):]]
        words = pa.concat_arrays([cut.flatten(), pa.array([w for x in rest for w in x], pa.large_string())])
        self.many = np.concatenate([np.diff(cut.offsets.to_numpy()), np.array([len(x) for x in rest], np.int64)]).astype(np.int64)
        coded = words.dictionary_encode()
        self.words, self.keys = coded.indices.to_numpy(), coded.dictionary
        #: a literal U+2581 needs no lattice; long words are folded by their chunk
        small = pc.less_equal(pc.utf8_length(self.keys), LONGEST).to_numpy(zero_copy_only=False)
        alone = pc.equal(self.keys, SPACE).to_numpy(zero_copy_only=False)
        self.long, self.alone = np.flatnonzero(~small), np.flatnonzero(alone)
        asked = np.flatnonzero(small & ~alone)
        words = _lattice_words(self.keys.take(pa.array(asked)))
        bucket = np.fromiter(map(zlib.crc32, words.cast(pa.large_binary()).to_pylist()), np.int64, len(words)) % buckets
        order = np.argsort(bucket, kind="stable")
        first, many = runs(bucket[order])
        self.order, self.asked = asked[order], words.take(pa.array(order))
        self.slices = list(zip(bucket[order][first].tolist(), first.tolist(), (first + many).tolist(), strict=True))


def _bucket_words(blobs) -> tuple[np.ndarray, pa.Array, list[int]]:
    """(number of each word asked, the distinct words in order, how many words each blob holds)."""
    undo = zstandard.ZstdDecompressor()
    cut = pc.split_pattern(pa.array([undo.decompress(b).decode() for b in blobs], pa.large_string()), " ")
    coded = cut.flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order)), np.diff(cut.offsets.to_numpy()).tolist()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, token_ids, round_trip) of every row; ``round_trip`` says that decoding gave the text back."""
    vocab = Vocabulary(model)
    rows = prepared(docs, id_col, text_col).withColumn("dig", F.lit(b""))
    n = chunk_count(rows)
    buckets = n
    chunks = packed(rows, n)
    width = vocab.width

    def ask(key, pdf: pd.DataFrame) -> pd.DataFrame:
        found = ChunkWords([t for _, t in _texts(pdf)], buckets)
        press = zstandard.ZstdCompressor(level=3)
        return pd.DataFrame([(b, key[0], press.compress(" ".join(found.asked[s:e].to_pylist()).encode())) for b, s, e in found.slices],
                            columns=["bucket", "chunk", "words"])

    # a fixed number: a word's lattice is a hundred times its size, which adaptive coalescing cannot see
    asked = chunks.groupBy("chunk").applyInPandas(thrifty(ask), "bucket int, chunk int, words binary").repartition(buckets, "bucket")

    def distinct(key, pdf: pd.DataFrame) -> pd.DataFrame:
        words = _bucket_words(pdf["words"])[1].to_pylist()
        return pd.DataFrame({"bucket": key[0], "number": np.arange(len(words), dtype=np.int32), "word": words})

    lexicon = lattice_ids(asked.groupBy("bucket").applyInPandas(thrifty(distinct), "bucket int, number int, word string"), vocab)

    def answer(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        undo, press, out = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3), []
        right = right.sort_values("number")
        count = np.concatenate([np.frombuffer(undo.decompress(c), np.uint16) for c in right["counts"]]).astype(np.int64)
        ids = np.concatenate([np.frombuffer(undo.decompress(x), width) for x in right["ids"]])
        first = np.cumsum(count) - count
        words, _, many = _bucket_words(left["words"])
        at = 0
        for chunk, m in zip(left["chunk"], many, strict=True):
            mine = words[at: at + m]
            at += m
            out.append((chunk, key[0], press.compress(count[mine].astype(np.uint16).tobytes()), press.compress(ids[ranges(first[mine], count[mine])].tobytes())))
        return pd.DataFrame(out, columns=["chunk", "bucket", "counts", "ids"])

    answers = asked.groupBy("bucket").cogroup(lexicon.groupBy("bucket")).applyInPandas(thrifty(answer), "chunk int, bucket int, counts binary, ids binary")
    piece, scored, fallback, byte_id = vocab.text, vocab.rows, vocab.fallback, vocab.byte_id

    def finish(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        undo = zstandard.ZstdDecompressor()
        texts = _texts(left)
        found = ChunkWords([t for _, t in texts], buckets)
        got = {r.bucket: (r.counts, r.ids) for r in right.itertuples()}
        counts = [np.frombuffer(undo.decompress(got[b][0]), np.uint16) for b, _, _ in found.slices]
        flat = [np.frombuffer(undo.decompress(got[b][1]), width) for b, _, _ in found.slices]
        fold = Fold(scored, fallback, byte_id) if len(found.long) else None
        own = [fold(lattice_word(w)) for w in found.keys.take(pa.array(found.long)).to_pylist()]
        own += [np.array([byte_id[b] for b in SPACE.encode()], np.int32) for _ in found.alone]
        named = np.concatenate([found.order, found.long, found.alone])
        many = np.concatenate([*counts, [len(x) for x in own]]).astype(np.int64)
        flat = np.concatenate([*flat, *own, np.zeros(0, np.int32)]).astype(np.int32)
        count, first = np.zeros(len(named), np.int64), np.zeros(len(named), np.int64)
        count[named], first[named] = many, np.cumsum(many) - many
        out, at = [], 0
        for (i, t), m in zip(texts, found.many.tolist(), strict=True):
            ws = found.words[at: at + m]
            at += m
            ids = flat[ranges(first[ws], count[ws])]
            same = b"".join([piece[k] for k in ids.tolist()])[1:] == t.encode()
            out.append((None if i == NO_ID else i, len(ids), ids, same))
        got = pd.DataFrame(out, columns=["doc_id", "n_tokens", "token_ids", "round_trip"])
        return got.assign(doc_id=pd.array([r[0] for r in out], dtype="Int64"))

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        thrifty(finish), "doc_id long, n_tokens int, token_ids array<int>, round_trip boolean")


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids", model: str = MODEL) -> DataFrame:
    """(doc_id, text) from token ids; null ids lists decode to the empty text."""
    vocab = Vocabulary(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [vocab.decode(x) if x is not None else "" for x in pdf["ids"]]})

    return tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInPandas(run, "doc_id long, text string")
