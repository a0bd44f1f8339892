"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of 400 bytes that together cover its whole text.  Each
passage is encoded from its byte frequencies and from how often words repeat the word
before (or the one before that).  Gated attention, tanh(HV) * sigmoid(HU), gives every
passage a weight from document labels alone; the weighted mean of the passage vectors
is scored by a logistic unit.  All weights are trained together in numpy.

The training sample is bounded by ``train_rows`` labelled documents outside the held-out
fold, taken in order of a hash of their id; scoring reads every whole text.

Defined results: a null or empty text is a bag with one passage of no bytes;
documents without label rows are scored alike; of several label rows for one id the
smallest counts; with no labelled training row all scores are 1; repeated rows stay
repeated; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RangeHash, crc_mod, ranges, thrifty_batches
from .nets import Adam, sigmoid

TRAIN_ROWS, PASSAGE, WIDTH, EPOCHS = 5_000, 400, 259, 14
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, number of passages of each text)."""
    return byte_passages([(t or "").encode("utf-8", "replace") for t in texts])


def sliced_passages(raw: bytes, most: int) -> Iterator[np.ndarray]:
    """The features of one long text's passages, worked out slice by slice.

    A slice reads back over the three words before it and on to the end of its last word, so
    each passage comes out as if the text were read at once.
    """
    step = max(PASSAGE, most // PASSAGE * PASSAGE)
    spaces = [bytes([c]) for c in np.flatnonzero(_SPACE)]
    for a in range(0, len(raw), step):
        b, lo = min(len(raw), a + step), a
        for _ in range(3):
            while lo and _SPACE[raw[lo - 1]]:
                lo -= 1
            lo = 1 + max(raw.rfind(c, 0, lo) for c in spaces)
        hi = min((k for k in (raw.find(c, b) for c in spaces) if k >= 0), default=len(raw)) if b < len(raw) and not _SPACE[raw[b - 1]] else b
        lo = lo // PASSAGE * PASSAGE
        yield byte_passages([raw[lo:hi]])[0][(a - lo) // PASSAGE: -(-(b - lo) // PASSAGE)]


def byte_passages(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(r) for r in raw], np.int64)
    count = np.maximum(1, -(-size // PASSAGE))
    buf = np.frombuffer(b"".join(raw), np.uint8)
    first = np.cumsum(count) - count
    start = np.cumsum(size) - size
    pid = np.repeat(first, size) + (np.arange(len(buf)) - np.repeat(start, size)) // PASSAGE
    n = int(count.sum())
    out = np.zeros((n, WIDTH), np.float32)
    if not len(buf):
        return out, count
    out[:, :256] = np.bincount(pid * 256 + buf, minlength=n * 256).reshape(n, 256)
    length = np.maximum(1, out[:, :256].sum(1, keepdims=True))
    space = _SPACE[buf]
    edge = np.zeros(len(buf), bool)
    edge[start[size > 0]] = True
    begins = np.flatnonzero(~space & (edge | np.concatenate(([True], space[:-1]))))
    ends = np.flatnonzero(~space & np.concatenate((edge[1:] | space[1:], [True]))) + 1
    word, where = RangeHash(buf)(begins, ends), pid[begins]
    doc = np.searchsorted(start[size > 0], begins, side="right")
    words = np.bincount(where, minlength=n)
    for j in (1, 2):
        same = np.zeros(len(word), bool)
        same[j:] = (word[j:] == word[:-j]) & (doc[j:] == doc[:-j])
        out[:, 255 + j] = np.bincount(where[same], minlength=n) / np.maximum(1, words)
    out[:, 258] = words / length[:, 0] * 5
    out[:, :256] = np.sqrt(out[:, :256] / length)
    return out, count


def _attend(net: dict, H: np.ndarray, starts: np.ndarray, bag: np.ndarray):
    T, S = np.tanh(H @ net["V"]), sigmoid(H @ net["U"])
    A = T * S
    e = A @ net["w"]
    top = np.maximum.reduceat(e, starts)
    x = np.exp(e - top[bag])
    alpha = x / np.add.reduceat(x, starts)[bag]
    z = np.add.reduceat(alpha[:, None] * H, starts)
    return T, S, A, alpha, z, sigmoid(z @ net["c"] + net["c0"])


def train_mil(X: np.ndarray, count: np.ndarray, y: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = EPOCHS,
              batch: int = 64, rate: float = 0.01, seed: int = 7) -> dict[str, np.ndarray]:
    opt = Adam({"W": (X.shape[1], hidden), "b": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,),
                "c": (hidden,), "c0": ()}, seed, rate)
    opt.w["b"][:] = 0
    first, rng = np.cumsum(count) - count, np.random.default_rng(seed)
    for epoch in range(epochs):
        opt.rate = rate * (0.2 if epoch >= epochs - 4 else 1.0)
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            pick = order[k: k + batch]
            size = count[pick]
            x = X[ranges(first[pick], size)].astype(np.float64)
            starts, bag = np.cumsum(size) - size, np.repeat(np.arange(len(pick)), size)
            net = opt.w
            H = np.tanh(x @ net["W"] + net["b"])
            T, S, A, alpha, z, p = _attend(net, H, starts, bag)
            d = (p - y[pick]) / len(pick)
            dz = d[:, None] * net["c"]
            da = (dz[bag] * H).sum(1)
            de = alpha * (da - np.add.reduceat(alpha * da, starts)[bag])
            dA = de[:, None] * net["w"]
            dv, du = dA * S * (1 - T * T), dA * T * S * (1 - S)
            dH = alpha[:, None] * dz[bag] + dv @ net["V"].T + du @ net["U"].T
            dx = dH * (1 - H * H)
            opt.step({"W": x.T @ dx + 1e-5 * net["W"], "b": dx.sum(0), "V": H.T @ dv, "U": H.T @ du, "w": A.T @ de,
                      "c": z.T @ d + 1e-5 * net["c"], "c0": d.sum()})
    return {k: np.asarray(v) for k, v in opt.w.items()}


def mil_scores(net: dict[str, np.ndarray], texts: list[str | None], most: int = 1 << 20) -> np.ndarray:
    """Scores of whole texts; only the short passage vectors of a text are held at once."""
    encoded, counts, k = [], [], 0
    while k < len(texts):
        size, group = 0, []
        while k < len(texts) and (not group or size + len(texts[k] or "") <= most):
            group.append(texts[k])
            size += len(texts[k] or "")
            k += 1
        if len(group) == 1 and size > most:     # a very long text goes through the encoder in slices
            H = np.concatenate([np.tanh(x @ net["W"] + net["b"]) for x in sliced_passages(group[0].encode("utf-8", "replace"), most)])
            count = np.array([len(H)])
        else:
            x, count = passages(group)
            H = np.tanh(x @ net["W"] + net["b"])
        encoded.append(H)
        counts.append(count)
    if not encoded:
        return np.zeros(0)
    H, count = np.concatenate(encoded), np.concatenate(counts)
    return _attend(net, H, np.cumsum(count) - count, np.repeat(np.arange(len(count)), count))[-1]


def train_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, train_rows: int = TRAIN_ROWS):
    """The trained net, or None without labelled rows; ``docs`` has doc_id and text."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (crc_mod("doc_id", folds) != held_out))
             .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            xs = [passages([t])[0].astype(np.float16) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "n": [len(x) for x in xs], "x": [x.tobytes() for x in xs]})

    got = (docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "quality", "text")
           .mapInPandas(thrifty_batches(encode), "doc_id long, quality int, n int, x binary").collect())     # bounded by train_rows
    got.sort(key=lambda r: (r["doc_id"], r["n"], r["x"]))
    if not got:
        return None
    X = np.concatenate([np.frombuffer(r["x"], np.float16).reshape(-1, WIDTH) for r in got])
    return train_mil(X, np.array([r["n"] for r in got]), np.array([float(r["quality"]) for r in got]))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3,
                   held_out: int = 1, train_rows: int = TRAIN_ROWS, keep: tuple[str, ...] | None = None, prefix: str = "") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    With ``keep`` the columns named there take the place of doc_id, unchanged; ``prefix`` goes
    before the names of the other three.
    """
    doc, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    net = train_quality(docs.select(doc.alias("doc_id"), text.alias("text")), labels.select(F.col(id_col).alias("doc_id"), "quality"), folds, held_out, train_rows)
    model = docs.sparkSession.sparkContext.broadcast(net)
    names = [f"{prefix}{c}" for c in ("held_out", "score", "predicted")]

    own = [F.col(f"`{c}`") for c in keep] if keep is not None else [doc.alias("doc_id")]
    # a text that is kept is not sent a second time
    sent = keep is not None and text_col in keep and isinstance(docs.schema[text_col].dataType, T.StringType)
    where, extra = (keep.index(text_col), []) if sent else (len(own), [text.alias(f"{prefix}text_")])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 1024) for b in batches for k in range(0, b.num_rows, 1024)):
            texts = batch.column(where).to_pylist()
            s = mil_scores(model.value, texts) if model.value is not None else np.ones(len(texts))
            columns = [*batch.columns[:kept], batch.columns[-1], pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:kept], *names])

    kept, fold = len(own), crc_mod(id_col, folds) == held_out
    rows = docs.select(*own, *extra, fold.alias(f"{prefix}fold_"))
    schema = T.StructType([*rows.schema.fields[:kept], *(T.StructField(n, t) for n, t in zip(names, (T.BooleanType(), T.DoubleType(), T.IntegerType()), strict=True))])
    return rows.mapInArrow(thrifty_batches(score), schema)
