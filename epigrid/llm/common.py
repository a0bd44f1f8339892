"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import inspect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epigrid.session import materialize

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    From then on the session lets Spark remove the shuffle files of a job when the job ends:
    what follows reads the stored table, and a chain of such jobs would fill the disks.
    """
    df.sparkSession.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return materialize(df, f"llm-{name}")


def give_back() -> None:
    """What this process has freed goes back to the system, with the tables of powers that ``RangeHash`` keeps."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim is not None:
        trim(0)


def thrifty(work):
    """``work`` of a group, which gives back the memory it used when it's done, and before it the last result's.

    Spark keeps Python workers between tasks and allocators keep what was freed, so an
    executor would carry the largest group of every worker along, idle ones included.
    """
    def done(*group):
        give_back()
        try:
            return work(*group)
        finally:
            give_back()

    # Spark counts the parameters
    return {1: lambda a: done(a), 2: lambda a, b: done(a, b), 3: lambda a, b, c: done(a, b, c)}[len(inspect.signature(work).parameters)]


def thrifty_batches(work):
    """``thrifty`` for work on the batches of a partition."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32(id as text) mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def pieces_for(total: int, each: int, least: int) -> int:
    """Number of equal pieces of about ``each`` units for ``total`` units."""
    return max(least, math.ceil((total or 0) / each))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values (in place)."""
    with np.errstate(over="ignore"):
        for k in range(0, len(x), 1 << 16):     # block by block, so no copies of a large array
            y = x[k: k + (1 << 16)]
            y ^= y >> U64(30)
            y *= U64(0xBF58476D1CE4E5B9)
            y ^= y >> U64(27)
            y *= U64(0x94D049BB133111EB)
            y ^= y >> U64(31)
    return x


_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        inv = pow(_P, -1, 1 << 64)
        with np.errstate(over="ignore"):
            for key, base in (("up", _P), ("down", inv)):
                p = np.full(size, base, U64)
                p[0] = 1
                _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class RangeHash:
    """64-bit polynomial hashes of any byte range of one buffer in O(1)."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        up, self.down = _powers(n + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, U64)
            terms = self.sums[1:]       # worked out in place: a copy takes eight times the text
            terms[:] = buf
            terms += U64(1)
            terms *= up[:n]
            np.cumsum(terms, out=terms)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def every(self, k: int) -> np.ndarray:
        """Hash of each k-byte range in order of its start."""
        n = len(self.sums) - k
        with np.errstate(over="ignore"):
            x = self.sums[k:] - self.sums[:n]
            x *= self.down[:n]
            return mix64(x)


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions of all given ranges, one after the other."""
    lens = np.asarray(lens, np.int64)
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lens) - lens
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - first, lens)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return starts, np.diff(np.append(starts, len(values)))
