"""Registry of queries: key -> (Spark builder, DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables at ``sf_dir``.  Double columns listed in ``doubles`` are rounded
to ``DIGITS`` decimals in both the Spark result and the oracle so value hashes
compare equal.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 6

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    key: str
    build: Builder
    sql: str | None
    doubles: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Entry] = {}


def register(key: str, sql: str | None = None, doubles: tuple[str, ...] = ()):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, sql, tuple(doubles))
        return fn
    return deco


def _rounded(entry: Entry) -> Builder:
    if not entry.doubles:
        return entry.build

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = entry.build(spark, sf_dir)
        return df.withColumns({c: F.round(F.col(c), DIGITS) for c in entry.doubles})
    return run


def _rounded_sql(entry: Entry) -> str:
    if not entry.doubles:
        return entry.sql
    repl = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in entry.doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{entry.sql}\n) AS t"


def queries() -> dict[str, Builder]:
    from . import queries as _  # noqa: F401  (fills the registry)
    return {k: _rounded(e) for k, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    from . import queries as _  # noqa: F401
    return {k: _rounded_sql(e) for k, e in REGISTRY.items() if e.sql is not None}
