"""Row filters (F1-F7).  Comparisons follow SQL three-valued logic: a NULL
operand drops the row, as the reference's filter does."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_na(df: DataFrame, *cols: str) -> DataFrame:
    """drop rows with a NULL in any of ``cols`` (all columns when none given).

    Written as ``IS NOT NULL`` conjuncts (not ``dropna``) so the predicates
    reach the parquet scan as pushed filters.
    """
    names = list(cols) or df.columns
    pred = F.lit(True)
    for c in names:
        pred = pred & F.col(c).isNotNull()
    return df.where(pred)


def not_matching(col: Column, pattern: str) -> Column:
    """predicate 'does not match'.  Callers drop NULLs first, as the reference does."""
    return ~col.rlike(pattern)


def substring_not_equal(col: Column, pos: int, length: int, value: str) -> Column:
    """characters ``pos..pos+length-1`` differ from ``value``; short codes give ''."""
    return F.substring(col, pos, length) != F.lit(value)


def between(col: Column, lo, hi) -> Column:
    """inclusive range."""
    return col.between(lo, hi)


def not_sentinel(*cols_and_sentinel) -> Column:
    """every column differs from the sentinel text (comma = AND)."""
    *cols, sentinel = cols_and_sentinel
    pred = F.lit(True)
    for c in cols:
        pred = pred & (F.col(c) != F.lit(sentinel))
    return pred


def on_or_after(col: Column, day: str | _dt.date) -> Column:
    """date lower bound (a date literal, pushed to the scan on stored dates)."""
    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    return col >= F.lit(day)


def equals(col: Column, value) -> Column:
    """equality with a constant."""
    return col == F.lit(value)
