"""Aggregations (A1-A8).  All are hash aggregates with a map-side partial step,
so a hot key is combined before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import Selector, select_names


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    """A1: rows per key (duplicates counted again)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def strict_sum(c: Column) -> Column:
    """Sum where one NULL makes the group NULL (the reference's plain ``sum``)."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def sum_by(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[str]) -> DataFrame:
    """A2/A3/A5: plain sums of several measures by a (compound) key."""
    return df.groupBy(*keys).agg(*[strict_sum(F.col(m)).alias(m) for m in measures])


def sum_across(df: DataFrame, keys: Sequence[str], selector: Selector | Sequence[str]) -> DataFrame:
    """A4: sum every selected column ignoring NULLs; an all-NULL group gives 0."""
    cols = select_names(df, selector)
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in cols])


def bounds(df: DataFrame, col: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Global min and max of a column, one row."""
    return df.agg(F.min(col).alias(lo), F.max(col).alias(hi))


def group_bounds(df: DataFrame, keys: Sequence[str], col: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Min and max of a column per group."""
    return df.groupBy(*keys).agg(F.min(col).alias(lo), F.max(col).alias(hi))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (e.g. Q11: a crosswalk
    child listed twice would fan out the lookup join)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` as a lookup table: fails the job when a key occurs twice (Q11).

    NULL keys match nothing in a lookup, so they may repeat.
    """
    twice = (F.count(F.lit(1)) > 1) & F.col(key).isNotNull()
    error = F.raise_error(F.concat(F.lit(f"{key} is listed more than once: "), F.col(key).cast("string")))
    return df.groupBy(key).agg(*[F.when(twice, error).otherwise(F.max(c)).alias(c) for c in df.columns if c != key])
