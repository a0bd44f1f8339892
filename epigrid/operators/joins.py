"""Joins (J1-J9).  The physical strategy (broadcast, sort-merge, shuffled hash)
is left to Catalyst and AQE.  A side is broadcast when its estimated size (static) or
measured size (at run time) is under the session's threshold; the static estimate does
not see the growth of an ``explode``.  Otherwise both sides are shuffled."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_renamed(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on differently named keys; the right key column is dropped."""
    return left.join(right, left[left_key] == right[right_key], "left").drop(right[right_key])


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named keys (one output copy of each key)."""
    return left.join(right, list(keys), how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join where NULL matches NULL (the reference's default join rule)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = functools.reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def join_reduce(frames: Sequence[DataFrame], keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Fold a list of tables with the same join."""
    return functools.reduce(lambda x, y: x.join(y, list(keys), how), frames)
