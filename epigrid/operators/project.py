"""Projections (P1-P13): renames, drops, mutate with consumption, relabelling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def set_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns, ``{old: new}``."""
    return df.withColumnsRenamed(dict(mapping))


def select_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename in one step, ``{new: old}`` in output order."""
    return df.select(*[F.col(old).alias(new) for new, old in mapping.items()])


def drop_geometry(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Keep the attributes of a spatial table."""
    return df.drop(geometry)


def mutate(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns."""
    return df.withColumns(dict(exprs))


def mutate_consume(df: DataFrame, exprs: Mapping[str, Column], consumed: Sequence[str]) -> DataFrame:
    """Mutate, then drop the input columns the expressions used.

    A consumed column that is also an output name is kept (it was re-created).
    """
    out = df.withColumns(dict(exprs))
    gone = [c for c in consumed if c not in exprs]
    return out.drop(*gone)


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of one column, as a one-column DataFrame."""
    return df.select(col).distinct()


def relabel(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace values by labels from a fixed map; unknown values stay as they are."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, col), col)
