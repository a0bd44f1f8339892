"""Column selectors and scalar helpers (the ``across`` family, casts, rates).

A selector picks column names from a DataFrame at plan time; a column function
maps ``Column -> Column``.  ``across`` expands the pair into one projection, so
Catalyst sees plain expressions (no Python runs per row).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Selector = Callable[[Sequence[str]], list[str]]
ColumnFn = Callable[[Column], Column]


def starts_with(prefix: str) -> Selector:
    """Columns whose name starts with ``prefix``, in table order."""
    return lambda cols: [c for c in cols if c.startswith(prefix)]


def col_range(first: str, last: str) -> Selector:
    """Columns from ``first`` to ``last`` inclusive, by position (``a:b``)."""
    def pick(cols: Sequence[str]) -> list[str]:
        i, j = list(cols).index(first), list(cols).index(last)
        return list(cols[i:j + 1])
    return pick


def select_names(df: DataFrame, selector: Selector | Sequence[str]) -> list[str]:
    if callable(selector):
        return selector(df.columns)
    return list(selector)


def across(df: DataFrame, selector: Selector | Sequence[str], fn: ColumnFn,
           names: str = "{col}") -> DataFrame:
    """Apply ``fn`` to each selected column.

    ``names`` is an output-name template; ``{col}`` keeps the name (replace in
    place), anything else (``{col}_em``) adds new columns.
    """
    cols = select_names(df, selector)
    return df.withColumns({names.format(col=c): fn(F.col(c)) for c in cols})


def letters_to_zero(c: Column) -> Column:
    """A cell holding any letter becomes the text ``0``; NULL stays NULL."""
    return F.when(c.rlike("[a-zA-Z]"), F.lit("0")).otherwise(c)


def to_double(c: Column) -> Column:
    """Text -> double; text that is not a number gives NULL (no error under ANSI)."""
    return c.try_cast("double")


def per_100k(count: Column, population: Column) -> Column:
    """Rate per 100,000; a zero or NULL population gives NULL instead of Inf."""
    return F.try_divide(F.lit(100000.0) * count.cast("double"), population.cast("double"))
