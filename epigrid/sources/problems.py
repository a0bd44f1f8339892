"""Parser problems (S1-S4, X1): texts that do not fit their declared type, counted and listed.

A scan with declared types turns what it cannot read into NULL.  Here all columns are read
as text and parsed by expressions, so that the text which failed stays at hand: every row
carries an array of its problems beside its typed columns.  Counts per column come from an
``Observation`` on the way, in the same pass as whatever the table is used for.

Missing cells (NULL, empty, ``NA``) are no problems.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import parse_ymd

PARSERS: dict[str, Callable[[Column], Column]] = {
    "i": lambda c: c.try_cast("int"), "l": lambda c: c.try_cast("bigint"), "d": lambda c: c.try_cast("double"),
    "D": lambda c: c.try_cast("date"), "y": parse_ymd,
}


def parse_with_problems(raw: DataFrame, types: Mapping[str, str], problems: str = "problems") -> DataFrame:
    """``raw`` (text columns) with the named columns parsed and ``problems array<struct<column,text>>``.

    ``types`` maps columns to a letter: i, l, d, D (ISO date) or y (year-month-day text in any layout).
    """
    missing = lambda c: F.col(c).isNull() | F.col(c).isin("", "NA")
    failed = [F.when(~missing(c) & PARSERS[t](F.col(c)).isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("text"))) for c, t in types.items()]
    marked = raw.withColumn(problems, F.filter(F.array(*failed), lambda p: p.isNotNull()))
    return marked.withColumns({c: F.when(~missing(c), PARSERS[t](F.col(c))) for c, t in types.items()})


def observe_problems(df: DataFrame, columns, problems: str = "problems") -> tuple[DataFrame, Observation]:
    """``df`` with an observation of the rows read and the problems of each column, filled by the first action on it."""
    seen = Observation()

    def count(name: str) -> Column:
        return F.sum(F.size(F.filter(F.col(problems), lambda p: p["column"] == name))).alias(name)

    counts = [count(c) for c in columns]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def problem_report(df: DataFrame, source: str, problems: str = "problems") -> DataFrame:
    """(source, column, text, n): each text that failed, with its number of rows."""
    rows = df.select(F.explode(problems).alias("p")).select(F.lit(source).alias("source"), "p.column", "p.text")
    return rows.groupBy("source", "column", "text").agg(F.count("*").alias("n"))
