"""Word arrays in plain Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space and punctuation: everything between words
BREAKS = "\t\n\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words(text: Column) -> Column:
    """Lower-case words of a text; null and empty texts have none."""
    flat = F.translate(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BREAKS, " " * len(BREAKS))
    return F.array_remove(F.split(flat, " "), "")


def starts(n: Column, span: int) -> Column:
    """0 .. n - span, empty when there is no room."""
    return F.when(n >= span, F.sequence(F.lit(0), n - span)).otherwise(F.array().cast("array<int>"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it.

    Optimiser rules copy a named column into every place that uses it; inside a lambda
    that would redo the whole text for each word.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))
