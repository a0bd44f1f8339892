"""Interval labels for classes: ``[a,b]`` for the first class, ``(a,b]`` after.

Break values are written with ``digits`` significant digits in the style of
C's ``%.{digits}g``: fixed notation when the decimal exponent is in
``[-4, digits)``, otherwise ``d.ddde+XX``; trailing zeros are dropped.  If two
neighbouring breaks print the same, one more digit is used, up to 12 (R's
``cut(dig.lab = 5)`` rule).

Digits come from the exact decimal expansion of each break (``digits.py``), rounded
with ties to even as C rounds them.  Everything is a Spark expression over the breaks array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .digits import exact_digits, let, round_digits

MAX_DIGITS = 12


def _strip(s: Column) -> Column:
    return F.regexp_replace(s, "0+$", "")


def _text(x: Column, rounded: Column, digits: Column) -> Column:
    """``x`` in C's ``%g`` layout, given its rounded digits."""
    def lay(r: Column) -> Column:
        s, e = r["n"].cast("string"), r["e"]
        point = lambda frac: F.when(frac == "", "").otherwise(F.concat(F.lit("."), frac))
        power = F.abs(e).cast("string")
        sci = F.concat(F.substring(s, 1, 1), point(_strip(F.substring(s, F.lit(2), digits))), F.lit("e"), F.when(e < 0, "-").otherwise("+"),
                       F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power))
        large = F.concat(F.substring(s, F.lit(1), e + 1), point(_strip(F.substring(s, e + 2, digits))))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), _strip(s))
        return F.concat(F.when(x < 0, "-").otherwise(""), F.when((e < -4) | (e >= digits), sci).when(e >= 0, large).otherwise(small))

    plain = F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(plain, x.cast("string")).when(x == 0, F.lit("0")).otherwise(let(rounded, lay))


def format_g(x: Column, digits) -> Column:
    """``x`` with ``digits`` significant digits, as C's ``%g`` prints it (digits: int or Column)."""
    d = (digits if isinstance(digits, Column) else F.lit(digits)).cast("int")
    return let(x.cast("double"), lambda v: _text(v, round_digits(exact_digits(v), d), d))


def break_texts(breaks: Column, dig_lab: int = 5) -> Column:
    """The breaks as text, with the fewest digits >= ``dig_lab`` that keep neighbours apart."""
    def choose(known: Column) -> Column:
        cands = F.transform(F.sequence(F.lit(dig_lab), F.lit(MAX_DIGITS)),
                            lambda d: F.transform(known, lambda b: _text(b["x"], round_digits(b["d"], d), d)))
        return let(cands, lambda c: F.coalesce(
            F.try_element_at(F.filter(c, lambda t: F.size(F.array_distinct(t)) == F.size(t)), F.lit(1)), F.element_at(c, -1)))

    return let(F.transform(breaks, lambda b: F.struct(b.alias("x"), exact_digits(b).alias("d"))), choose)


def interval_labels_from_texts(texts: Column) -> Column:
    """Labels from break texts already chosen (one text per break)."""
    labels = F.transform(
        F.sequence(F.lit(1), F.size(texts) - 1),
        lambda i: F.concat(F.when(i == 1, "[").otherwise("("), F.element_at(texts, i), F.lit(","),
                           F.element_at(texts, i + 1), F.lit("]")))
    return F.when(F.size(texts) >= 2, labels).otherwise(F.array().cast("array<string>"))


def interval_labels(breaks: Column, dig_lab: int = 5) -> Column:
    """One label per class, right-closed, the lowest one closed on the left."""
    return interval_labels_from_texts(break_texts(breaks, dig_lab))


def label_table(breaks: DataFrame, dig_lab: int = 5) -> DataFrame:
    """``(g, breaks)`` -> ``(g, labels)``, in two projections so the texts are built once."""
    texts = breaks.select("g", break_texts(F.col("breaks"), dig_lab).alias("texts"))
    return texts.select("g", interval_labels_from_texts(F.col("texts")).alias("labels"))
