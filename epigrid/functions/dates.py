"""Date functions: lenient year-month-day parsing, Sunday weeks, epidemiological weeks.

All are ``Column -> Column`` built from Spark SQL functions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year-month-day layouts accepted by the line-list parser, after trimming: eight or six digits
# (yyyyMMdd, yyMMdd), or year, month and day separated by '-', '/', '.', '_' or a blank.  The year has
# four or two digits (00-68 is 20xx, 69-99 is 19xx), the month one or two digits or an English
# abbreviation.  Anything else, or an impossible date, gives NULL.
_DIGITS, _LETTERS, _SEPS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "/._ "
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_COMPACT_SHAPES = ("########", "######")
_DAY_SHAPES = ("-##-##", "-#-##", "-##-#", "-#-#")
_NAMED_SHAPES = ("-aaa-##", "-aaa-#")


def parse_ymd(text: Column) -> Column:
    """Text -> date, NULL when the text is not a valid year-month-day.

    The layout is recognised from the text's shape (digits -> ``#``, letters
    -> ``a``, separators -> ``-``, a character translation, no regular
    expression), rewritten as ``yyyy-M-d`` and validated by one ``try_cast``,
    which rejects impossible calendar dates. Each layout is a branch of its own,
    the most frequent first, so a text is rewritten once.
    """
    d = F.trim(text)
    t = F.lower(d)
    shape = F.translate(t, _DIGITS + _LETTERS + _SEPS,
                        "#" * len(_DIGITS) + "a" * len(_LETTERS) + "-" * len(_SEPS))
    dashed = F.translate(d, _SEPS, "-" * len(_SEPS))
    century = F.when(F.substring(d, 1, 2) >= "69", "19").otherwise("20")

    def named(year_len: int) -> Column:
        at = F.instr(F.lit(_MONTHS), F.substring(t, year_len + 2, 3))
        month = F.when(at % 3 == 1, ((at + 2) / 3).cast("int").cast("string"))
        return F.concat(F.substring(t, 1, year_len), F.lit("-"), month, F.lit("-"), F.substring(t, year_len + 6, 2))

    full, short = "####", "##"
    iso = (F.when(shape == _COMPACT_SHAPES[0], F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2)))
            .when(shape.isin(*[full + s for s in _DAY_SHAPES]), dashed)
            .when(shape == _COMPACT_SHAPES[1], F.concat(century, F.concat_ws("-", F.substring(d, 1, 2), F.substring(d, 3, 2), F.substring(d, 5, 2))))
            .when(shape.isin(*[short + s for s in _DAY_SHAPES]), F.concat(century, dashed))
            .when(shape.isin(*[full + s for s in _NAMED_SHAPES]), named(4))
            .when(shape.isin(*[short + s for s in _NAMED_SHAPES]), F.concat(century, named(2))))
    return iso.try_cast("date")


def week_floor(d: Column) -> Column:
    """The Sunday on or before ``d`` (weeks start on Sunday).

    ``date_trunc('week')`` would give Monday; ``dayofweek`` is 1 for Sunday.
    """
    return F.date_sub(d, F.dayofweek(d) - 1)


def epi_year(week_start: Column) -> Column:
    """Epidemiological year of a Sunday-starting week (the year of its Wednesday)."""
    return F.year(F.date_add(week_start, 3))


def epi_week(week_start: Column) -> Column:
    """Epidemiological week number, 1..53.

    Week 1 is the first Sunday-starting week with at least four days in the new
    year, i.e. the week whose Wednesday falls in it.
    """
    wed = F.date_add(week_start, 3)
    return (F.floor((F.dayofyear(wed) - 1) / 7) + 1).cast("int")


def year_week_label(week_start: Column) -> Column:
    """Label of an epidemiological week, e.g. ``2020 W10``."""
    return F.format_string("%d W%02d", epi_year(week_start), epi_week(week_start))
