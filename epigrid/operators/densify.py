"""Reshape and densify (R1-R6, J8, O1) and the dense key x week series.

Dense series are built without a cross join: the calendar bounds are a scalar
subquery (one aggregate, computed once), and every key row generates its own
dates with ``explode(sequence(lo, hi))`` in place, so the grid never shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import Selector, select_names
from ..functions.dates import week_floor
from ..session import materialize

def DAY() -> Column:
    return F.expr("INTERVAL 1 DAY")


def WEEK() -> Column:
    return F.expr("INTERVAL 7 DAYS")


def pivot_longer(df: DataFrame, selector: Selector | Sequence[str], names_to: str = "name",
                 values_to: str = "value", names_prefix: str | None = None) -> DataFrame:
    """Wide -> long over the selected columns; the others are identifiers.

    ``names_prefix`` is stripped from the new name column.
    """
    values = select_names(df, selector)
    ids = [c for c in df.columns if c not in values]
    out = df.unpivot(ids, values, names_to, values_to)
    if names_prefix:
        out = out.withColumn(names_to, F.regexp_replace(names_to, "^" + names_prefix, ""))
    return out


def complete_fixed(df: DataFrame, keys: Sequence[str], col: str, domain: Sequence) -> DataFrame:
    """Per key group, add the missing values of ``col`` from a fixed domain.

    Added rows carry NULL in every other column.
    """
    grid = (df.select(*keys).distinct()
              .select(*keys, F.explode(F.array(*[F.lit(v) for v in domain])).alias(col)))
    return grid.join(df, [*keys, col], "left")


def complete_dates(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Per key group, add every missing day between the group's own min and max."""
    b = df.groupBy(*keys).agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    grid = b.select(*keys, F.explode(F.sequence("__lo", "__hi", DAY())).alias(col))
    return grid.join(df, [*keys, col], "left")


def bounds_scalar(events: DataFrame, col: str) -> tuple[Column, Column]:
    """Global min/max of ``col`` as scalar-subquery columns (one aggregate job)."""
    s = events.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("b")).scalar()
    return s.getField("lo"), s.getField("hi")


def calendar(events: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Every day between the global bounds of ``col``, one row per day."""
    b = events.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi", DAY())).alias(name or col))


def days_in_week(events: DataFrame, col: str) -> DataFrame:
    """Q7 option: each Sunday week of the calendar and how many of its days the
    calendar covers (the first and last weeks are usually partial)."""
    lo, hi = bounds_scalar(events, col)
    weeks = events.sparkSession.range(1).select(
        F.explode(F.sequence(week_floor(lo), week_floor(hi), WEEK())).alias("week_start"))
    covered = F.datediff(F.least(F.date_add("week_start", 6), hi), F.greatest(F.col("week_start"), lo)) + 1
    return weeks.select("week_start", covered.alias("days_in_week"))


def replace_na(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """NULL -> constant in the named columns."""
    return df.fillna(dict(values))


def cross_calendar(keys: DataFrame, events: DataFrame, col: str, key: str = "ubigeo",
                   step: Column | None = None, floor=None) -> DataFrame:
    """Every key paired with every date between the events' global bounds.

    ``floor`` maps both bounds first (e.g. to the week start, with a 7-day step).
    """
    lo, hi = bounds_scalar(events, col)
    if floor is not None:
        lo, hi = floor(lo), floor(hi)
    return keys.select(key, F.explode(F.sequence(lo, hi, step if step is not None else DAY())).alias(col))


def sort_by(df: DataFrame, *cols: str) -> DataFrame:
    """O1: total order, for sinks only (mid-plan sorts are dropped by design)."""
    return df.orderBy(*cols)


@dataclass
class WeeklySeries:
    """A dense key x Sunday-week series held in sparse form.

    ``counts`` has one row per (key, week) with at least one event (stored
    once); ``keys`` lists every key of the dense grid; ``lo``/``hi`` are the
    first and last week starts (scalar subqueries).  ``dense()`` expands it;
    aggregates over the dense grid can be taken from ``counts`` directly,
    since the missing cells are zeros.
    """

    counts: DataFrame
    keys: DataFrame
    lo: Column
    hi: Column
    value: str
    key: str = "ubigeo"

    def dense(self) -> DataFrame:
        """Every key with every week, zero where nothing happened.

        The sparse counts of each key become one map (bounded by the number of
        weeks in the calendar), joined to the key list; each key row then
        expands to its full week range in place, so the grid never shuffles.
        """
        k, v = self.key, self.value
        per_key = self.counts.groupBy(k).agg(F.map_from_entries(F.collect_list(F.struct("week_start", v))).alias("__m"))
        grid = self.keys.select(k).join(per_key, k, "left")
        weeks = grid.select(k, "__m", F.explode(F.sequence(self.lo, self.hi, WEEK())).alias("week_start"))
        return weeks.select(k, "week_start",
                            F.coalesce(F.try_element_at("__m", F.col("week_start")), F.lit(0).cast("bigint")).alias(v))

    def known(self) -> DataFrame:
        """Sparse counts of the grid's keys only (events of unknown keys vanish)."""
        return self.counts.join(self.keys.select(self.key), self.key, "left_semi")

    def calendar(self, lo: Column | None = None, hi: Column | None = None) -> DataFrame:
        """The week starts between ``lo`` and ``hi`` (default: the series' own), one row each."""
        lo = self.lo if lo is None else lo
        hi = self.hi if hi is None else hi
        return self.keys.sparkSession.range(1).select(F.explode(F.sequence(lo, hi, WEEK())).alias("week_start"))


def weekly_series(events: DataFrame, keys: DataFrame, date_col: str, value: str,
                  key: str = "ubigeo") -> WeeklySeries:
    """Count events per (key, Sunday week) and describe the dense series.

    Events are counted with a map-side partial aggregate, so a hot key is
    reduced to at most one row per week before the shuffle.  The sparse counts
    are stored once; the calendar bounds are read from them (``week_floor`` is
    monotone, so the bounds of the week starts are the week starts of the
    event-date bounds), and the bounds span all events, known keys or not.
    """
    counts = (events.groupBy(key, week_floor(F.col(date_col)).alias("week_start"))
                    .agg(F.count(F.lit(1)).alias(value)))
    counts = materialize(counts, f"weekly-{value}")
    lo, hi = bounds_scalar(counts, "week_start")
    return WeeklySeries(counts, keys, lo, hi, value, key)


def weekly_counts(events: DataFrame, keys: DataFrame, date_col: str, value: str,
                  key: str = "ubigeo") -> DataFrame:
    """Dense key x Sunday-week counts (the fast path of C2/C3).

    Keys absent from ``keys`` are dropped; the calendar spans all events.
    Equal to the reference's key x day grid summed to weeks (see
    ``weekly_counts_daily_grid``), with 7x fewer generated rows and no shuffle
    of the grid.
    """
    return weekly_series(events, keys, date_col, value, key).dense()


def weekly_counts_daily_grid(events: DataFrame, keys: DataFrame, date_col: str, value: str,
                             key: str = "ubigeo") -> DataFrame:
    """The reference's literal plan: key x day grid, left join daily counts,
    zero-fill, floor to Sunday weeks, sum.  Kept to check and time the fast path."""
    daily = materialize(events.groupBy(key, date_col).agg(F.count(F.lit(1)).alias(value)), f"daily-{value}")
    grid = cross_calendar(keys.select(key), daily, date_col, key=key)
    dense = replace_na(grid.join(daily, [key, date_col], "left"), {value: 0})
    return (dense.groupBy(key, week_floor(F.col(date_col)).alias("week_start"))
                 .agg(F.sum(value).alias(value)))
