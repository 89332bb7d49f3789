"""Date-spine arithmetic, written as expressions so no calendar join is needed."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spellcast.config import Settings


def day_number(col: Column) -> Column:
    """Days since 1970-01-01; an integer order key for range frames."""
    return F.unix_date(col)


def next_spine_date(day: Column, spine_days: tuple[int, ...]) -> Column:
    """First spine date strictly after ``day``."""
    month = F.trunc(day, "MM")
    days = sorted(spine_days)
    result = F.date_add(F.add_months(month, 1), days[0] - 1)
    for d in reversed(days):
        result = F.when(F.dayofmonth(day) < d, F.date_add(month, d - 1)).otherwise(result)
    return result


def spine_dates(s: Settings) -> list[dt.date]:
    """The configured spine, in order."""
    first, last = s.spine_start.replace(day=1), s.spine_end
    months = range((last.year - first.year) * 12 + last.month - first.month + 1)
    dates = [dt.date(first.year + (first.month - 1 + m) // 12, (first.month - 1 + m) % 12 + 1, d) for m in months for d in sorted(s.spine_days)]
    return [d for d in dates if s.spine_start <= d <= last]


def _spine_number(day: Column, s: Settings) -> Column:
    """Number of spine dates up to and including ``day``, from the month before the spine's first on."""
    months = (F.year(day) - s.spine_start.year) * 12 + F.month(day) - s.spine_start.month + 1
    return reduce(Column.__add__, [F.when(F.dayofmonth(day) >= d, 1).otherwise(0) for d in s.spine_days], months * len(s.spine_days))


def holds_spine_date(after: Column, until: Column, s: Settings) -> Column:
    """Can a spine date lie in ``(after, until]``, as far as the days of the month tell?"""
    return _spine_number(until, s) > _spine_number(after, s)


def spine_dates_between(after: Column, until: Column, s: Settings) -> Column:
    """Array of the spine dates in ``(after, until]``, clipped to the configured spine.

    A slice of the spine, whose ends are counted from the months; no date is generated for a row.
    """
    before = s.spine_start - dt.timedelta(days=1)
    lo = F.greatest(after, F.lit(before))
    hi = F.least(until, F.lit(s.spine_end))
    spine = F.expr(f"cast(array({', '.join(f"date'{d}'" for d in spine_dates(s))}) as array<date>)")
    inside = F.slice(spine, _spine_number(lo, s) - _spine_number(F.lit(before), s) + 1, _spine_number(hi, s) - _spine_number(lo, s))
    return F.when(after.isNotNull() & until.isNotNull() & (lo < hi), inside)


def date_spine(spark: SparkSession, s: Settings) -> DataFrame:
    """The spine as a one-column table."""
    one = spark.range(1).select(
        F.lit(s.spine_start - dt.timedelta(days=1)).alias("lo"), F.lit(s.spine_end).alias("hi")
    )
    return one.select(F.explode(spine_dates_between(F.col("lo"), F.col("hi"), s)).alias("snap_dt"))
