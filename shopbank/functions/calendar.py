"""Business calendar: the Wednesday-to-Tuesday week, day and year filters, ages."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def week_start(day: Column) -> Column:
    """The Wednesday on or before ``day``."""
    return F.next_day(F.date_sub(day, 7), "Wed")


def day_in_week(day: Column) -> Column:
    """0 for Wednesday up to 6 for Tuesday."""
    return F.datediff(day, week_start(day))


def completed_years(since: Column, until: Column) -> Column:
    return F.floor(F.months_between(until, since) / 12).cast("int")


# Day and year filters compare the bare column with literals, so that they reach the file scan.
def on_day(moment: Column, day: date | str) -> Column:
    first = as_date(day)
    return (moment >= F.lit(first)) & (moment < F.lit(first + timedelta(days=1)))


def within_year(moment: Column, year: int) -> Column:
    return (moment >= F.lit(date(year, 1, 1))) & (moment < F.lit(date(year + 1, 1, 1)))
