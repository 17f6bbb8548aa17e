"""Interval join of dated facts with validity windows.

A join on the product alone, with the window as a residual, compares every fact of a product with
every window of it and puts a hot product into one task. Here a window is taken apart into aligned
ranges of 1, 2, 4, ... business weeks, and a fact looks up the one range of each length that its week lies
in: an equi join on (product, length, range). A Wednesday-to-Tuesday discount is one range; a window
of n weeks is at most 2 log2(n) of them, one of ten years fewer than 20. Facts look up those lengths only
that some window has, so without long windows they are not repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopbank.functions.calendar import day_in_week, week_start



def week_number(day: Column) -> Column:
    """Number of the business week a day is in."""
    return F.floor(F.unix_date(week_start(day)) / 7).cast("int")


def week_ranges(low: str, high: str) -> Column:
    """Structs (level, range) that tile the weeks ``low`` to ``high``: the weeks from range * 2^level on, 2^level of them.

    At each level the ranges inside the window run from ``a`` to ``b``. All but an odd one at the left end and an even one at the right end are
    halves of ranges of the next level that lie inside too. Levels whose ranges are longer than the window are not looked at.
    """
    top = f"length(bin({high} - {low} + 1)) - 1"
    a, b = f"shiftright({low} + shiftleft(1, k) - 1, k)", f"shiftright({high} + 1, k) - 1"
    tiles = [f"if({a} <= {b} and pmod({x}, 2) = {odd}, struct(k as level, {x} as range), null)" for x, odd in ((a, 1), (b, 0))]
    return F.expr(f"array_distinct(array_compact(flatten(transform(sequence(0, {top}), k -> array({', '.join(tiles)})))))")


def spread_over_ranges(windows: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per window and range of weeks, in the columns ``level`` and ``range``. Empty windows give none."""
    weeks = windows.where(first <= last).withColumns({"_low": week_number(first), "_high": week_number(last)})
    one = F.array(F.struct(F.lit(0).alias("level"), F.col("_low").alias("range")))
    tiled = weeks.withColumn("_tile", F.explode(F.when(F.col("_low") == F.col("_high"), one).otherwise(week_ranges("_low", "_high"))))
    return tiled.select(*windows.columns, F.col("_tile.level").alias("level"), F.col("_tile.range").alias("range"))


def days_in_windows(
    facts: DataFrame, day: str, windows: DataFrame, first: Column, last: Column, key: str = "product_id"
) -> DataFrame:
    """Every fact joined with every window of its key that holds its day (both ends included), once.

    ``facts`` should already be reduced to one row per key and day, which leaves at most seven of
    them for a week. ``first`` and ``last`` are expressions over ``windows``, which must not
    share other names than the key with ``facts``.
    """
    ranges = spread_over_ranges(windows, first, last)
    # Windows of the same days have the same levels, so these are read from the distinct spans.
    spans = windows.select(first.alias("_first"), last.alias("_last")).distinct()
    levels = spread_over_ranges(spans, F.col("_first"), F.col("_last")).agg(F.collect_set("level")).scalar()
    dated = facts.withColumn("level", F.explode(levels)).withColumn("range", _range_of(day))
    pairs = dated.join(ranges, [key, "level", "range"])
    return pairs.where(F.col(day).between(first, last)).drop("level", "range")


def _range_of(day: str) -> Column:
    """The range of length 2^level in which a day's week lies."""
    return F.call_function("shiftright", week_number(F.col(day)), F.col("level"))


def spread_over_weeks(windows: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per window and touched week, in the column ``week_start``. Empty windows give none."""
    weeks = F.sequence(week_start(first), week_start(last), F.expr("interval 7 days"))
    return windows.where(first <= last).select("*", F.explode(weeks).alias("week_start"))


def days_covered(windows: DataFrame, first: str, last: str, key: str = "product_id") -> DataFrame:
    """The days inside any window, one row per key and week: ``days`` has bit 0 for its Wednesday, and so on.

    A left join on (key, ``week``) with this table cannot repeat a fact, however many windows overlap.
    The week is numbered after the grouping by its date: the join then shuffles both its sides, which
    adaptive execution needs in order to split a week that holds much of the facts.
    """
    spread = spread_over_weeks(windows.select(key, first, last), F.col(first), F.col(last))
    start = F.greatest(F.datediff(first, "week_start"), F.lit(0))
    end = F.least(F.datediff(last, "week_start"), F.lit(6))
    bits = F.expr("shiftleft(1, stop + 1) - shiftleft(1, start)")
    return (
        spread.select(key, "week_start", start.alias("start"), end.alias("stop"))
        .groupBy(key, "week_start")
        .agg(F.bit_or(bits).alias("days"))
        .select(key, week_number(F.col("week_start")).alias("week"), "days")
    )


def is_covered(day: Column) -> Column:
    """Whether a day is among the joined ``days`` of its week; false without any."""
    return F.coalesce(F.getbit("days", day_in_week(day)) == 1, F.lit(False))
