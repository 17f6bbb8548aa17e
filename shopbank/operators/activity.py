"""User activity: recent events, visits by hour, data-product latency, sales per user."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopbank.functions.calendar import as_date
from shopbank.functions.money import exact_sum


def recent_user_events(events: DataFrame, users: DataFrame, as_of: date | str, days: int = 7) -> DataFrame:
    """Events since ``days`` before the date, with the country of their user."""
    recent = events.where(F.col("event_time") >= F.lit(as_date(as_of) - timedelta(days=days)))
    return recent.join(users.select("user_id", "country"), "user_id").select(*events.columns, "country")


def visits_by_hour(visits: DataFrame) -> DataFrame:
    return (
        visits.where("user_id is not null")
        .groupBy("user_id", F.hour("ts").alias("hour"))
        .agg(F.count("*").alias("visits"))
    )


def _clock(seconds: str) -> Column:
    """hh:mm:ss with unbounded hours; less than a day is written as none."""
    s = F.col(seconds)
    parts = [F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60]
    clock = F.format_string("%02d:%02d:%02d", *[part.cast("int") for part in parts])
    return F.when(s < 86_400, "0d 0h 0m").otherwise(clock)


def latency_by_dataproduct(events: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    """Delay between reference date and arrival, for reference dates of the last ``days`` days.

    ``refdate`` and ``timestamp`` are text, 'yyyy-MM-dd' and 'yyyy-MM-dd HH:mm:ss'.
    """
    keys = ["dataset", "dataproduct", "mandant"]
    refdate = F.try_to_timestamp("refdate", F.lit("yyyy-MM-dd"))
    arrived = F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd HH:mm:ss"))
    recent = events.where(refdate >= F.lit(as_date(as_of) - timedelta(days=days)))
    delay = F.unix_timestamp(arrived) - F.unix_timestamp(refdate)
    stats = (
        recent.select(*keys, delay.alias("latency"))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("nr_of_events"),
            F.min("latency").alias("min_sec"),
            F.avg("latency").cast("long").alias("avg_sec"),
            F.max("latency").alias("max_sec"),
        )
    )
    return stats.withColumns({f"{x}_time": _clock(f"{x}_sec") for x in ("min", "avg", "max")})


def sales_per_user(sales: DataFrame) -> DataFrame:
    total = exact_sum(F.col("price") * F.col("quantity"))
    return sales.where("user_id is not null").groupBy("user_id").agg(total.alias("total_per_user"))


def require_rows(df: DataFrame, what: str = "output") -> DataFrame:
    """The frame itself, or an error if it holds no row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
