"""Calendar trends of one year of transactions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopbank.functions.calendar import within_year
from shopbank.functions.rows import having


def lines_of_year(transactions: DataFrame, year: int) -> DataFrame:
    """The base of the operators below."""
    return having(transactions, "transaction_date", "transaction_id", "quantity").where(
        within_year(F.col("transaction_date"), year)
    )


def _day():
    return F.to_date("transaction_date").alias("the_date")


def closure_days(lines: DataFrame, year: int) -> DataFrame:
    """Days of the year without a sale."""
    days = F.sequence(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31)))
    calendar = lines.sparkSession.range(1).select(F.explode(days).alias("the_date"))
    return calendar.join(lines.select(_day()).distinct(), "the_date", "left_anti")


def busiest_month(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.month("transaction_date").alias("month")).agg(F.sum("quantity").alias("total_items"))


def top_days(lines: DataFrame, n: int = 10) -> DataFrame:
    totals = lines.groupBy(_day()).agg(F.sum("quantity").alias("total_items"))
    return totals.orderBy(F.desc("total_items"), "the_date").limit(n)


def _items_by_hour(lines: DataFrame) -> DataFrame:
    return lines.groupBy(_day(), F.hour("transaction_date").alias("hour")).agg(F.sum("quantity").alias("items"))


def peak_hour_per_day(lines: DataFrame) -> DataFrame:
    """Equal hours are settled in favour of the earlier one."""
    most = Window.partitionBy("the_date").orderBy(F.desc("items"), "hour")
    return (
        _items_by_hour(lines)
        .withColumn("rank", F.row_number().over(most))
        .where("rank = 1")
        .select("the_date", F.col("hour").alias("peak_hour"), "items")
    )


def hourly_item_stats(lines: DataFrame) -> DataFrame:
    return (
        _items_by_hour(lines)
        .groupBy("hour")
        .agg(F.min("items").alias("min_items"), F.max("items").alias("max_items"), F.avg("items").alias("avg_items"))
    )


def max_tx_open_close(lines: DataFrame, opening_hour: int = 7, closing_hour: int = 21) -> DataFrame:
    """The day with most transactions in the opening hour, and the same for the closing hour."""
    hour = F.hour("transaction_date")
    counts = (
        lines.where(hour.isin(opening_hour, closing_hour))
        .groupBy(F.when(hour == opening_hour, "opening").otherwise("closing").alias("slot"), _day())
        .agg(F.count_distinct("transaction_id").alias("tx_count"))
    )
    most = Window.partitionBy("slot").orderBy(F.desc("tx_count"), "the_date")
    return counts.withColumn("rank", F.row_number().over(most)).where("rank = 1").drop("rank")


def daily_distribution(lines: DataFrame) -> DataFrame:
    """Customers, transactions and items by weekday, 1 for Sunday to 7 for Saturday."""
    return lines.groupBy(F.dayofweek("transaction_date").alias("dow")).agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("transaction_id").alias("transactions"),
        F.sum("quantity").alias("items"),
    )


def friday_trends(lines: DataFrame) -> DataFrame:
    return (
        lines.where(F.dayofweek("transaction_date") == 6)
        .groupBy(_day())
        .agg(F.count_distinct("transaction_id").alias("transactions"), F.sum("quantity").alias("items"))
    )
