"""Price history: gap filling, changes, first and last prices, trend, taxes, weekly averages.

Prices of one product on one day are ordered by value wherever an order is needed. This lets every
operator first reduce the table to one row per product and day with a map-side combine. What is left
per product is bounded by the length of the calendar, so a product that holds a third of all rows
still makes a small window.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopbank.functions.calendar import as_date, week_start, within_year
from shopbank.functions.money import exact_avg, from_exact, to_exact
from shopbank.functions.rows import having


def valid_prices(prices: DataFrame) -> DataFrame:
    return having(prices, "product_id", "valid_date", "price")


def _daily_range(prices: DataFrame) -> DataFrame:
    """Lowest and highest price by product and day. Structs, whose aggregates sort their input, only see what this leaves."""
    by_day = valid_prices(prices).groupBy("product_id", "valid_date")
    return by_day.agg(F.min("price").alias("low"), F.max("price").alias("high"))


def filled_prices(
    prices: DataFrame,
    products: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """One row per product and day, with the last known price carried forward over the gaps.

    The days run from the first to the last day of the price table, or over ``start``..``end``; then
    the last price before ``start`` is carried in. A day before the first known price stays null.

    The grid itself is never shuffled: every recorded price is turned into the run of days up to the
    next one, after the only exchange by product.
    """
    dated = having(prices, "product_id", "valid_date")
    first = F.lit(as_date(start)) if start else dated.agg(F.min("valid_date")).scalar()
    last = F.lit(as_date(end)) if end else dated.agg(F.max("valid_date")).scalar()

    # Every product starts a run on the first day, whether or not it has a price then.
    listed = products.where("product_id is not null").select(
        "product_id",
        first.alias("day"),
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("double").alias("carried"),
        F.lit(True).alias("listed"),
    )
    known = dated.where("price is not null")
    if end:
        known = known.where(F.col("valid_date") <= last)
    recorded = (known.where(F.col("valid_date") >= first) if start else known).select(
        "product_id",
        F.col("valid_date").alias("day"),
        "price",
        F.lit(None).cast("double").alias("carried"),
        F.lit(False).alias("listed"),
    )
    points = listed.unionByName(recorded)
    if start:
        before = (
            known.where(F.col("valid_date") < first)
            .groupBy("product_id", "valid_date")
            .agg(F.max("price").alias("price"))
            .groupBy("product_id")
            .agg(F.max(F.struct("valid_date", "price")).alias("latest"))
        )
        points = points.unionByName(
            before.select(
                "product_id",
                first.alias("day"),
                F.lit(None).cast("double").alias("price"),
                F.col("latest.price").alias("carried"),
                F.lit(False).alias("listed"),
            )
        )
    per_day = points.groupBy("product_id", "day").agg(
        F.max("price").alias("price"), F.max("carried").alias("carried"), F.max("listed").alias("listed")
    )
    whole = Window.partitionBy("product_id")
    runs = per_day.select(
        "product_id",
        "day",
        "price",
        F.coalesce("price", "carried").alias("price_filled"),
        F.coalesce(F.date_sub(F.lead("day").over(whole.orderBy("day")), 1), last).alias("until"),
        F.max("listed").over(whole).alias("listed"),
    )
    return (
        runs.where("listed and day <= until")
        .select("*", F.explode(F.sequence(F.unix_date("day"), F.unix_date("until"))).alias("number"))
        .select(
            "product_id",
            F.date_from_unix_date("number").alias("valid_date"),
            F.when(F.col("number") == F.unix_date("day"), F.col("price")).alias("price"),
            "price_filled",
        )
    )


def missing_prices(
    prices: DataFrame,
    products: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """The product days without a recorded price."""
    return filled_prices(prices, products, start, end).where("price is null").select("product_id", "valid_date")


def _days_of_year(prices: DataFrame, year: int) -> DataFrame:
    return valid_prices(prices).where(within_year(F.col("valid_date"), year)).groupBy("product_id", "valid_date")


def _previous(column: str) -> Column:
    return F.lag(column).over(Window.partitionBy("product_id").orderBy("valid_date"))


def frequent_price_changes(prices: DataFrame, year: int) -> DataFrame:
    """Changes against the previous recorded price, per product with at least one."""
    per_day = _days_of_year(prices, year).agg(
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.count_distinct("price").alias("levels"),
    )
    moved = F.when(F.col("low") != _previous("high"), 1).otherwise(0)
    return (
        per_day.select("product_id", (F.col("levels") - 1 + moved).alias("changes"))
        .groupBy("product_id")
        .agg(F.sum("changes").alias("change_count"))
        .where("change_count > 0")
    )


def never_decreased(prices: DataFrame, year: int) -> DataFrame:
    per_day = _days_of_year(prices, year).agg(F.min("price").alias("low"), F.max("price").alias("high"))
    fell = F.when(F.col("low") < _previous("high"), 1).otherwise(0)
    return (
        per_day.select("product_id", fell.alias("fell"))
        .groupBy("product_id")
        .agg(F.sum("fell").alias("decrease_events"))
        .where("decrease_events = 0")
    )


def increase_before_discount(prices: DataFrame, discounts: DataFrame) -> DataFrame:
    """Discounts whose mean price in the 7 days before was above that of the 7 days before those."""
    daily = (
        valid_prices(prices)
        .groupBy("product_id", "valid_date")
        .agg(F.sum(to_exact(F.col("price"))).alias("price_sum"), F.count("*").alias("rows"))
    )
    listed = having(discounts, "discount_id", "product_id", "valid_from").select(
        "discount_id", "product_id", "valid_from"
    )
    # Discounts of a product that start on the same day share their means. A start is a day without a price of its own; products have as many
    # rows as days here, so sums over frames of days need no join.
    starts = listed.select("product_id", F.col("valid_from").alias("valid_date")).distinct()
    days = daily.withColumn("start", F.lit(False)).unionByName(starts.withColumn("start", F.lit(True)), allowMissingColumns=True)
    by_day = Window.partitionBy("product_id").orderBy(F.unix_date("valid_date"))

    def mean(first: int, last: int) -> Column:
        frame = by_day.rangeBetween(first, last)
        return F.try_divide(from_exact(F.sum("price_sum").over(frame)), F.sum("rows").over(frame))

    risen = (
        days.withColumns({"price_near": mean(-7, -1), "price_far": mean(-14, -8)})
        .where("start and price_near > price_far")
        .select("product_id", F.col("valid_date").alias("valid_from"), "price_near", "price_far")
    )
    return (
        listed.distinct()
        .join(risen, ["product_id", "valid_from"])
        .select("discount_id", "product_id", "valid_from", "price_near", "price_far")
    )


def first_and_last_prices(prices: DataFrame) -> DataFrame:
    """First and last recorded price per product, and the relative change between them."""
    ends = (
        _daily_range(prices)
        .groupBy("product_id")
        .agg(
            F.min(F.struct("valid_date", F.col("low").alias("price"))).alias("first"),
            F.max(F.struct("valid_date", F.col("high").alias("price"))).alias("last"),
        )
    )
    change = F.try_divide(F.col("last.price") - F.col("first.price"), F.col("first.price"))
    return ends.select(
        "product_id",
        F.col("first.price").alias("first_price"),
        F.col("first.valid_date").alias("first_date"),
        F.col("last.price").alias("last_price"),
        F.col("last.valid_date").alias("last_date"),
        change.alias("delta_pct"),
    )


def price_increases(first_last: DataFrame, above: float = 0.30) -> DataFrame:
    return first_last.where(F.col("delta_pct") > above)


def top_cheaper(first_last: DataFrame, n: int = 20) -> DataFrame:
    return first_last.where("delta_pct < 0").orderBy("delta_pct", "product_id").limit(n)


def inflation_prediction(prices: DataFrame, target: date | str) -> DataFrame:
    """Least-squares line through the weekly mean prices, read off at the target date; one row.

    The weekly table has one row per calendar week, so numbering it in one partition is safe.
    """
    weekly = (
        valid_prices(prices)
        .groupBy(week_start(F.col("valid_date")).alias("week"))
        .agg(exact_avg(F.col("price")).alias("avg_price"))
    )
    numbered = weekly.select(
        "week", "avg_price", (F.row_number().over(Window.orderBy("week")) - 1).cast("double").alias("t")
    )
    fit = (
        numbered.agg(
            F.min("week").alias("history_start_week"),
            F.coalesce(F.regr_slope("avg_price", "t"), F.lit(0.0)).alias("slope_per_week"),
            F.avg("avg_price").alias("mean_price"),
            F.avg("t").alias("mean_t"),
            F.min_by("avg_price", "week").alias("base_avg_price"),
        )
        .where("history_start_week is not null")
        .withColumn("target_date", F.lit(as_date(target)))
        .withColumn("intercept", F.expr("mean_price - slope_per_week * mean_t"))
        .withColumn("weeks_ahead", F.floor(F.datediff("target_date", "history_start_week") / 7))
        .withColumn("predicted_avg_price", F.expr("intercept + slope_per_week * weeks_ahead"))
    )
    return fit.select(
        "history_start_week",
        "target_date",
        "slope_per_week",
        "intercept",
        "base_avg_price",
        "predicted_avg_price",
        F.expr("coalesce(try_divide(predicted_avg_price, base_avg_price) - 1, 0) * 100").alias("inflation_pct"),
    )


def weekly_avg_price_by_category(prices: DataFrame, products: DataFrame) -> DataFrame:
    # Summed by product and week before the join, so that the join moves few rows and has no hot key.
    per_product = (
        valid_prices(prices)
        .groupBy("product_id", week_start(F.col("valid_date")).alias("week_start"))
        .agg(F.sum(to_exact(F.col("price"))).alias("price_sum"), F.count("*").alias("rows"))
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "week_start")
        .agg(F.round(from_exact(F.sum("price_sum")) / F.sum("rows"), 2).alias("avg_price"))
    )


def net_and_tax_per_product(prices: DataFrame, products: DataFrame) -> DataFrame:
    """Tax contained in the latest price of each product, and the price without it."""
    latest = (
        _daily_range(prices)
        .groupBy("product_id")
        .agg(F.max(F.struct("valid_date", F.col("high").alias("price"))).alias("latest"))
        .select(
            "product_id", F.col("latest.price").alias("gross_price"), F.col("latest.valid_date").alias("price_date")
        )
    )
    return (
        latest.join(products.select("product_id", "product_name", "tva_rate"), "product_id")
        .withColumn("tva_amount", F.expr("round(gross_price * tva_rate / (tva_rate + 1), 4)"))
        .withColumn("net_price", F.expr("round(gross_price - tva_amount, 4)"))
        .select("product_id", "product_name", "price_date", "gross_price", "tva_rate", "net_price", "tva_amount")
    )
