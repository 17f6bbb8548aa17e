"""Discounts: frequency, discounted prices, purchases inside and outside the discount weeks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.functions.calendar import week_start, within_year
from shopbank.functions.money import exact_avg, from_exact, to_exact
from shopbank.functions.rows import having
from shopbank.operators.intervals import days_in_windows
from shopbank.operators.prices import valid_prices


def valid_discounts(discounts: DataFrame) -> DataFrame:
    return having(discounts, "product_id", "valid_from", "valid_to")


def avg_discount_per_week(discounts: DataFrame) -> DataFrame:
    return (
        valid_discounts(discounts)
        .groupBy(week_start(F.col("valid_from")).alias("week_start"))
        .agg(F.round(exact_avg(F.col("discount_percentage")), 4).alias("avg_discount_pct"))
    )


def discounts_per_category(discounts: DataFrame, products: DataFrame, year: int | None = None) -> DataFrame:
    """Number of discounts by category, of one year or of all."""
    chosen = discounts.where("product_id is not null")
    if year is not None:
        chosen = valid_discounts(chosen).where(within_year(F.col("valid_from"), year))
    per_product = chosen.groupBy("product_id").agg(F.count("*").alias("events"))
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("events").alias("discount_events"))
    )


def frequent_discount_products(discounts: DataFrame, at_least: int = 3) -> DataFrame:
    return (
        valid_discounts(discounts)
        .groupBy("product_id")
        .agg(F.count("*").alias("discount_count"))
        .where(F.col("discount_count") >= at_least)
    )


def discounted_prices(discounts: DataFrame, prices: DataFrame) -> DataFrame:
    """Price on the first day of each discount, with a card (whole discount) and without (half)."""
    on_first_day = valid_prices(prices).select(
        "product_id", F.col("valid_date").alias("valid_from"), F.col("price").alias("gross_price")
    )
    return valid_discounts(discounts).join(on_first_day, ["product_id", "valid_from"]).select(
        "discount_id",
        "product_id",
        "valid_from",
        "valid_to",
        "discount_percentage",
        "gross_price",
        F.expr("round(gross_price * (1 - discount_percentage), 2)").alias("price_with_fidelity"),
        F.expr("round(gross_price * (1 - discount_percentage * 0.5D), 2)").alias("price_without_fidelity"),
    )


def purchases_during_discount(transactions: DataFrame, discounts: DataFrame) -> DataFrame:
    """Lines and units bought within each discount window; discounts without purchases are absent."""
    daily = (
        having(transactions, "product_id", "transaction_date", "customer_id")
        .groupBy("product_id", F.to_date("transaction_date").alias("day"))
        .agg(F.count("*").alias("lines"), F.sum("quantity").alias("units"))
    )
    window = ["product_id", "valid_from", "valid_to"]
    listed = valid_discounts(discounts).groupBy("discount_id", *window).agg(F.count("*").alias("copies"))
    # Each distinct window meets the days once, however many discounts share it.
    windows = valid_discounts(discounts).select(window).distinct()
    bought = (
        days_in_windows(daily, "day", windows, F.col("valid_from"), F.col("valid_to"))
        .groupBy(window)
        .agg(F.sum("lines").alias("lines"), F.sum("units").alias("units"))
    )
    return listed.join(bought, window).select(
        "discount_id",
        *window,
        (F.col("lines") * F.col("copies")).alias("purchase_count"),
        (F.col("units") * F.col("copies")).alias("units_sold"),
    )


def never_purchased_discounted(discounts: DataFrame, purchases: DataFrame) -> DataFrame:
    """Discounted products without a line in ``purchases``, the result of the operator above."""
    return (
        valid_discounts(discounts)
        .select("product_id")
        .distinct()
        .join(purchases.select("product_id"), "product_id", "left_anti")
    )


def missed_savings(
    transactions: DataFrame, discounts: DataFrame, prices: DataFrame, customers: DataFrame
) -> DataFrame:
    """What customers without a card would have saved with one; overlapping discounts all count."""
    cardless = customers.where("customer_id is not null and fidelity_card is null").select("customer_id")
    bought = (
        having(transactions, "product_id", "transaction_date", "customer_id")
        .join(cardless, "customer_id", "left_semi")
        .groupBy("product_id", F.to_date("transaction_date").alias("day"))
        .agg(F.sum("quantity").alias("quantity"))
    )
    price = (
        valid_prices(prices)
        .groupBy("product_id", F.col("valid_date").alias("day"))
        .agg(F.sum(to_exact(F.col("price"))).alias("price_sum"))
    )
    windows = valid_discounts(discounts).select("product_id", "valid_from", "valid_to", "discount_percentage")
    saved = F.expr("cast(price_sum as double) * discount_percentage * 0.5D * quantity")
    return days_in_windows(
        bought.join(price, ["product_id", "day"]), "day", windows, F.col("valid_from"), F.col("valid_to")
    ).agg(F.round(from_exact(F.sum(to_exact(saved))), 2).alias("total_missed_savings"))
