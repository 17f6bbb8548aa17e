"""Customer-level purchase metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.functions.calendar import as_date, completed_years, within_year
from shopbank.functions.categories import RESTRICTED
from shopbank.functions.money import from_exact, to_exact
from shopbank.functions.rows import having


def _lines(transactions: DataFrame) -> DataFrame:
    return having(transactions, "customer_id", "product_id", "quantity", "transaction_id")


def _spent_exact():
    return F.sum(to_exact(F.col("quantity") * F.col("unit_price_at_purchase")))


def products_per_customer(transactions: DataFrame) -> DataFrame:
    return (
        _lines(transactions)
        .groupBy("customer_id")
        .agg(
            F.sum("quantity").alias("total_items"),
            F.count_distinct("product_id").alias("distinct_products"),
            F.count_distinct("transaction_id").alias("transactions"),
        )
    )


def basket_by_payment(transactions: DataFrame) -> DataFrame:
    """Mean items and amount of a basket, by payment method."""
    baskets = (
        _lines(transactions)
        .where("payment_method is not null")
        .groupBy("transaction_id", "payment_method")
        .agg(F.sum("quantity").alias("items"), _spent_exact().alias("amount"))
    )
    return baskets.groupBy("payment_method").agg(
        F.round(F.avg("items"), 2).alias("avg_items_per_basket"),
        F.round(F.try_divide(from_exact(F.sum("amount")), F.count("amount")), 2).alias("avg_amount_per_basket"),
        F.count("*").alias("baskets"),
    )


def card_vs_no_card(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers, spend and items of buyers with and without a card.

    Reduced to one row per buyer before the join, so a hot customer is gone before any row is moved
    for it and the customers need no distinct count.
    """
    buyers = (
        _lines(transactions)
        .groupBy("customer_id")
        .agg(_spent_exact().alias("spent"), F.sum("quantity").alias("items"))
    )
    owns_card = customers.where("customer_id is not null").select(
        "customer_id",
        F.when(F.col("fidelity_card").isNotNull(), "fidelity").otherwise("no_fidelity").alias("group"),
    )
    return (
        buyers.join(owns_card, "customer_id")
        .groupBy("group")
        .agg(
            F.count("*").alias("customers"),
            from_exact(F.sum("spent")).alias("total_spent"),
            F.sum("items").alias("total_items"),
        )
        .withColumn("avg_spent_per_customer", F.expr("round(total_spent / customers, 2)"))
    )


def top_spenders(transactions: DataFrame, year: int, n: int = 10) -> DataFrame:
    return (
        _lines(transactions)
        .where(within_year(F.col("transaction_date"), year))
        .groupBy("customer_id")
        .agg(F.round(from_exact(_spent_exact()), 2).alias("total_spent"))
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(n)
    )


def top_buyers(transactions: DataFrame, year: int, n: int = 10) -> DataFrame:
    return (
        _lines(transactions)
        .where(within_year(F.col("transaction_date"), year))
        .groupBy("customer_id")
        .agg(F.sum("quantity").alias("total_items"))
        .orderBy(F.desc("total_items"), "customer_id")
        .limit(n)
    )


def top_customers(transactions: DataFrame, n: int = 100) -> DataFrame:
    """Text lines ``customer|total`` of the customers who spent most."""
    priced = having(transactions, "customer_id", "quantity", "unit_price_at_purchase")
    totals = priced.groupBy("customer_id").agg(from_exact(_spent_exact()).alias("total_spent"))
    line = F.concat_ws("|", "customer_id", F.col("total_spent").cast("string"))
    return totals.orderBy(F.desc("total_spent"), "customer_id").limit(n).select(line.alias("value"))


def underage_restricted(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    as_of: date | str,
    restricted: Sequence[str] = RESTRICTED,
) -> DataFrame:
    """Units of restricted categories bought by minors."""
    age = completed_years(F.col("birth_date"), F.lit(as_date(as_of)))
    minors = customers.where("customer_id is not null").where(age < 18).select("customer_id")
    listed = products.where(F.col("category").isin(list(restricted))).select("product_id", "category")
    # One row per customer and category is left before the customers are compared.
    bought = (
        _lines(transactions)
        .join(listed, "product_id")
        .groupBy("customer_id", "category")
        .agg(F.sum("quantity").alias("items_bought"))
    )
    return bought.join(minors, "customer_id", "left_semi")
