"""Next-product recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopbank.functions.rows import having


def _rank(df: DataFrame, group: str, *order: Column | str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def next_products(
    transactions: DataFrame,
    products: DataFrame,
    top_categories: int = 3,
    per_category: int = 10,
    per_customer: int = 5,
    salts: int = 32,
) -> DataFrame:
    """Popular products of each customer's favourite categories which the customer has not bought yet.

    The transactions are read and shuffled once, into units per customer and product; favourites,
    popularity and the exclusion all start from that table. Every limit is applied before the
    shuffle of its ranking (row_number filters become group limits). There are few categories and
    many customers, so the customers of a category are spread over ``salts`` tasks, each with a copy
    of the category's few popular products.
    """
    bought = (
        having(transactions, "customer_id", "product_id", "quantity")
        .groupBy("customer_id", "product_id")
        .agg(F.sum("quantity").alias("units"))
    )
    listed = having(products, "product_id", "category").select("product_id", "category")

    by_category = bought.join(listed, "product_id").groupBy("customer_id", "category").agg(F.sum("units").alias("units"))
    favourites = (
        _rank(by_category, "customer_id", F.desc("units"), "category")
        .where(F.col("rank") <= top_categories)
        .select("customer_id", "category")
    )

    sold = bought.groupBy("product_id").agg(F.sum("units").alias("popularity")).join(listed, "product_id")
    popular = (
        _rank(sold, "category", F.desc("popularity"), "product_id")
        .where(F.col("rank") <= per_category)
        .select("category", "product_id", "popularity")
    )

    # A left join with a null test keeps the units column, and with it the shared shuffle of ``bought``.
    salted = favourites.withColumn("salt", F.pmod(F.hash("customer_id"), F.lit(salts)))
    copies = popular.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    fresh = (
        salted.join(copies, ["category", "salt"])
        .drop("salt")
        .join(bought, ["customer_id", "product_id"], "left")
        .where("units is null")
    )
    return (
        _rank(fresh, "customer_id", F.desc("popularity"), "product_id")
        .where(F.col("rank") <= per_customer)
        .select("customer_id", "category", "product_id", "popularity", F.col("rank").alias("recommendation_rank"))
    )
