"""Product catalogue: categories and the daily product table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.functions import categories as C
from shopbank.functions.calendar import day_in_week, week_start
from shopbank.functions.rows import having


def inferred_categories(
    products: DataFrame, rules: Sequence[tuple[str, str]] = C.KEYWORD_RULES, unsorted: str = C.UNSORTED
) -> DataFrame:
    """Category of unsorted products from their name; null when no rule fits."""
    inferred = F.when(F.col("category") == unsorted, C.category_by_keyword(F.col("product_name"), rules))
    return products.where("product_id is not null").select(
        "product_id",
        "product_name",
        F.col("category").alias("original_category"),
        F.when(F.col("category") == unsorted, inferred).otherwise(F.col("category")).alias("inferred_category"),
    )


def age_restricted_categories(products: DataFrame, restricted: Sequence[str] = C.RESTRICTED) -> DataFrame:
    """The categories of the catalogue that may not be sold to minors."""
    return products.where(F.col("category").isin(list(restricted))).select("category").distinct()


def daily_products(products: DataFrame, prices: DataFrame) -> DataFrame:
    """Each recorded price with its product and its place in the business week."""
    day = F.col("valid_date")
    return (
        having(prices, "product_id", "valid_date")
        .select("product_id", "valid_date", "price")
        .join(products.where("product_id is not null"), "product_id")
        .withColumns({"week_start": week_start(day), "day_in_week": day_in_week(day)})
    )
