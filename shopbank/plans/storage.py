"""The storage-layout job: products by business week and the list of top customers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopbank.operators.baskets import top_customers
from shopbank.operators.products import daily_products
from shopbank.sinks import files


def store_products_and_top_customers(
    products: DataFrame, prices: DataFrame, transactions: DataFrame, root: str, n: int = 100
) -> None:
    daily = daily_products(products, prices)
    files.write_weekly_parquet(daily, f"{root}/products_parquet")
    files.write_weekly_csv(daily, f"{root}/products_csv")
    files.write_text(top_customers(transactions, n), f"{root}/top_customers")
