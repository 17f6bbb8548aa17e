"""Product-level purchase metrics."""

from __future__ import annotations

from calendar import month_name

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.functions.calendar import within_year
from shopbank.functions.rows import having

# Distinct products a basket may hold before its pairs are shared out over several tasks.
BLOCK = 500


def _lines(transactions: DataFrame) -> DataFrame:
    return having(transactions, "transaction_id", "product_id", "quantity", "transaction_date")


def most_purchased(transactions: DataFrame) -> DataFrame:
    return (
        _lines(transactions)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("total_units"), F.count_distinct("transaction_id").alias("transactions"))
    )


def bought_together(transactions: DataFrame, block: int = BLOCK) -> DataFrame:
    """In how many baskets each pair of products occurs together.

    A basket of n products has n*(n-1)/2 pairs, all of which belong to the result. Ordinary baskets
    are joined with themselves on the transaction. A basket of more than ``block`` products is cut
    into k blocks by product hash, and each of the k*k block pairs gets a join key of its own, so
    that no key compares more than about block*block products. Pairs are counted map-side in the
    stage of the join; only counts are shuffled. Without large baskets, adaptive execution drops
    the second branch once their list turns out empty.
    """
    items = _lines(transactions).select("transaction_id", "product_id").distinct()
    large = (
        items.groupBy("transaction_id")
        .agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        .where("blocks > 1")
    )
    ordinary = items.join(large.select("transaction_id"), "transaction_id", "left_anti")
    pairs = ordinary.withColumnRenamed("product_id", "product_a").join(
        ordinary.withColumnRenamed("product_id", "product_b"), "transaction_id"
    )

    placed = items.join(large, "transaction_id").withColumn("block", F.pmod(F.hash("product_id"), F.col("blocks")))
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    block_pairs = placed.select(
        "transaction_id", F.col("product_id").alias("product_a"), F.col("block").alias("i"), every_block.alias("j")
    ).join(
        placed.select(
            "transaction_id", F.col("product_id").alias("product_b"), every_block.alias("i"), F.col("block").alias("j")
        ),
        ["transaction_id", "i", "j"],
    )
    return (
        pairs.select("product_a", "product_b")
        .unionByName(block_pairs.select("product_a", "product_b"))
        .where("product_a < product_b")
        .groupBy("product_a", "product_b")
        .agg(F.count("*").alias("co_occurrences"))
    )


def top_of_month(transactions: DataFrame, month: int = 12, n: int = 10, year: int | None = None) -> DataFrame:
    """Products with most units in a calendar month, of one year or of all: ``units_in_december`` and so on."""
    units = f"units_in_{month_name[month].lower()}"
    lines = _lines(transactions)
    if year is not None:
        lines = lines.where(within_year(F.col("transaction_date"), year))
    return (
        lines.where(F.month("transaction_date") == month)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias(units))
        .orderBy(F.desc(units), "product_id")
        .limit(n)
    )
