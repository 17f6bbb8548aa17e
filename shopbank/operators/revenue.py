"""Revenue with and without discount, and the tax contained in it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopbank.functions.calendar import within_year
from shopbank.functions.money import from_exact, to_exact
from shopbank.functions.rows import having
from shopbank.operators.discounts import valid_discounts
from shopbank.operators.intervals import days_covered, is_covered, week_number


def priced_lines(transactions: DataFrame, year: int | None = None) -> DataFrame:
    lines = having(transactions, "transaction_id", "product_id", "transaction_date", "quantity", "unit_price_at_purchase")
    return lines if year is None else lines.where(within_year(F.col("transaction_date"), year))


def _revenue() -> Column:
    return F.col("quantity") * F.col("unit_price_at_purchase")


def _revenue_exact() -> Column:
    return F.sum(to_exact(_revenue()))


def _with_discount_days(facts: DataFrame, day: Column, discounts: DataFrame) -> DataFrame:
    covered = days_covered(valid_discounts(discounts), "valid_from", "valid_to")
    return facts.withColumn("week", week_number(day)).join(covered, ["product_id", "week"], "left")


def flagged_sales(transactions: DataFrame, discounts: DataFrame) -> DataFrame:
    """Every line once, with its revenue and whether a discount held for its product on its day."""
    day = F.to_date("transaction_date")
    return _with_discount_days(priced_lines(transactions), day, discounts).select(
        "transaction_id",
        "customer_id",
        "product_id",
        "transaction_date",
        "quantity",
        F.col("unit_price_at_purchase").alias("unit_price"),
        _revenue().alias("revenue"),
        is_covered(day).alias("on_discount"),
    )


def revenue_totals(transactions: DataFrame, discounts: DataFrame, year: int) -> DataFrame:
    """Income of a year: all, outside discounts, under discount. Joined by product and week only."""
    daily = (
        priced_lines(transactions, year)
        .groupBy("product_id", F.to_date("transaction_date").alias("day"))
        .agg(_revenue_exact().alias("revenue"))
    )
    of_year = valid_discounts(discounts).withColumns(
        {
            "valid_from": F.greatest("valid_from", F.lit(date(year, 1, 1))),
            "valid_to": F.least("valid_to", F.lit(date(year, 12, 31))),
        }
    )
    on_discount = is_covered(F.col("day"))

    def income(rows: Column) -> Column:
        return F.round(from_exact(F.sum(F.when(rows, F.col("revenue")).otherwise(0))), 2)

    return _with_discount_days(daily, F.col("day"), of_year).agg(
        F.round(from_exact(F.sum("revenue")), 2).alias("total_income"),
        income(~on_discount).alias("income_excl_discount"),
        income(on_discount).alias("income_only_discount"),
    )


def revenue_monthly(transactions: DataFrame, year: int) -> DataFrame:
    return (
        priced_lines(transactions, year)
        .groupBy(F.month("transaction_date").alias("month"))
        .agg(F.round(from_exact(_revenue_exact()), 2).alias("monthly_income"))
    )


def _taxed_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and contained tax per product, as decimals: the join sees one row per product."""
    rates = having(products, "product_id", "tva_rate").select("product_id", "tva_rate")
    sold = lines.groupBy("product_id").agg(_revenue_exact().alias("revenue"))
    contained = F.expr("cast(revenue as double) * tva_rate / (tva_rate + 1)")
    return sold.join(rates, "product_id").select("revenue", to_exact(contained).alias("tva"))


def tax_total(transactions: DataFrame, products: DataFrame, year: int) -> DataFrame:
    taxed = _taxed_products(priced_lines(transactions, year), products)
    return taxed.agg(F.round(from_exact(F.sum("tva")), 2).alias(f"total_tva_{year}"))


def tax_refundable_legal(
    transactions: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    year: int,
    legal_type: str = "persoana_juridica",
) -> DataFrame:
    """Revenue from legal entities and the tax they may reclaim."""
    legal = customers.where(F.col("customer_id").isNotNull() & (F.col("customer_type") == legal_type))
    lines = priced_lines(transactions, year).join(legal.select("customer_id"), "customer_id", "left_semi")
    return _taxed_products(lines, products).agg(
        F.round(from_exact(F.sum("revenue")), 2).alias("legal_entities_revenue"),
        F.round(from_exact(F.sum("tva")), 2).alias("refundable_tva"),
    )
