"""The retail batch jobs: which results belong together and over which tables.

A job is a function from tables and parameters to named results; nothing runs until a result is
written. Frames that several results of a job start from are handed to ``keep``, which persists
them until the job is done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shopbank.functions import categories
from shopbank.operators import (
    baskets,
    customers,
    discounts,
    items,
    names,
    prices,
    products,
    quality,
    recommend,
    revenue,
    trends,
)
from shopbank.sources.files import read_retail

Results = dict[str, DataFrame]
Keep = Callable[[DataFrame], DataFrame]


@dataclass
class Tables:
    customers: DataFrame
    products: DataFrame
    prices: DataFrame
    discounts: DataFrame
    transactions: DataFrame


@dataclass
class Settings:
    year: int
    as_of: date
    forecast_for: date
    email_domain: str
    keyword_rules: Sequence[tuple[str, str]] = field(default_factory=lambda: categories.KEYWORD_RULES)
    restricted: Sequence[str] = field(default_factory=lambda: categories.RESTRICTED)


def read_tables(spark: SparkSession, root: str, file_format: str = "csv") -> Tables:
    return Tables(*[read_retail(spark, root, name, file_format) for name in Tables.__dataclass_fields__])


def data_preparation(t: Tables, s: Settings, keep: Keep) -> Results:
    # The grid is far larger than the prices it comes from, so it is made twice rather than kept.
    return {
        "customers_clean": customers.clean_customers(t.customers),
        "missing_prices": prices.missing_prices(t.prices, t.products),
        "prices_filled": prices.filled_prices(t.prices, t.products),
    }


def price_change_behavior(t: Tables, s: Settings, keep: Keep) -> Results:
    ends = keep(prices.first_and_last_prices(t.prices))
    return {
        "frequent_changes": prices.frequent_price_changes(t.prices, s.year),
        "never_decreased": prices.never_decreased(t.prices, s.year),
        "increase_before_discount": prices.increase_before_discount(t.prices, t.discounts),
        "over_30_increase": prices.price_increases(ends),
        "top20_cheaper": prices.top_cheaper(ends),
        "inflation_prediction": prices.inflation_prediction(t.prices, s.forecast_for),
    }


def price_aggregations(t: Tables, s: Settings, keep: Keep) -> Results:
    return {
        "weekly_avg_per_category": prices.weekly_avg_price_by_category(t.prices, t.products),
        "net_and_tva_per_product": prices.net_and_tax_per_product(t.prices, t.products),
    }


def category_inference(t: Tables, s: Settings, keep: Keep) -> Results:
    return {
        "inferred_categories": products.inferred_categories(t.products, s.keyword_rules),
        "age_restricted_categories": products.age_restricted_categories(t.products, s.restricted),
    }


def discount_analysis(t: Tables, s: Settings, keep: Keep) -> Results:
    purchases = keep(discounts.purchases_during_discount(t.transactions, t.discounts))
    return {
        "avg_discount_per_week": discounts.avg_discount_per_week(t.discounts),
        "discounts_per_category": discounts.discounts_per_category(t.discounts, t.products, s.year),
        "frequent_discount_products": discounts.frequent_discount_products(t.discounts),
        "discounted_prices": discounts.discounted_prices(t.discounts, t.prices),
        "purchases_during_discount": purchases,
        "never_purchased_while_discounted": discounts.never_purchased_discounted(t.discounts, purchases),
        "missed_savings_non_fidelity": discounts.missed_savings(t.transactions, t.discounts, t.prices, t.customers),
    }


def customer_demographics(t: Tables, s: Settings, keep: Keep) -> Results:
    ages = keep(customers.customer_ages(t.customers, s.as_of))
    tenure = customers.card_tenure(ages, s.as_of)
    return {
        "age_group_by_city": customers.age_group_by_city(ages),
        "youngest_oldest_per_city": customers.youngest_oldest_by_city(ages),
        "avg_age_per_city": customers.avg_age_by_city(ages),
        "avg_age_by_fidelity_type": customers.avg_age_by_card_type(ages),
        "underage_count": customers.underage_count(ages),
        "fidelity_tenure": tenure,
        "top5_longest_per_city": customers.top_tenure_by_city(tenure),
        "card_before_25": customers.card_before_25(ages),
    }


def customer_data_quality(t: Tables, s: Settings, keep: Keep) -> Results:
    profile = keep(quality.profile_customers(t.customers, s.as_of))
    return {
        "missing_address_by_fidelity": quality.missing_address_by_card(profile),
        "missing_phone_email_counts": quality.missing_contact_counts(profile),
        "phone_prefix_share": quality.phone_prefix_share(profile),
        "phone_any_share": quality.phone_any_share(profile),
        "age_group_most_missing_phone": quality.age_group_missing_phone(profile),
        "email_providers": quality.email_providers(profile),
        "email_domain_age_stats": quality.email_domain_age_stats(profile, s.email_domain),
    }


def customer_names_addresses(t: Tables, s: Settings, keep: Keep) -> Results:
    return {
        "common_streets_per_city": names.common_streets_by_city(t.customers),
        "common_family_names": names.common_family_names(t.customers),
        "identical_full_names": names.identical_full_names(t.customers),
    }


def customer_metrics(t: Tables, s: Settings, keep: Keep) -> Results:
    return {
        "total_products_per_customer": baskets.products_per_customer(t.transactions),
        "avg_basket_by_payment": baskets.basket_by_payment(t.transactions),
        "fidelity_vs_non_fidelity": baskets.card_vs_no_card(t.transactions, t.customers),
        "top10_spenders": baskets.top_spenders(t.transactions, s.year),
        "top10_buyers_by_items": baskets.top_buyers(t.transactions, s.year),
        "underage_age_restricted": baskets.underage_restricted(
            t.transactions, t.customers, t.products, s.as_of, s.restricted
        ),
    }


def item_metrics(t: Tables, s: Settings, keep: Keep) -> Results:
    return {
        "most_purchased_products": items.most_purchased(t.transactions),
        "frequently_bought_together": items.bought_together(t.transactions),
        "top10_december": items.top_of_month(t.transactions),
        "category_with_most_discounts": discounts.discounts_per_category(t.discounts, t.products),
    }


def temporal_trends(t: Tables, s: Settings, keep: Keep) -> Results:
    lines = keep(
        trends.lines_of_year(t.transactions, s.year).select(
            "transaction_id", "customer_id", "transaction_date", "quantity"
        )
    )
    return {
        "closure_days": trends.closure_days(lines, s.year),
        "busiest_month": trends.busiest_month(lines),
        "top10_days": trends.top_days(lines),
        "peak_hour_per_day": trends.peak_hour_per_day(lines),
        "hourly_item_stats": trends.hourly_item_stats(lines),
        "max_tx_open_close": trends.max_tx_open_close(lines),
        "daily_distribution": trends.daily_distribution(lines),
        "friday_trends": trends.friday_trends(lines),
    }


def financial_revenue(t: Tables, s: Settings, keep: Keep) -> Results:
    return {
        "totals": revenue.revenue_totals(t.transactions, t.discounts, s.year),
        "monthly": revenue.revenue_monthly(t.transactions, s.year),
        "total_tva": revenue.tax_total(t.transactions, t.products, s.year),
        "refundable_tva_legal_entities": revenue.tax_refundable_legal(
            t.transactions, t.products, t.customers, s.year
        ),
    }


def recommendations(t: Tables, s: Settings, keep: Keep) -> Results:
    return {"next_product_recommendations": recommend.next_products(t.transactions, t.products)}


JOBS: dict[str, Callable[[Tables, Settings, Keep], Results]] = {
    job.__name__: job
    for job in (
        data_preparation,
        price_change_behavior,
        price_aggregations,
        category_inference,
        discount_analysis,
        customer_demographics,
        customer_data_quality,
        customer_names_addresses,
        customer_metrics,
        item_metrics,
        temporal_trends,
        financial_revenue,
        recommendations,
    )
}


def run(job: str, tables: Tables, settings: Settings, write: Callable[[DataFrame, str], None]) -> list[str]:
    """Writes every result of a job with ``write(frame, name)``; returns the names."""
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return kept[-1]

    results = JOBS[job](tables, settings, keep)
    try:
        for name, frame in results.items():
            write(frame, name)
    finally:
        for frame in kept:
            frame.unpersist()
    return list(results)
