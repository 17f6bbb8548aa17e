"""Data quality of the customer table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.functions import contact
from shopbank.functions.calendar import as_date, completed_years
from shopbank.functions.categories import age_group


def profile_customers(customers: DataFrame, as_of: date | str) -> DataFrame:
    """The base of the operators below; customers without a birth date stay in."""
    age = completed_years(F.col("birth_date"), F.lit(as_date(as_of)))
    return customers.where("customer_id is not null").withColumns(
        {
            "fidelity_type": contact.card(F.col("fidelity_card"))["type"],
            "age_years": age,
            "age_group": age_group(age),
            "email_provider": contact.email_domain(F.col("email")),
            "phone_has_country_prefix": contact.has_country_prefix(F.col("phone_number")),
        }
    )


def missing_address_by_card(profile: DataFrame) -> DataFrame:
    return profile.groupBy(F.coalesce("fidelity_type", F.lit("no_card")).alias("fidelity_type")).agg(
        F.count("*").alias("total"), F.count_if(F.col("address").isNull()).alias("missing_address")
    )


def missing_contact_counts(profile: DataFrame) -> DataFrame:
    no_phone, no_email = F.col("phone_number").isNull(), F.col("email").isNull()
    return profile.agg(
        F.count("*").alias("total_customers"),
        F.count_if(no_phone).alias("missing_phone"),
        F.count_if(no_email).alias("missing_email"),
        F.count_if(no_phone & no_email).alias("missing_both"),
    )


def phone_prefix_share(profile: DataFrame) -> DataFrame:
    counts = profile.agg(
        F.count("phone_number").alias("customers_with_phone"),
        F.count_if("phone_has_country_prefix").alias("with_country_prefix"),
    )
    return counts.withColumn("ratio_with_prefix", F.try_divide("with_country_prefix", "customers_with_phone"))


def phone_any_share(profile: DataFrame) -> DataFrame:
    counts = profile.agg(
        F.count("*").alias("total_customers"), F.count("phone_number").alias("customers_with_phone")
    )
    return counts.withColumn("ratio_with_phone", F.try_divide("customers_with_phone", "total_customers"))


def age_group_missing_phone(profile: DataFrame) -> DataFrame:
    return (
        profile.where("phone_number is null").groupBy("age_group").agg(F.count("*").alias("missing_phone_count"))
    )


def email_providers(profile: DataFrame) -> DataFrame:
    return (
        profile.where("email_provider is not null")
        .groupBy("email_provider")
        .agg(F.count("*").alias("customer_count"))
    )


def email_domain_age_stats(profile: DataFrame, domain: str) -> DataFrame:
    return profile.where(F.col("email_provider") == domain).agg(
        F.count("*").alias("customers"),
        F.avg("age_years").alias("avg_age"),
        F.stddev_samp("age_years").alias("stddev_age"),
    )
