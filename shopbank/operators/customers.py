"""Customers: cleaning, age and card demographics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopbank.functions import contact
from shopbank.functions.calendar import as_date, completed_years
from shopbank.functions.categories import age_group
from shopbank.functions.rows import having


def clean_customers(customers: DataFrame) -> DataFrame:
    """Parsed card, address parts, normalised phone and carrier. No row is dropped."""
    address, phone = F.col("address"), F.col("phone_number")
    return customers.select(
        "customer_id",
        "first_name",
        "last_name",
        "birth_date",
        "email",
        "phone_number",
        contact.normalized_phone(phone).alias("phone_normalized"),
        contact.mobile_carrier(phone).alias("mobile_operator"),
        "address",
        contact.street_type(address).alias("street_type"),
        contact.street_name(address).alias("street_name"),
        contact.street_number(address).alias("street_number"),
        "city",
        "fidelity_card",
        contact.card(F.col("fidelity_card")).alias("fidelity_card_struct"),
        "customer_type",
    )


def customer_ages(customers: DataFrame, as_of: date | str) -> DataFrame:
    """Customers with a birth date, with card type, issue date, age and age group."""
    today = F.lit(as_date(as_of))
    return (
        having(customers, "customer_id", "birth_date")
        .withColumn("card", contact.card(F.col("fidelity_card")))
        .withColumn("fidelity_type", F.col("card.type"))
        .withColumn("fidelity_issue_date", F.col("card.issue_date").try_cast("date"))
        .withColumn("age_years", completed_years(F.col("birth_date"), today))
        .withColumn("age_group", age_group(F.col("age_years")))
        .drop("card")
    )


def age_group_by_city(ages: DataFrame) -> DataFrame:
    return ages.where("city is not null").groupBy("city", "age_group").agg(F.count("*").alias("customer_count"))


def youngest_oldest_by_city(ages: DataFrame) -> DataFrame:
    """Equal birth dates are settled by the customer id."""
    person = F.struct("birth_date", "customer_id", "age_years")
    ends = (
        ages.where("city is not null")
        .groupBy("city")
        .agg(F.max(person).alias("youngest"), F.min(person).alias("oldest"))
    )
    return ends.select(
        "city",
        F.col("youngest.customer_id").alias("youngest_customer_id"),
        F.col("youngest.birth_date").alias("youngest_birth_date"),
        F.col("youngest.age_years").alias("youngest_age"),
        F.col("oldest.customer_id").alias("oldest_customer_id"),
        F.col("oldest.birth_date").alias("oldest_birth_date"),
        F.col("oldest.age_years").alias("oldest_age"),
    )


def avg_age_by_city(ages: DataFrame) -> DataFrame:
    return ages.where("city is not null").groupBy("city").agg(F.avg("age_years").alias("avg_age"))


def avg_age_by_card_type(ages: DataFrame) -> DataFrame:
    return ages.where("fidelity_type is not null").groupBy("fidelity_type").agg(F.avg("age_years").alias("avg_age"))


def underage_count(ages: DataFrame) -> DataFrame:
    return ages.agg(F.count_if(F.col("age_group") == "underage").alias("underage_customers"))


def card_tenure(ages: DataFrame, as_of: date | str) -> DataFrame:
    tenure = completed_years(F.col("fidelity_issue_date"), F.lit(as_date(as_of)))
    return ages.where("fidelity_issue_date is not null").select(
        "customer_id", "city", "fidelity_type", "fidelity_issue_date", tenure.alias("tenure_years")
    )


def top_tenure_by_city(tenure: DataFrame, n: int = 5) -> DataFrame:
    """The longest held cards per city; equal tenures are settled by issue date and customer id."""
    longest = Window.partitionBy("city").orderBy(F.desc("tenure_years"), "fidelity_issue_date", "customer_id")
    return tenure.withColumn("rank", F.row_number().over(longest)).where(F.col("rank") <= n)


def card_before_25(ages: DataFrame) -> DataFrame:
    at_issue = completed_years(F.col("birth_date"), F.col("fidelity_issue_date"))
    return ages.where("fidelity_issue_date is not null").select(
        "customer_id",
        "birth_date",
        "fidelity_issue_date",
        at_issue.alias("age_at_issue"),
        (at_issue < 25).alias("got_card_before_25"),
    )
