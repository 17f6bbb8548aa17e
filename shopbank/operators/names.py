"""Names and streets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopbank.functions.contact import street_name
from shopbank.functions.rows import having


def common_streets_by_city(customers: DataFrame, n: int = 5) -> DataFrame:
    counts = (
        having(customers, "customer_id", "address", "city")
        .select("city", street_name(F.col("address")).alias("street_name"))
        .where("street_name <> ''")
        .groupBy("city", "street_name")
        .agg(F.count("*").alias("occurrences"))
    )
    most = Window.partitionBy("city").orderBy(F.desc("occurrences"), "street_name")
    return counts.withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= n)


def common_family_names(customers: DataFrame) -> DataFrame:
    named = having(customers, "customer_id", "last_name")
    return named.groupBy("last_name").agg(F.count("*").alias("occurrences"))


def identical_full_names(customers: DataFrame) -> DataFrame:
    full_name = F.lower(F.concat_ws(" ", "first_name", "last_name"))
    return (
        having(customers, "customer_id", "first_name", "last_name")
        .groupBy(full_name.alias("full_name"))
        .agg(F.count("*").alias("customer_count"))
        .where("customer_count > 1")
    )
