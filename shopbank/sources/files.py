"""Batch readers. Schemas are explicit; a cell that does not fit its type becomes null."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shopbank.sources import schemas

RETAIL = {
    "customers": schemas.CUSTOMERS,
    "products": schemas.PRODUCTS,
    "prices": schemas.PRICES,
    "discounts": schemas.DISCOUNTS,
    "transactions": schemas.TRANSACTIONS,
}
DAILY = {
    "sales": schemas.SALES,
    "accounts": schemas.ACCOUNTS,
    "loans": schemas.LOANS,
    "delay_fees": schemas.DELAY_FEES,
}


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """For files without a known schema; reads them twice."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_json_array(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Files that hold one JSON array each. A file is parsed whole by one task; prefer JSON lines when large."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, such as a static dimension."""
    return spark.read.table(name)


def read_retail(spark: SparkSession, root: str, name: str, file_format: str = "csv") -> DataFrame:
    """A yearly retail table, ``{root}/{name}``."""
    reader = spark.read.schema(RETAIL[name]).option("header", True)
    return reader.format(file_format).load(f"{root.rstrip('/')}/{name}")


def daily_path(root: str, name: str, day: date | str) -> str:
    return f"{root.rstrip('/')}/{name}/{name}_{str(day).replace('-', '_')}.csv"


def read_daily(spark: SparkSession, root: str, name: str, day: date | str) -> DataFrame:
    """A daily bank snapshot, ``{root}/{name}/{name}_YYYY_MM_DD.csv``."""
    return read_csv(spark, daily_path(root, name, day), DAILY[name])
