"""Streaming readers. ``files_per_batch`` bounds what a restart after a long pause takes in at once."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_day_stream(
    spark: SparkSession,
    root: str,
    name: str,
    day: date | str,
    schema: str | StructType,
    files_per_batch: int | None = None,
) -> DataFrame:
    """CSV files as they arrive in ``{root}/{name}/date=YYYY-MM-DD``."""
    reader = spark.readStream.schema(schema).option("header", True).option("pathGlobFilter", "*.csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(f"{root.rstrip('/')}/{name}/date={day}")


def read_parquet_stream(
    spark: SparkSession,
    folder: str,
    schema: str | StructType,
    files: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
