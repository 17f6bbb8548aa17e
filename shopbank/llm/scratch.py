"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopbank.session import scratch_path


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """The rows of ``df``, written once as Parquet below ``spark.checkpoint.dir`` and read from there.

    It cuts the lineage, and a lost executor costs no more than reading again. The files go when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
