"""The daily streaming jobs, from source folder to stored result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopbank.functions.money import from_exact, to_exact
from shopbank.sources import schemas
from shopbank.sources.streams import read_day_stream
from shopbank.streaming import operators as ops
from shopbank.streaming import sinks

EVERY = "15 seconds"
ORDER_KEYS = ["event_date", "type"]


def start_order_totals(
    spark: SparkSession, root: str, day: date | str, target: str, checkpoint: str, every: str | None = EVERY
) -> StreamingQuery:
    """Quantity by day and type, as increments of each batch below ``target``."""
    orders = read_day_stream(spark, root, "orders", day, schemas.ORDER_STREAM)
    writer = sinks.increments(target, ORDER_KEYS, F.sum("quantity").alias("total_quantity"))
    return sinks.start_batches(ops.valid_orders(orders, day), writer, checkpoint, every=every)


def order_totals(spark: SparkSession, target: str) -> DataFrame:
    return sinks.summed(spark.read.parquet(target), ORDER_KEYS, "total_quantity")


def join_salts(spark: SparkSession, checkpoint: str, wanted: int = 1) -> int:
    """Into how many tasks the transactions of one client and cell are spread: the first start decides, as the join's state is laid out by it.

    Every salt is a copy of all client updates in the state, so it does not follow the number of tasks.
    """
    return sinks.kept_setting(spark, checkpoint, "salts", wanted)


def _matches(spark: SparkSession, root: str, day: date | str, checkpoint: str, salts: int) -> DataFrame:
    return ops.client_matches(
        read_day_stream(spark, root, "transactions", day, schemas.TRANSACTION_STREAM),
        read_day_stream(spark, root, "clients", day, schemas.CLIENT_STREAM),
        day,
        salts=join_salts(spark, checkpoint, salts),
    )


def start_client_matches(
    spark: SparkSession, root: str, day: date | str, target: str, checkpoint: str, every: str | None = EVERY, salts: int = 1
) -> StreamingQuery:
    """Transactions with the client updates around them, below ``target``."""
    return sinks.start_append(_matches(spark, root, day, checkpoint, salts), target, checkpoint, every)


VERSION_KEY, VERSION_ORDER = ["transaction_id"], ["nearness", "client_time", "client_name", "account_type"]


def nearest_versions(target: str) -> sinks.BatchWriter:
    """Keeps, of the matches of each transaction so far, the one with the client version nearest in time; no other is stored."""
    upsert = sinks.upsert(target, VERSION_KEY, VERSION_ORDER)

    def write(matches: DataFrame, batch_id: int) -> None:
        upsert(matches.withColumn("nearness", ops.nearness()), batch_id)

    return write


def start_client_totals(
    spark: SparkSession, root: str, day: date | str, target: str, checkpoint: str, every: str | None = EVERY, salts: int = 1
) -> StreamingQuery:
    """Transactions with their nearest client version, one row each below ``target``; ``client_totals`` adds them up."""
    return sinks.start_batches(_matches(spark, root, day, checkpoint, salts), nearest_versions(target), checkpoint, every=every)


def client_totals(spark: SparkSession, target: str) -> DataFrame:
    """Amount per client, each transaction counted once."""
    return ops.matched_totals(sinks.latest_rows(spark, target, VERSION_KEY, VERSION_ORDER))


def matched_increments(target: str) -> sinks.BatchWriter:
    """Amount by client version that each batch adds, as exact decimals."""
    return sinks.increments(target, ops.CLIENT_KEYS, F.sum(to_exact(F.col("amount"))).alias("total_amount"))


def start_matched_totals(
    spark: SparkSession, root: str, day: date | str, target: str, checkpoint: str, every: str | None = EVERY, salts: int = 1
) -> StreamingQuery:
    """Amount by day and client version over all matches, as increments of each batch; no match is stored."""
    return sinks.start_batches(_matches(spark, root, day, checkpoint, salts), matched_increments(target), checkpoint, every=every)


def matched_totals(spark: SparkSession, target: str) -> DataFrame:
    totals = sinks.summed(spark.read.parquet(target), ops.CLIENT_KEYS, "total_amount")
    return totals.withColumn("total_amount", from_exact(F.col("total_amount")))
