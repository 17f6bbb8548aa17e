"""Operators on unbounded tables. They also run on batch frames, where watermarks have no effect."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopbank.functions.calendar import on_day
from shopbank.functions.money import exact_sum


def with_event_time(df: DataFrame, column: str, day: date | str | None = None) -> DataFrame:
    """``event_time`` as a timestamp and ``event_date``, optionally of one day only."""
    timed = df.withColumn("event_time", F.col(column).try_cast("timestamp")).where("event_time is not null")
    if day is not None:
        timed = timed.where(on_day(F.col("event_time"), day))
    return timed.withColumn("event_date", F.to_date("event_time"))


def deduplicated(df: DataFrame, key: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key. A key is remembered for ``delay`` of event time, then its state goes."""
    return df.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])


def valid_orders(orders: DataFrame, day: date | str | None = None, delay: str = "1 day") -> DataFrame:
    """Complete orders, each once: event_date, type, quantity."""
    complete = orders.where("order_id is not null and type is not null and quantity >= 0")
    return deduplicated(with_event_time(complete, "date", day), "order_id", delay).select(
        "event_date", "type", "quantity"
    )


#: Length of a cell of event time, in units of ``within``.
CELL = 4


def cells_near(time: Column, within: str, reach: int) -> Column:
    """The cells of event time from ``reach`` times ``within`` before a time to as much after it."""
    length = F.expr(f"unix_micros(timestamp_micros(0) + interval {within})")
    first, last = (F.floor((F.unix_micros(time) + F.lit(x * reach) * length) / (length * CELL)) for x in (-1, 1))
    return F.sequence(first, last)


def client_matches(
    transactions: DataFrame,
    clients: DataFrame,
    day: date | str | None = None,
    within: str = "5 minutes",
    delay: str = "10 minutes",
    salts: int = 1,
) -> DataFrame:
    """Each transaction with every client update at most ``within`` before or after it.

    A streaming join holds both sides in its state and compares each row with all rows of its key. The key is
    therefore (client, cell of event time): a transaction lies in one cell of four times ``within``, an update goes to the
    one or two cells in its reach, half as many copies as updates. A client's rows of different times are different
    tasks' work, so it does not matter how much history is kept or caught up with. Streaming joins have no skew handling
    of their own: for a client too busy for one task within a single cell, ``salts`` spreads its transactions
    further, at the price of as many copies of all updates. ``within`` is a fixed length, so no months.
    """
    left = (
        with_event_time(
            transactions.where("transaction_id is not null and client_id is not null and amount is not null"),
            "timestamp",
            day,
        )
        .withWatermark("event_time", delay)
        .select(
            "event_date",
            "transaction_id",
            "client_id",
            "amount",
            F.col("event_time").alias("transaction_time"),
            F.get(cells_near(F.col("event_time"), within, 0), F.lit(0)).alias("cell"),
            F.pmod(F.hash("transaction_id"), F.lit(salts)).alias("salt"),
        )
    )
    right = (
        with_event_time(
            clients.where("client_id is not null and client_name is not null and account_type is not null"),
            "updated_at",
            day,
        )
        .withWatermark("event_time", delay)
        .select("*", F.explode(cells_near(F.col("event_time"), within, 1)).alias("_cell"))
        .select(
            F.col("client_id").alias("_client"),
            "client_name",
            "account_type",
            F.col("event_time").alias("client_time"),
            "_cell",
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        )
    )
    near = F.expr(
        f"client_id = _client and cell = _cell and salt = _salt "
        f"and client_time between transaction_time - interval {within} and transaction_time + interval {within}"
    )
    return left.join(right, near).drop("_client", "cell", "_cell", "salt", "_salt")


CLIENT_KEYS = ["event_date", "client_id", "client_name", "account_type"]


def nearness() -> Column:
    """Orders the matches of a transaction: the larger, the nearer the client version lies in time."""
    return -F.abs(F.unix_micros("client_time") - F.unix_micros("transaction_time"))


def client_totals(matches: DataFrame) -> DataFrame:
    """Amount per client from stored matches, each transaction counted once (batch).

    A transaction belongs to the client version nearest in time, the later one if two are equally near.
    """
    version = F.struct(nearness(), F.col("client_time"), "client_name", "account_type")
    chosen = matches.groupBy("transaction_id", "event_date", "client_id", "amount").agg(
        F.max(F.struct(version.alias("order"), "client_name", "account_type")).alias("version")
    )
    return (
        chosen.select("event_date", "client_id", "version.client_name", "version.account_type", "amount")
        .groupBy(*CLIENT_KEYS)
        .agg(exact_sum(F.col("amount")).alias("total_amount"))
    )


def matched_totals(matches: DataFrame) -> DataFrame:
    """Amount per client over all matches: a transaction counts once for every update near it."""
    return matches.groupBy(*CLIENT_KEYS).agg(exact_sum(F.col("amount")).alias("total_amount"))


def tumbling_totals(
    events: DataFrame, key: str, value: str, size: str = "10 minutes", delay: str = "30 minutes"
) -> DataFrame:
    return (
        events.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", size), key)
        .agg(exact_sum(F.col(value)).alias("total"), F.count("*").alias("events"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "total", "events")
    )


def sliding_counts(
    events: DataFrame, size: str = "10 minutes", slide: str = "2 minutes", delay: str = "30 minutes"
) -> DataFrame:
    return (
        events.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", size, slide))
        .agg(F.count("*").alias("events"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "events")
    )


def session_totals(
    events: DataFrame, key: str, value: str, gap: str = "15 minutes", delay: str = "1 hour"
) -> DataFrame:
    """Total per session of a key; a session ends after ``gap`` without an event."""
    return (
        events.withWatermark("event_time", delay)
        .groupBy(F.session_window("event_time", gap).alias("session"), key)
        .agg(exact_sum(F.col(value)).alias("total"), F.count("*").alias("events"))
        .select(F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), key, "total", "events")
    )


def with_static(events: DataFrame, dimension: DataFrame, key: str, salts: int = 1) -> DataFrame:
    """Stream rows with their row of a static table, or nulls.

    Without a hint Spark broadcasts the table only while it is below the broadcast threshold. For a
    larger one, ``salts`` spreads the rows of a hot key over that many tasks.
    """
    if salts == 1:
        return events.join(dimension, key, "left")
    salted = events.withColumn("salt", F.pmod(F.xxhash64(*events.columns), F.lit(salts)).cast("int"))
    copies = dimension.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "salt"], "left").drop("salt")


def running_daily_sales(sales: DataFrame, delay: str = "2 days") -> DataFrame:
    """Total of the day per client, for update mode. Days behind the watermark leave the state."""
    return (
        sales.where("client_id is not null and amount >= 0")
        .withColumn("day_start", F.date_trunc("day", "event_time"))
        .withWatermark("day_start", delay)
        .groupBy("day_start", "client_id")
        .agg(exact_sum(F.col("amount")).alias("total_spent"))
        .select(F.to_date("day_start").alias("event_date"), "client_id", "total_spent")
    )
