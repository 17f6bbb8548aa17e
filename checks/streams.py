"""Check queries of the streaming operators.

Each one streams the whole event table through the operator, to the end, and reads back what was
stored. Tumbling and sliding windows are upserted in update mode, and sessions are kept whole in complete
mode, so windows still open at the end are stored as well. Where batches matter, the events arrive in
deliveries, and the stream is started anew for each of them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from checks.registry import Check, total
from checks.views import Views
from shopbank.session import scratch_path
from shopbank.sinks.commits import CommittedTable
from shopbank.sources.streams import read_parquet_stream
from shopbank.streaming import jobs, sinks
from shopbank.streaming import operators as ops

WITHIN = "6 hours"
SESSION_GAP = "2 hours"
LATE_BY = "2 days"


def _events(v: Views) -> DataFrame:
    stream = read_parquet_stream(v.spark, v.folder, v.table("events").schema, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _timed(v: Views) -> DataFrame:
    return ops.with_event_time(_events(v), "ts")


def _zoneless(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def _appended(v: Views, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(v.spark, label)
    sinks.start_append(df, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return v.spark.read.schema(df.schema).parquet(f"{path}/rows")


def _upserted(v: Views, df: DataFrame, label: str, key: list[str], order: list[str], mode: str) -> DataFrame:
    path = scratch_path(v.spark, label)
    write = sinks.upsert(f"{path}/rows", key, order)
    sinks.start_batches(df, write, f"{path}/checkpoint", mode).awaitTermination()
    return sinks.latest_rows(v.spark, f"{path}/rows", key, order)


SLICES = 3


def _slices(v: Views) -> list[DataFrame]:
    """The events by time; each slice but the first begins with the last two hours of the one before, delivered again."""
    events = v.table("events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    edges = [first + (last - first) / SLICES * i for i in range(SLICES)] + [last]
    within = [(F.col("ts") > a - timedelta(hours=2)) & (F.col("ts") <= b) for a, b in zip(edges, edges[1:])]
    return [events.where(x) for x in within]


def _in_deliveries(v: Views, deliveries: list[DataFrame], label: str, start: Callable[[DataFrame, str], StreamingQuery]) -> str:
    """Starts the stream anew after each delivery; ``start`` gets the events and the folder for what it stores."""
    path = scratch_path(v.spark, label)
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{path}/events")
        stream = read_parquet_stream(v.spark, f"{path}/events", rows.schema)
        start(stream.withColumn("ts", F.col("ts").cast("timestamp")), path).awaitTermination()
    return path


def _order_totals(v: Views) -> DataFrame:
    keys = ["event_date", "type"]

    def start(events: DataFrame, path: str) -> StreamingQuery:
        orders = events.select(
            F.col("event_id").cast("string").alias("order_id"),
            F.col("value").cast("int").alias("quantity"),
            F.col("event_type").alias("type"),
            F.col("ts").alias("date"),
        )
        write = sinks.increments(f"{path}/rows", keys, F.sum("quantity").alias("total_quantity"))
        return sinks.start_batches(ops.valid_orders(orders), write, f"{path}/checkpoint")

    path = _in_deliveries(v, _slices(v), "order-totals", start)
    return sinks.summed(v.spark.read.parquet(f"{path}/rows"), keys, "total_quantity")


def _matches(events: DataFrame, salts: int = 1) -> DataFrame:
    """Every event is a transaction, and an update of its client an hour and a half later."""
    transactions = events.selectExpr(
        "cast(event_id as string) as transaction_id", "cast(user_id as string) as client_id", "value as amount",
        "ts as timestamp",
    )
    clients = events.selectExpr(
        "cast(user_id as string) as client_id", "concat('Client ', user_id) as client_name",
        "concat('T', substring(get_json_object(props, '$.k'), 1, 1)) as account_type",
        "ts + interval 90 minutes as updated_at",
    )
    return ops.client_matches(transactions, clients, within=WITHIN, delay="1 day", salts=salts)


def _matched_totals(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "matched-totals")
    write = jobs.matched_increments(f"{path}/rows")
    sinks.start_batches(_matches(_events(v)), write, f"{path}/checkpoint").awaitTermination()
    return jobs.matched_totals(v.spark, f"{path}/rows")


def _transaction_totals(v: Views) -> DataFrame:
    """Over several deliveries; one row for each transaction is stored."""

    def start(events: DataFrame, path: str) -> StreamingQuery:
        salts = jobs.join_salts(v.spark, f"{path}/checkpoint")
        return sinks.start_batches(_matches(events, salts), jobs.nearest_versions(f"{path}/rows"), f"{path}/checkpoint")

    path = _in_deliveries(v, _slices(v), "transaction-totals", start)
    return jobs.client_totals(v.spark, f"{path}/rows")


def _lateness(v: Views) -> DataFrame:
    """Four deliveries that are each spread over all days, so most of what comes after the first is late."""
    events = v.table("events")

    def start(events: DataFrame, path: str) -> StreamingQuery:
        write = sinks.routed_by_lateness(f"{path}/rows", LATE_BY)
        return sinks.start_batches(ops.with_event_time(events, "ts"), write, f"{path}/checkpoint")

    path = _in_deliveries(v, [events.where(f"event_id % 4 = {k}") for k in range(4)], "lateness", start)
    return sinks.lateness(v.spark, f"{path}/rows")


def _daily_sales(v: Views) -> DataFrame:
    sales = _timed(v).selectExpr("event_time", "user_id as client_id", "value as amount")
    totals = ops.running_daily_sales(sales)
    # A running total of positive amounts only grows, so the latest one is the largest.
    return _upserted(v, totals, "daily-sales", ["event_date", "client_id"], ["total_spent"], "update")


def _upsert(v: Views) -> DataFrame:
    rows = _events(v).select("user_id", "ts", "event_id", "event_type", "value")
    return _zoneless(_upserted(v, rows, "upsert", ["user_id"], ["ts", "event_id"], "append"))


def _windows(v: Views) -> DataFrame:
    totals = ops.tumbling_totals(_timed(v), "event_type", "value")
    return _zoneless(_upserted(v, totals, "tumbling", ["window_start", "window_end", "event_type"], ["events"], "update"))


def _sliding(v: Views) -> DataFrame:
    counts = ops.sliding_counts(_timed(v))
    return _zoneless(_upserted(v, counts, "sliding", ["window_start", "window_end"], ["events"], "update"))


def _sessions(v: Views) -> DataFrame:
    """In complete mode: each batch swaps in all sessions, open ones included."""

    def start(events: DataFrame, path: str) -> StreamingQuery:
        sessions = ops.session_totals(ops.with_event_time(events, "ts"), "user_id", "value", SESSION_GAP)
        return sinks.start_batches(sessions, sinks.snapshot(f"{path}/rows"), f"{path}/checkpoint", "complete")

    events = v.table("events")
    path = _in_deliveries(v, [events.where(f"event_id % 2 = {k}") for k in range(2)], "sessions", start)
    return _zoneless(CommittedTable(v.spark, f"{path}/rows").read())


def _enriched(v: Views) -> DataFrame:
    stream = _events(v).select("event_id", "user_id", "event_type", "ts")
    return _zoneless(_appended(v, ops.with_static(stream, v.users.select("user_id", "country"), "user_id"), "enriched"))


def _unique(v: Views) -> DataFrame:
    """Each event comes twice in its delivery, and those near a delivery's end again in the next."""
    columns = ["event_id", "user_id", "value", "ts"]

    def start(events: DataFrame, path: str) -> StreamingQuery:
        twice = ops.with_event_time(events, "ts").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
        unique = ops.deduplicated(twice, "event_id", "4 hours").select(columns)
        return sinks.start_append(unique, f"{path}/rows", f"{path}/checkpoint")

    path = _in_deliveries(v, _slices(v), "unique", start)
    return _zoneless(v.spark.read.parquet(f"{path}/rows"))


MATCHES = f"""matches as (
  select cast(t.ts as date) as event_date, cast(t.event_id as varchar) as transaction_id,
    cast(t.user_id as varchar) as client_id, t.value as amount, t.ts as transaction_time,
    'Client ' || c.user_id as client_name, 'T' || substr(json_extract_string(c.props, '$.k'), 1, 1) as account_type,
    c.ts + interval 90 minutes as client_time
  from events t join events c on c.user_id = t.user_id
    and c.ts + interval 90 minutes between t.ts - interval {WITHIN} and t.ts + interval {WITHIN})"""
STARTS = "time_bucket(interval {0}, ts)"

CHECKS = [
    Check("stream_order_totals", _order_totals, """
select cast(ts as date) as event_date, event_type as type, cast(sum(cast(trunc(value) as int)) as bigint) as total_quantity
from events group by 1, 2"""),
    Check("stream_interval_join", lambda v: _zoneless(_appended(v, _matches(_events(v)), "matches")), f"with {MATCHES} select * from matches"),
    Check("stream_matched_totals", _matched_totals, f"""
with {MATCHES} select event_date, client_id, client_name, account_type, {total('amount')} as total_amount
from matches group by 1, 2, 3, 4"""),
    Check("stream_transaction_totals", _transaction_totals, f"""
with {MATCHES}, nearest as (
  select *, row_number() over (partition by transaction_id order by
    abs(epoch_us(client_time) - epoch_us(transaction_time)), client_time desc, account_type desc) as n from matches)
select event_date, client_id, client_name, account_type, {total('amount')} as total_amount
from nearest where n = 1 group by 1, 2, 3, 4"""),
    Check("stream_tumbling", _windows, f"""
select {STARTS.format('10 minutes')} as window_start, {STARTS.format('10 minutes')} + interval 10 minutes as window_end,
  event_type, {total('value')} as total, count(*) as events
from events group by 1, 2, 3"""),
    Check("stream_sliding", _sliding, f"""
with starts as (
  select {STARTS.format('2 minutes')} - to_minutes(2 * k) as window_start from events, range(5) as steps(k))
select window_start, window_start + interval 10 minutes as window_end, count(*) as events
from starts group by 1, 2"""),
    Check("stream_session", _sessions, f"""
with marked as (
  select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval {SESSION_GAP} then 0 else 1 end
    as first from events),
numbered as (select *, sum(first) over (partition by user_id order by ts) as session from marked),
sessions as (
  select min(ts) as session_start, max(ts) + interval {SESSION_GAP} as session_end, user_id, {total('value')} as total,
    count(*) as events from numbered group by user_id, session)
select * from sessions"""),
    Check("stream_lateness", _lateness, f"""
with delivered as (select event_id % 4 as batch, ts from events),
before as (
  select batch, max(max(ts)) over (order by batch rows between unbounded preceding and 1 preceding) as latest
  from delivered group by batch)
select cast(batch as int) as batch, count(*) as events,
  case when ts < latest - interval {LATE_BY} then 'dropped' when ts < latest then 'late' else 'on time' end as verdict
from delivered join before using (batch) group by 1, 3"""),
    Check("stream_static_enrich", _enriched, """
select event_id, user_id, event_type, ts, country from events left join users using (user_id)"""),
    Check("stream_dedup", _unique, "select event_id, user_id, value, ts from events"),
    Check("stream_daily_sales", _daily_sales, f"""
select cast(ts as date) as event_date, user_id as client_id, {total('value')} as total_spent from events group by 1, 2"""),
    Check("stream_upsert", _upsert, """
with ranked as (
  select user_id, ts, event_id, event_type, value,
    row_number() over (partition by user_id order by ts desc, event_id desc) as n from events)
select user_id, ts, event_id, event_type, value from ranked where n = 1"""),
]
