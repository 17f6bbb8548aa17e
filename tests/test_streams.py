"""Streams from day folders: duplicates, late rows, several batches, repeated batches."""

import time
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopbank.session import scratch_path
from shopbank.sinks.commits import CommittedTable
from shopbank.sources import schemas
from shopbank.sources.streams import read_day_stream
from shopbank.streaming import jobs, sinks
from shopbank.streaming import operators as ops

DAY = "2024-01-15"


@pytest.fixture
def root(spark):
    return scratch_path(spark, "streams")


def add_file(spark, root, name, schema, data):
    df = spark.createDataFrame(data, schema).coalesce(1)
    df.write.mode("append").option("header", True).csv(f"{root}/{name}/date={DAY}")


def at(hour, minute=0):
    return datetime(2024, 1, 15, hour, minute)


def run(query):
    query.processAllAvailable() if query.isActive else None
    query.awaitTermination()


def test_order_totals_over_two_runs(spark, root):
    target, checkpoint = f"{root}/out", f"{root}/checkpoint"

    def stream():
        run(jobs.start_order_totals(spark, root, DAY, target, checkpoint, every=None))
        return rows(jobs.order_totals(spark, target))

    add_file(spark, root, "orders", schemas.ORDER_STREAM, [
        ("o1", 5, "web", at(8)), ("o1", 5, "web", at(8)), ("o2", 1, "shop", at(9)), ("o3", -1, "shop", at(9)),
        ("o4", 7, None, at(9)), (None, 7, "web", at(9)), ("o5", 9, "web", at(9) + timedelta(days=1)),
    ])
    day = at(0).date()
    assert stream() == [(day, "shop", 1), (day, "web", 5)]
    # A second file with a row seen before; then nothing new.
    add_file(spark, root, "orders", schemas.ORDER_STREAM, [("o2", 1, "shop", at(10)), ("o6", 2, "web", at(10))])
    assert stream() == [(day, "shop", 1), (day, "web", 7)]
    assert stream() == [(day, "shop", 1), (day, "web", 7)]


def test_repeated_batch_counts_once(spark, root):
    write = sinks.increments(root, ["k"], F.sum("v").alias("v"))
    batch = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    for batch_id in (0, 0, 1):
        write(batch, batch_id)
    write(batch.where("false"), 2)
    assert rows(sinks.summed(spark.read.parquet(root), ["k"], "v")) == [("a", 6)]


def test_client_matches(spark, root):
    add_file(spark, root, "transactions", schemas.TRANSACTION_STREAM, [
        ("t1", "1", 10.0, at(10, 0)), ("t2", "1", 5.0, at(12, 0)), ("t3", "2", 1.0, at(10, 0)), ("t4", None, 1.0, at(10, 0)),
    ])
    add_file(spark, root, "clients", schemas.CLIENT_STREAM, [
        ("1", "Ana", "old", at(9, 56)), ("1", "Ana", "new", at(10, 4)), ("1", "Ana", "far", at(10, 6)),
        ("2", "Ion", "basic", at(10, 5)),
    ])
    target = f"{root}/matches"
    run(jobs.start_client_matches(spark, root, DAY, target, f"{root}/checkpoint", every=None))
    stored = spark.read.parquet(target)
    assert rows(stored.select("transaction_id", "account_type")) == [("t1", "new"), ("t1", "old"), ("t3", "basic")]
    day = at(0).date()
    # Equally near updates: the later one is taken, and the amount counts once.
    nearest = f"{root}/nearest"
    run(jobs.start_client_totals(spark, root, DAY, nearest, f"{root}/nearest-checkpoint", every=None))
    assert rows(jobs.client_totals(spark, nearest)) == [(day, "1", "Ana", "new", 10.0), (day, "2", "Ion", "basic", 1.0)]
    assert rows(ops.client_totals(stored)) == rows(jobs.client_totals(spark, nearest))
    totals = f"{root}/totals"
    run(jobs.start_matched_totals(spark, root, DAY, totals, f"{root}/totals-checkpoint", every=None))
    assert rows(jobs.matched_totals(spark, totals)) == rows(ops.matched_totals(stored))
    assert rows(ops.matched_totals(stored)) == [
        (day, "1", "Ana", "new", 10.0), (day, "1", "Ana", "old", 10.0), (day, "2", "Ion", "basic", 1.0),
    ]
    # A nearer version in a later batch takes the place of the stored one; a farther one does not.
    add_file(spark, root, "clients", schemas.CLIENT_STREAM, [("2", "Ion", "nearer", at(10, 1)), ("1", "Ana", "far", at(9, 55))])
    run(jobs.start_client_totals(spark, root, DAY, nearest, f"{root}/nearest-checkpoint", every=None))
    assert rows(jobs.client_totals(spark, nearest)) == [(day, "1", "Ana", "new", 10.0), (day, "2", "Ion", "nearer", 1.0)]
    assert CommittedTable(spark, nearest).read().count() == 3


@pytest.mark.parametrize("salts", [1, 3])
def test_client_matches_across_cells(spark, salts):
    """Every pair within reach meets once, wherever the edges of the cells lie; also before 1970."""
    start = datetime(1969, 12, 31, 22)
    left = [(f"t{i}", str(i % 2), 1.0, start + timedelta(seconds=97 * i)) for i in range(150)]
    right = [(str(i % 2), "Ana", f"u{i}", start + timedelta(seconds=100 * i)) for i in range(150)]
    transactions, clients = spark.createDataFrame(left, schemas.TRANSACTION_STREAM), spark.createDataFrame(right, schemas.CLIENT_STREAM)
    got = ops.client_matches(transactions, clients, salts=salts).select("transaction_id", "account_type")
    reach = timedelta(minutes=5)
    assert rows(got) == sorted([(t[0], u[2]) for t in left for u in right if t[1] == u[0] and abs(t[3] - u[3]) <= reach], key=repr)


def test_state_of_matches_follows_the_input(spark, root):
    """Neither the number of tasks nor how long a client is remembered multiplies the rows of the state or the pairs compared."""
    times = [at(0) + timedelta(minutes=i) for i in range(1000)]
    add_file(spark, root, "transactions", schemas.TRANSACTION_STREAM, [(f"t{i}", "1", 1.0, x) for i, x in enumerate(times)])
    add_file(spark, root, "clients", schemas.CLIENT_STREAM, [("1", "Ana", "a", x) for x in times])
    query = jobs.start_client_matches(spark, root, DAY, f"{root}/matches", f"{root}/checkpoint", every=None)
    run(query)
    assert sum(x["numRowsUpdated"] for p in query.recentProgress for x in p["stateOperators"]) <= 3 * len(times)
    assert spark.read.parquet(f"{root}/matches").count() == sum(1 for x in range(1000) for y in range(1000) if abs(x - y) <= 5)


def test_late_rows_are_dropped_behind_the_watermark(spark, root):
    schema = "id string, v double, ts timestamp"
    target, checkpoint = f"{root}/out", f"{root}/checkpoint"

    def stream():
        events = ops.with_event_time(read_day_stream(spark, root, "events", DAY, schema), "ts")
        run(sinks.start_append(ops.tumbling_totals(events, "id", "v"), target, checkpoint))
        return rows(spark.read.parquet(target).select("window_start", "total", "events"))

    add_file(spark, root, "events", schema, [("a", 1.0, at(10, 1)), ("a", 2.0, at(10, 9)), ("a", 4.0, at(11, 0))])
    assert stream() == [(at(10), 3.0, 2)]
    add_file(spark, root, "events", schema, [("a", 8.0, at(10, 5)), ("a", 16.0, at(10, 55)), ("a", 1.0, at(12, 0))])
    assert stream() == [(at(10), 3.0, 2), (at(10, 50), 16.0, 1), (at(11), 4.0, 1)]


def test_sessions_and_sliding_windows_match_batch(spark, root):
    schema = "id string, v double, ts timestamp"
    add_file(spark, root, "events", schema, [
        ("a", 1.0, at(10, 0)), ("a", 2.0, at(10, 10)), ("a", 4.0, at(10, 40)), ("b", 8.0, at(10, 0)), ("z", 0.0, at(20, 0)),
    ])
    events = ops.with_event_time(read_day_stream(spark, root, "events", DAY, schema), "ts")
    run(sinks.start_append(ops.session_totals(events, "id", "v"), f"{root}/s", f"{root}/sc"))
    got = rows(spark.read.parquet(f"{root}/s").select("id", "session_start", "session_end", "total"))
    assert got == sorted([
        ("a", at(10, 0), at(10, 25), 3.0), ("a", at(10, 40), at(10, 55), 4.0), ("b", at(10, 0), at(10, 15), 8.0),
    ], key=repr)
    run(sinks.start_append(ops.sliding_counts(events), f"{root}/w", f"{root}/wc"))
    assert spark.read.parquet(f"{root}/w").agg(F.sum("events")).first()[0] == 4 * 5


def test_running_sales_in_update_mode(spark, root):
    schema = "client_id int, amount double, ts timestamp"
    target = f"{root}/out"

    def stream():
        sales = ops.with_event_time(read_day_stream(spark, root, "sales", DAY, schema), "ts")
        write = sinks.upsert(target, ["event_date", "client_id"], ["total_spent"])
        run(sinks.start_batches(ops.running_daily_sales(sales), write, f"{root}/checkpoint", "update"))
        return rows(sinks.latest_rows(spark, target, ["event_date", "client_id"], ["total_spent"]))

    day = at(0).date()
    add_file(spark, root, "sales", schema, [(1, 1.5, at(1)), (1, -3.0, at(2)), (2, 4.0, at(3))])
    assert stream() == [(day, 1, 1.5), (day, 2, 4.0)]
    add_file(spark, root, "sales", schema, [(1, 2.0, at(5))])
    assert stream() == [(day, 1, 3.5), (day, 2, 4.0)]


@pytest.mark.parametrize("salts", [1, 4])
def test_static_join_keeps_unknown_rows(spark, salts):
    events = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, client int")
    dimension = spark.createDataFrame([(0, "zero"), (1, "one")], "client int, name string")
    got = {(r.id, r.name) for r in ops.with_static(events, dimension, "client", salts).collect()}
    assert got == {(i, {0: "zero", 1: "one"}.get(i % 3)) for i in range(9)}


def test_preview(spark):
    query = sinks.start_preview(spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).load(), "preview")
    try:
        while not query.recentProgress:
            assert query.exception() is None
            time.sleep(0.2)
        assert spark.table("preview").count() >= 5
    finally:
        query.stop()


def test_complete_mode_swaps_whole_results(spark, root):
    schema = "id string, v double, ts timestamp"

    def stream():
        events = ops.with_event_time(read_day_stream(spark, root, "events", DAY, schema), "ts")
        sessions = ops.session_totals(events, "id", "v")
        run(sinks.start_batches(sessions, sinks.snapshot(f"{root}/out"), f"{root}/checkpoint", "complete"))
        return rows(CommittedTable(spark, f"{root}/out").read().select("id", "total", "events"))

    add_file(spark, root, "events", schema, [("a", 1.0, at(10)), ("a", 2.0, at(10, 20))])
    assert stream() == [("a", 1.0, 1), ("a", 2.0, 1)]
    # The event between the two sessions makes them one.
    add_file(spark, root, "events", schema, [("a", 4.0, at(10, 10)), ("b", 8.0, at(11))])
    assert stream() == [("a", 7.0, 3), ("b", 8.0, 1)]


def test_processing_time_trigger(spark, root):
    schema = "id string, v double, ts timestamp"
    add_file(spark, root, "events", schema, [("a", 1.0, at(10))])
    events = ops.with_event_time(read_day_stream(spark, root, "events", DAY, schema), "ts")
    query = sinks.start_append(events, f"{root}/out", f"{root}/checkpoint", every="1 second")
    try:
        query.processAllAvailable()
        add_file(spark, root, "events", schema, [("b", 1.0, at(11))])
        query.processAllAvailable()
        assert rows(spark.read.parquet(f"{root}/out").select("id")) == [("a",), ("b",)]
    finally:
        query.stop()
