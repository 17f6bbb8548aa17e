"""Check queries of the readers: a given table is written in a source's format, as the source would deliver it, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import Check
from checks.views import DAY, Views
from shopbank.session import scratch_path
from shopbank.sources import files, schemas
from shopbank.sources.streams import read_day_stream, read_parquet_stream
from shopbank.streaming import sinks


def _zoneless(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


#: Spark writes milliseconds unless told otherwise.
MICROS = {name: "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]" for name in ("timestampFormat", "timestampNTZFormat")}


def _retail(name: str):
    def run(v: Views) -> DataFrame:
        root = scratch_path(v.spark, f"csv-{name}")
        getattr(v, name).write.option("header", True).csv(f"{root}/{name}")
        return _zoneless(files.read_retail(v.spark, root, name))

    return run


def _daily(name: str):
    def run(v: Views) -> DataFrame:
        root = scratch_path(v.spark, f"daily-{name}")
        getattr(v, name).write.option("header", True).options(**MICROS).csv(files.daily_path(root, name, DAY))
        return _zoneless(files.read_daily(v.spark, root, name, DAY))

    return run


def _inferred(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "inferred")
    v.table("events").select("event_id", "event_type", "value").write.option("header", True).csv(path)
    return files.read_inferred_csv(v.spark, path)


def _json_arrays(v: Views) -> DataFrame:
    """Eight files, each with one array of objects."""
    path = scratch_path(v.spark, "json-arrays")
    sale = F.struct("user_id", F.col("event_type").alias("item"), F.col("value").alias("price"), (F.col("event_id") % 5).cast("int").alias("quantity"))
    arrays = v.table("events").groupBy((F.col("event_id") % 8).alias("part")).agg(F.to_json(F.collect_list(sale)).alias("value"))
    arrays.repartition("part").write.partitionBy("part").text(path)
    return files.read_json_array(v.spark, path, schemas.USER_SALES).drop("part")


def _orders(v: Views) -> DataFrame:
    return v.table("events").selectExpr(
        "cast(event_id as string) as order_id", "cast(value as int) as quantity", "event_type as type", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') as date"
    )


def _day_stream(v: Views, every: str | None = None) -> DataFrame:
    """Day-directory CSV files, taken in as a stream and stored; with ``every``, by a query that runs on until it is stopped."""
    root = scratch_path(v.spark, "day-stream")
    _orders(v).write.option("header", True).csv(f"{root}/orders/date={DAY}")
    orders = read_day_stream(v.spark, root, "orders", DAY, schemas.ORDER_STREAM)
    query = sinks.start_append(orders, f"{root}/out", f"{root}/checkpoint", every)
    if every:
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    query.awaitTermination()
    return _zoneless(v.spark.read.schema(orders.schema).parquet(f"{root}/out"))


def _table(v: Views) -> DataFrame:
    name, path = f"users_{uuid.uuid4().hex}", scratch_path(v.spark, "users")
    v.users.write.option("path", path).saveAsTable(name)
    return files.read_table(v.spark, name)


def _preview(v: Views) -> DataFrame:
    """Counts in complete mode, in the table in memory that a preview makes."""
    name = f"preview_{uuid.uuid4().hex}"
    events = read_parquet_stream(v.spark, v.folder, v.table("events").schema, "events.parquet")
    query = sinks.start_preview(events.groupBy("event_type").agg(F.count("*").alias("events")), name, "complete")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return v.spark.table(name)


ORDERS = """
select cast(event_id as varchar) as order_id, cast(trunc(value) as int) as quantity, event_type as type,
  date_trunc('second', ts) as date from events"""

CHECKS = [
    *[Check(f"csv_{name}", _retail(name), f"select * from {name}") for name in files.RETAIL],
    *[Check(f"csv_daily_{name}", _daily(name), f"select * from {name}") for name in files.DAILY],
    Check("csv_inferred", _inferred, "select cast(event_id as int) as event_id, event_type, value from events"),
    Check("json_arrays", _json_arrays, """
select user_id, event_type as item, value as price, cast(event_id % 5 as int) as quantity from events"""),
    Check("csv_day_stream", _day_stream, ORDERS),
    Check("csv_day_stream_by_time", lambda v: _day_stream(v, "1 second"), ORDERS),
    Check("table_read", _table, "select * from users"),
    Check("stream_preview", _preview, "select event_type, count(*) as events from events group by 1"),
]
