"""Check queries of the file layouts: written whole, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Check
from checks.views import wednesday
from shopbank.operators import activity, baskets, products
from shopbank.session import scratch_path
from shopbank.sinks import files
from shopbank.sinks.commits import CommittedTable
from shopbank.sources import checked
from shopbank.streaming.sinks import start_append

DAILY = f"""
select product_id, valid_date, price, product_name, category, tva_rate, base_price, age_restricted,
  cast(datediff('day', {wednesday('valid_date')}, valid_date) as int) as day_in_week,
  {wednesday('valid_date')} as week_start
from prices join products using (product_id)"""
FILES = f"""
select {wednesday('valid_date')} as week_start, {{files}} as files, count(*) as rows
from prices join products using (product_id) group by 1"""


def _weekly_parquet(v):
    path = scratch_path(v.spark, "weekly-parquet")
    files.write_weekly_parquet(products.daily_products(v.products, v.prices), path)
    return v.spark.read.parquet(path)


def _weekly_csv(v):
    path = scratch_path(v.spark, "weekly-csv")
    daily = products.daily_products(v.products, v.prices)
    files.write_weekly_csv(daily, path)
    return v.spark.read.schema(daily.schema).option("header", True).csv(path)


def _files_per_week(df):
    path = F.col("_metadata.file_path")
    return df.groupBy("week_start").agg(F.count_distinct(path).alias("files"), F.count("*").alias("rows"))


def _top_customers_text(v):
    path = scratch_path(v.spark, "top-customers")
    files.write_text(baskets.top_customers(v.transactions), path)
    return v.spark.read.text(path)


def _visits_by_hour(v):
    path = scratch_path(v.spark, "visits")
    files.overwrite_parquet(activity.visits_by_hour(v.visits), path, "hour")
    return v.spark.read.parquet(path)


def _appended(v):
    path = scratch_path(v.spark, "appended")
    files.append_table(baskets.products_per_customer(v.transactions), path)
    return v.spark.read.parquet(path)


def _appended_once(v):
    """The run of a day is repeated, as after a failure; that of the next day adds its rows."""
    path = scratch_path(v.spark, "appended-once")
    totals = baskets.products_per_customer(v.transactions)
    for day in ("2024-01-15", "2024-01-15", "2024-01-16"):
        files.append_once(totals.withColumn("day", F.lit(day)), path, day)
    return CommittedTable(v.spark, path).read()


def _stored_visits(v):
    """Written, then found not to be empty by the footers alone, then read."""
    path = scratch_path(v.spark, "stored-visits")
    files.overwrite_parquet(activity.visits_by_hour(v.visits), path)
    return files.require_stored(v.spark, path)


def _ordered_report(v):
    """Customers by what they bought, as stored, with their place in the files."""
    path = scratch_path(v.spark, "ordered-report")
    files.write_ordered(baskets.products_per_customer(v.transactions), path, F.col("total_items").desc(), "customer_id")
    return files.read_ordered(v.spark, path)


ORDER_COLUMNS = "order_id long, quantity int, type string, date timestamp"


def _dirty_days(v):
    """The events as day directories of CSV files, with faults: numbers, times and both that are none."""
    path = scratch_path(v.spark, "dirty-days")
    rows = v.table("events").select(
        F.col("event_id").cast("string").alias("order_id"),
        F.expr("case when event_id % 33 = 5 then concat('x', event_id) else cast(cast(value as int) as string) end").alias("quantity"),
        F.expr("case when event_id % 20 = 3 then null else event_type end").alias("type"),
        F.expr("case when event_id % 50 = 5 then 'yesterday' else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end").alias("date"),
        F.to_date("ts").alias("day"),
    )
    rows.repartition("day").write.partitionBy("day").option("header", True).csv(f"{path}/in")
    return path


def _both(v, good, refused):
    """Accepted rows, and refused ones by the number in their record, with the day of the file they came from."""
    day = F.regexp_extract("source_file", "day=([0-9-]+)", 1).alias("day")
    number = F.split("record", ",")[0].cast("long").alias("order_id")
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("quantity", "int"), ("type", "string"), ("date", "timestamp_ntz"))]
    refused = refused.select(number, *none, "reason", day)
    good = good.withColumn("date", F.col("date").cast("timestamp_ntz"))
    return good.withColumns({"reason": F.lit(None).cast("string"), "day": F.lit(None).cast("string")}).unionByName(refused)


def _csv_quarantine(v):
    records = checked.read_checked_csv(v.spark, f"{_dirty_days(v)}/in/*", ORDER_COLUMNS)
    return _both(v, checked.accepted(records), checked.quarantined(records))


def _csv_quarantine_stream(v):
    path = _dirty_days(v)
    records = checked.read_checked_csv(v.spark, f"{path}/in/*", ORDER_COLUMNS, stream=True)
    out = []
    for name, rows in (("good", checked.accepted(records)), ("refused", checked.quarantined(records))):
        start_append(rows, f"{path}/{name}", f"{path}/{name}-checkpoint").awaitTermination()
        out.append(v.spark.read.schema(rows.schema).parquet(f"{path}/{name}"))
    return _both(v, *out)


def _json_quarantine(v):
    """Objects on lines, with a number that is none and lines that are no object."""
    path = scratch_path(v.spark, "dirty-json")
    def record(quantity):
        fields = F.col("event_id").alias("order_id"), F.expr(quantity).alias("quantity"), F.col("event_type").alias("type")
        return F.to_json(F.struct(*fields))

    whole = F.when(F.col("event_id") % 33 == 5, record("concat('x', event_id)")).otherwise(record("cast(value as int)"))
    line = F.when(F.col("event_id") % 77 == 9, F.concat(F.col("event_id"), F.lit(",broken"))).otherwise(whole)
    v.table("events").select(line.alias("value")).write.text(path)
    records = checked.read_checked_json(v.spark, path, "order_id long, quantity int, type string", files="*.txt")
    good = checked.accepted(records).withColumn("reason", F.lit(None).cast("string"))
    number = F.regexp_extract("record", "[0-9]+", 0).cast("long").alias("order_id")
    refused = checked.quarantined(records).select(number, F.lit(None).cast("int").alias("quantity"), F.lit(None).cast("string").alias("type"), "reason")
    return good.unionByName(refused)


REFUSED = """
select event_id as order_id,
  case when event_id % 33 <> 5 and event_id % 50 <> 5 then cast(trunc(value) as int) end as quantity,
  case when event_id % 33 <> 5 and event_id % 50 <> 5 and event_id % 20 <> 3 then event_type end as type,
  case when event_id % 33 <> 5 and event_id % 50 <> 5 then date_trunc('second', ts) end as date,
  case when event_id % 33 = 5 and event_id % 50 = 5 then 'quantity,date' when event_id % 33 = 5 then 'quantity'
    when event_id % 50 = 5 then 'date' end as reason,
  case when event_id % 33 = 5 or event_id % 50 = 5 then strftime(ts, '%Y-%m-%d') end as day
from events"""


CHECKS = [
    Check("products_weekly_parquet", _weekly_parquet, DAILY),
    Check("products_weekly_parquet_files", lambda v: _files_per_week(_weekly_parquet(v)), FILES.format(files="cast(1 as bigint)")),
    Check("products_weekly_csv", _weekly_csv, DAILY),
    Check("products_weekly_csv_files", lambda v: _files_per_week(_weekly_csv(v)), FILES.format(files="count(distinct valid_date)")),
    Check("top_customers_text", _top_customers_text, """
with totals as (
  select customer_id, sum(cast(floor(quantity * unit_price_at_purchase * 10000 + 0.5) as bigint)) / 1e4 as spent
  from transactions group by 1 order by 2 desc, 1 limit 100)
select customer_id || '|' || cast(spent as varchar) as value from totals"""),
    Check("visits_by_hour_partitioned", _visits_by_hour, """
select user_id, count(*) as visits, cast(hour(ts) as int) as hour from visits group by 1, 3"""),
    Check("append_table", _appended, """
select customer_id, cast(sum(quantity) as bigint) as total_items, count(distinct product_id) as distinct_products,
  count(distinct transaction_id) as transactions from transactions group by 1"""),
    Check("append_once", _appended_once, """
select customer_id, cast(sum(quantity) as bigint) as total_items, count(distinct product_id) as distinct_products,
  count(distinct transaction_id) as transactions, day from transactions, (values ('2024-01-15'), ('2024-01-16')) as days(day)
group by 1, day"""),
    Check("assert_not_empty", _stored_visits, """
select user_id, count(*) as visits, cast(hour(ts) as int) as hour from visits group by 1, 3"""),
    Check("ordered_report", _ordered_report, """
select *, row_number() over (order by total_items desc, customer_id) as position from (
  select customer_id, cast(sum(quantity) as bigint) as total_items, count(distinct product_id) as distinct_products,
    count(distinct transaction_id) as transactions from transactions group by 1)"""),
    Check("csv_quarantine", _csv_quarantine, REFUSED),
    Check("csv_quarantine_stream", _csv_quarantine_stream, REFUSED),
    Check("json_quarantine", _json_quarantine, """
select event_id as order_id, case when event_id % 77 <> 9 and event_id % 33 <> 5 then cast(trunc(value) as int) end as quantity,
  case when event_id % 77 <> 9 and event_id % 33 <> 5 then event_type end as type,
  case when event_id % 77 = 9 then 'shape' when event_id % 33 = 5 then 'quantity' end as reason
from events"""),
]
