"""Readers, writers and whole jobs on files."""

from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopbank.functions.calendar import day_in_week, week_start
from shopbank.operators.activity import sales_per_user
from shopbank.plans import bank, retail
from shopbank.plans.storage import store_products_and_top_customers
from shopbank.session import scratch_path, shared_folder
from shopbank.sinks import files as sinks
from shopbank.sources import checked
from shopbank.sources import files as sources
from shopbank.sources import schemas


@pytest.fixture
def root(spark):
    return scratch_path(spark, "files")


def write_lines(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_bad_cells_become_null(spark, root):
    write_lines(spark, f"{root}/prices", ["price_id,product_id,valid_date,price", "1,p,2025-01-01,x", "2,p,never,3.5"])
    assert rows(sources.read_retail(spark, root, "prices")) == [("1", "p", date(2025, 1, 1), None), ("2", "p", None, 3.5)]


def test_daily_path():
    assert sources.daily_path("/in/", "sales", "2024-01-15") == "/in/sales/sales_2024_01_15.csv"


def test_json_array(spark, root):
    write_lines(spark, root, ['[', ' {"user_id": 1, "item": "a", "price": 2.5, "quantity": 2},',
                              ' {"user_id": 1, "item": "b", "price": 1.0, "quantity": 1},',
                              ' {"user_id": null, "item": "c", "price": 1.0, "quantity": 1}]'])
    sales = sources.read_json_array(spark, root, schemas.USER_SALES)
    assert sales.count() == 3
    assert rows(sales_per_user(sales)) == [(1, 6.0)]


def test_inferred_csv_and_append(spark, root):
    write_lines(spark, f"{root}/in", ["a,b", "1,x", "2,y"])
    df = sources.read_inferred_csv(spark, f"{root}/in")
    for _ in range(2):
        sinks.append_table(df, f"{root}/out")
    assert sources.read_parquet(spark, f"{root}/out").count() == 4


@pytest.fixture
def daily(spark):
    df = spark.createDataFrame([("p", date(2025, 1, 1) + timedelta(days=i), float(i)) for i in range(60)],
                               "product_id string, valid_date date, price double")
    df = df.crossJoin(spark.range(5)).drop("id")
    return df.withColumns({"week_start": week_start(F.col("valid_date")), "day_in_week": day_in_week(F.col("valid_date"))})


def test_weekly_parquet_has_one_file_a_week(spark, root, daily):
    sinks.write_weekly_parquet(daily, root)
    stored = spark.read.parquet(root)
    assert stored.count() == 300
    per_week = stored.groupBy("week_start").agg(F.count_distinct(F.col("_metadata.file_path")).alias("n"))
    assert {r.n for r in per_week.collect()} == {1}


@pytest.mark.parametrize("task_bytes", [1, 2000, 1 << 27])
def test_weekly_csv_has_one_file_a_day(spark, root, daily, task_bytes):
    sinks.write_weekly_csv(daily, root, task_bytes=task_bytes)
    stored = spark.read.schema(daily.schema).option("header", True).csv(root)
    assert stored.count() == 300
    path = F.col("_metadata.file_path")
    per_week = stored.groupBy("week_start").agg(F.count_distinct(path).alias("files"), F.count_distinct("valid_date").alias("days"))
    assert all(r.files == r.days for r in per_week.collect())


def retail_files(spark, root):
    def save(name, data):
        df = spark.createDataFrame(data, sources.RETAIL[name])
        df.write.option("header", True).csv(f"{root}/{name}")

    save("customers", [("c1", "Ana", "Pop", date(1990, 1, 1), "a@corp.example", "0744123456", "Str. Unirii, nr. 1", "Iași", None, "persoana_juridica"),
                       ("c2", "Ion", "Pop", date(2012, 1, 1), None, None, None, "Cluj", "312.5", "persoana_fizica")])
    save("products", [("p1", "Bere blondă", "Băuturi alcoolice", 0.19, 5.0, "true"), ("p2", "Detergent", "ALTELE", 0.19, 9.0, "false")])
    save("prices", [("r1", "p1", date(2025, 1, 1), 5.0), ("r2", "p1", date(2025, 1, 4), 6.0), ("r3", "p2", date(2025, 1, 2), 9.0)])
    save("discounts", [("d1", "p1", 0.2, date(2025, 1, 1), date(2025, 1, 7))])
    save("transactions", [("t1", "c1", "p1", 2, datetime(2025, 1, 4, 7), "cash", "S1", 6.0),
                          ("t1", "c1", "p2", 1, datetime(2025, 1, 4, 7), "cash", "S1", 9.0),
                          ("t2", "c2", "p1", 1, datetime(2025, 1, 9, 21), "card", "S1", 6.0)])


def test_all_retail_jobs(spark, root):
    retail_files(spark, root)
    tables = retail.read_tables(spark, root)
    settings = retail.Settings(2025, date(2025, 12, 31), date(2026, 12, 31), "corp.example")
    written = {}
    for job in retail.JOBS:
        def write(df, name, job=job):
            sinks.append_table(df, f"{root}/out/{job}_{name}")
            written[name] = rows(spark.read.parquet(f"{root}/out/{job}_{name}"))

        assert retail.run(job, tables, settings, write)
    assert len(written) == 61
    assert written["prices_filled"] == sorted([
        ("p1", date(2025, 1, 1), 5.0, 5.0), ("p1", date(2025, 1, 2), None, 5.0), ("p1", date(2025, 1, 3), None, 5.0),
        ("p1", date(2025, 1, 4), 6.0, 6.0), ("p2", date(2025, 1, 1), None, None), ("p2", date(2025, 1, 2), 9.0, 9.0),
        ("p2", date(2025, 1, 3), None, 9.0), ("p2", date(2025, 1, 4), None, 9.0),
    ], key=repr)
    assert written["purchases_during_discount"] == [("d1", "p1", date(2025, 1, 1), date(2025, 1, 7), 1, 2)]
    # Price of the day 6.0, half of 20 %, two units, bought by a customer without a card.
    assert written["missed_savings_non_fidelity"] == [(1.2,)]
    assert written["totals"] == [(27.0, 15.0, 12.0)]
    assert written["underage_age_restricted"] == [("c2", "Băuturi alcoolice", 1)]
    assert written["frequently_bought_together"] == [("p1", "p2", 1)]
    assert written["refundable_tva_legal_entities"] == [(21.0, 3.35)]
    assert written["max_tx_open_close"] == [("closing", date(2025, 1, 9), 1), ("opening", date(2025, 1, 4), 1)]


def test_storage_job(spark, root):
    retail_files(spark, root)
    t = retail.read_tables(spark, root)
    store_products_and_top_customers(t.products, t.prices, t.transactions, f"{root}/out")
    assert rows(spark.read.text(f"{root}/out/top_customers")) == [("c1|21.0",), ("c2|6.0",)]
    assert spark.read.parquet(f"{root}/out/products_parquet").count() == 3


def test_bank_jobs(spark, root):
    day, noon = "2024-01-15", datetime(2024, 1, 15, 12)
    data = {
        "sales": [("1", 1, noon, 20.0, "m", "food")],
        "accounts": [("a", 1, "basic", 100.0, noon)],
        "loans": [("L", 1, 12000.0, 6.0, noon, 24, "car")],
        "delay_fees": [("f", 1, "L", 5.0, noon, 3)],
    }
    for name, table in data.items():
        df = spark.createDataFrame(table, sources.DAILY[name])
        df.write.option("header", True).csv(sources.daily_path(root, name, day))
    written = {}

    def write(df, name):
        written[name] = df.collect()

    bank.run_daily_sales(spark, root, day, write)
    bank.run_loan_analytics(spark, root, day, write)
    bank.run_spending_analytics(spark, root, day, write)
    assert set(written) == {
        "daily_sales", "daily_loan_analytics", "loan_run_summary", "daily_spending_analytics", "spending_run_summary",
        "marketing_actions",
    }
    assert written["loan_run_summary"][0].total_loans == 1
    assert written["spending_run_summary"][0].avg_spending == 20.0


def test_files_of_a_hot_week_have_the_size_asked_for(spark, root, daily):
    hot = spark.range(3000).selectExpr("uuid() as product_id", "date'2025-01-08' as valid_date", "rand() as price")
    hot = hot.withColumns({"week_start": week_start(F.col("valid_date")), "day_in_week": day_in_week(F.col("valid_date"))})
    both = daily.unionByName(hot).unionByName(daily.withColumn("product_id", F.repeat("product_id", 40))).cache()
    target = 20_000
    sinks.write_weekly_csv(both, root, file_bytes=target, task_bytes=target)
    stored = spark.read.schema(both.schema).option("header", True).csv(root)
    assert stored.count() == both.count()
    sizes = stored.groupBy("week_start", F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_path")).count().collect()
    large = [r["size"] for r in sizes if r["week_start"] == date(2025, 1, 8) and r["count"] > 100]
    assert len(large) > 5 and all(target / 2 <= x <= 2 * target for x in large)
    sinks.write_weekly_parquet(daily, f"{root}-again", task_bytes=2000)
    files = spark.read.parquet(f"{root}-again").groupBy("week_start").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()
    assert {r["n"] for r in files} == {1}


def test_small_weeks_share_tasks(spark, daily):
    plan = sinks.file_plan(daily, ["week_start", "day_in_week"], 1 << 28, 1 << 27).collect()
    assert {t.task for r in plan for t in r["tasks"]} == set(range(7))
    for week in {r["week_start"] for r in plan}:
        tasks = [t.task for r in plan for t in r["tasks"] if r["week_start"] == week]
        assert len(tasks) == len(set(tasks))


def test_stored_rows_come_from_the_footers(spark, root):
    spark.range(1000).write.parquet(f"{root}/full")
    spark.range(0).write.parquet(f"{root}/empty")
    assert sinks.stored_rows(spark, f"{root}/full") == 1000 and sinks.require_stored(spark, f"{root}/full").count() == 1000
    for name in ("empty", "absent"):
        assert sinks.stored_rows(spark, f"{root}/{name}") == 0
        with pytest.raises(ValueError, match="no rows"):
            sinks.require_stored(spark, f"{root}/{name}")
    spark.createDataFrame([], "a int").coalesce(1).write.mode("overwrite").parquet(f"{root}/empty")
    assert sinks.stored_rows(spark, f"{root}/empty") == 0


def test_refused_records_keep_reason_and_file(spark, root):
    write_lines(spark, f"{root}/day=1", ["k,n,t,s", "1,2,2024-01-01 00:00:00,a", "2,x,never,b", "3,4", '"4",5,,"with, comma"', "5,,,", "6,7,2024-01-01 00:00:00,c,more", ""])
    records = checked.read_checked_csv(spark, root + "/*", "k long, n int, t timestamp, s string", files="*.txt")
    assert rows(checked.accepted(records).select("k", "n", "s")) == sorted([(1, 2, "a"), (4, 5, "with, comma"), (5, None, None)], key=repr)
    bad = {r["record"]: r["reason"] for r in checked.quarantined(records).collect()}
    assert bad == {"2,x,never,b": "n,t", "3,4": "shape", "6,7,2024-01-01 00:00:00,c,more": "shape"}
    assert {r[0].split("day=")[1][0] for r in checked.quarantined(records).select("source_file").collect()} == {"1"}
    # Both outputs agree whatever columns a query takes.
    assert checked.accepted(records).select("s").count() == 3


def test_ordered_reports_keep_a_total_order_over_files(spark, root):
    df = spark.range(5000).selectExpr("id", "pmod(hash(id), 50) as score", "id % 7 as n").repartition(6)
    sinks.write_ordered(df, root, F.col("score").desc(), "id")
    got = sinks.read_ordered(spark, root).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 5001)) and got[0].asDict().keys() == {"id", "score", "n", "position"}
    assert [(-r["score"], r["id"]) for r in got] == sorted((-r["score"], r["id"]) for r in got)
