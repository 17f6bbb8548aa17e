"""Windows of any length: tiles of weeks, and the interval join against brute force."""

import random
from datetime import date, timedelta

from conftest import rows
from pyspark.sql import functions as F

from shopbank.operators.discounts import purchases_during_discount
from shopbank.operators.intervals import days_in_windows, spread_over_ranges, week_ranges


def test_tiles_cover_each_week_once(spark):
    rng = random.Random(1)
    spans = [(a, a + rng.choice((0, 1, 2, 7, 52, 521, 5000))) for a in (rng.randint(-3000, 3000) for _ in range(200))]
    tiled = spark.createDataFrame(spans, "low int, high int").withColumn("tiles", week_ranges("low", "high")).collect()
    for r in tiled:
        weeks = [w for t in r["tiles"] for w in range(t["range"] << t["level"], (t["range"] + 1) << t["level"])]
        assert sorted(weeks) == list(range(r["low"], r["high"] + 1))


def test_ten_years_are_few_rows_and_a_week_is_one(spark):
    windows = spark.createDataFrame(
        [("p", date(2015, 3, 4), date(2025, 3, 3)), ("q", date(2025, 1, 8), date(2025, 1, 14)), ("r", date(2025, 1, 2), date(2025, 1, 1))],
        "product_id string, start date, stop date",
    )
    n = {r["product_id"]: r["count"] for r in spread_over_ranges(windows, F.col("start"), F.col("stop")).groupBy("product_id").count().collect()}
    assert n["q"] == 1 and "r" not in n and n["p"] < 30


def test_join_equals_brute_force(spark):
    rng, origin = random.Random(2), date(2024, 12, 20)
    facts = [(rng.choice("abc"), origin + timedelta(days=rng.randint(-400, 400)), i) for i in range(300)] + [("a", None, -1), (None, origin, -2)]
    windows = []
    for i in range(60):
        start = origin + timedelta(days=rng.randint(-400, 400))
        windows.append((rng.choice("abc"), i, start, start + timedelta(days=rng.choice((-1, 0, 3, 6, 30, 400, 3650)))))
    windows.append(("a", 99, None, origin))
    f = spark.createDataFrame(facts, "product_id string, day date, fact int")
    w = spark.createDataFrame(windows, "product_id string, window int, start date, stop date")
    got = rows(days_in_windows(f, "day", w, F.col("start"), F.col("stop")).select("fact", "window"))
    want = [(n, i) for p, d, n in facts for q, i, a, b in windows if p == q and d and a and a <= d <= b]
    assert got == sorted(want, key=repr)


def test_no_windows(spark):
    f = spark.createDataFrame([("a", date(2024, 1, 1))], "product_id string, day date")
    w = spark.createDataFrame([], "product_id string, start date, stop date")
    assert days_in_windows(f, "day", w, F.col("start"), F.col("stop")).count() == 0


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lengths_are_read_from_distinct_spans(spark):
    """Not from every window tiled once more, and windows not from discounts that were grouped by their ids."""
    f = spark.createDataFrame([("a", date(2024, 1, 1))], "product_id string, day date")
    w = spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 1, 2))] * 3, "product_id string, start date, stop date")
    joined = days_in_windows(f, "day", w, F.col("start"), F.col("stop"))
    assert joined.count() == 3 and "Aggregate [_first" in optimized(joined)
    discounts = w.selectExpr("'d' as discount_id", "product_id", "start as valid_from", "stop as valid_to")
    lines = f.selectExpr("product_id", "cast(day as timestamp) as transaction_date", "'c' as customer_id", "2 as quantity")
    bought = purchases_during_discount(lines, discounts)
    assert rows(bought.select("purchase_count", "units_sold")) == [(3, 6)]
    assert optimized(bought).count("count(1) AS copies") <= 1
