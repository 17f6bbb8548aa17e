"""Bank reports and quantiles."""

import random
from datetime import datetime

import numpy as np
import pytest

from shopbank.operators import activity, bank
from shopbank.operators.quantiles import exact_quantiles
from shopbank.sources import schemas

DAY = "2024-01-15"
NOON = datetime(2024, 1, 15, 12)


@pytest.mark.parametrize(
    "values",
    [
        [random.Random(1).randrange(10**6) for _ in range(5000)],
        [7] * 3000 + list(range(1000)),  # one value holds most rows
        [int(10 ** (i / 400)) for i in range(4000)],  # long tail
        [1, 2],
        [5],
    ],
)
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v long").repartition(4)
    got = exact_quantiles(df, "v", [0.25, 0.5, 0.75, 1.0], buckets=32).first()
    assert tuple(got) == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.75, 1.0])))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v long")
    assert exact_quantiles(df, "v", [0.5]).first()[0] is None


def test_daily_sales_keeps_both_sides(spark):
    sales = spark.createDataFrame(
        [("1", 1, NOON, 10.5, "m", "c"), ("2", 1, NOON, 0.0, "m", "c"), ("3", 2, datetime(2024, 1, 16), 5.0, "m", "c"),
         ("4", None, NOON, 5.0, "m", "c"), ("5", 3, NOON, -1.0, "m", "c")],
        schemas.SALES,
    )
    accounts = spark.createDataFrame([("a", 2, "x", 100.0, NOON), ("b", 4, "x", None, NOON)], schemas.ACCOUNTS)
    got = {r.client_id: (r.total_spent, r.opening_balance) for r in bank.daily_sales(sales, accounts, DAY).collect()}
    assert got == {1: (10.5, 0.0), 2: (0.0, 100.0)}


def loans(spark, *more):
    return spark.createDataFrame(
        [("L1", 1, 12000.0, 6.0, NOON, 24, "car"), ("L2", 2, 50000.0, 9.0, NOON, 12, "home"),
         ("L3", 3, 5000.0, 4.0, NOON, 12, "cash"), ("L4", 4, 5000.0, 0.0, NOON, 12, "cash"), *more],
        schemas.LOANS,
    )


def test_loans(spark):
    fees = spark.createDataFrame(
        [("f1", 1, "L1", 100.0, NOON, 12), ("f2", 9, "L1", 50.0, NOON, 5), ("f3", 2, "L2", 10.0, NOON, 31)],
        schemas.DELAY_FEES,
    )
    sales = spark.createDataFrame([("s", 1, NOON, 30.0, "m", "food"), ("s", 2, NOON, 400.0, "m", "food")], schemas.SALES)
    report = bank.daily_loan_analytics(loans(spark), fees, sales, DAY).persist()
    got = {r.loan_id: r for r in report.collect()}
    assert set(got) == {"L1", "L2", "L3"}
    # Two clients paid fees of one loan: still one row.
    first = got["L1"]
    assert (first.times_late, first.fees_collected, first.payment_history) == (2, 150.0, "Sometimes Forgets")
    assert first.total_interest == 1440.0 and first.monthly_payment == 531.85
    assert first.payment_burden_percent == 59.1 and first.profit_ratio == 0.133
    assert (first.risk_score, first.risk_level) == (4, "Kinda Risky")
    assert first.recommendation == "Normal Loan"
    assert (got["L2"].risk_score, got["L2"].risk_level, got["L2"].recommendation) == (
        9, "Risky", "Watch Out - Might Be Trouble",
    )
    assert (got["L3"].payment_history, got["L3"].client_type, got["L3"].payment_burden_percent) == (
        "Always On Time", "Unknown", None,
    )
    assert bank.loan_run_summary(report).first() == (3, 1, pytest.approx(13 / 3), 33.3)
    assert bank.loan_run_summary(report.where("false")).first() == (0, 0, None, None)


def test_spending(spark):
    sales = spark.createDataFrame(
        [("1", 1, datetime(2024, 1, 15, 8), 10.0, "A", "Food"), ("2", 1, datetime(2024, 1, 15, 19), 30.0, "B", None),
         ("3", 1, datetime(2024, 1, 15, 9), 20.0, "A", "bills"), ("4", 2, NOON, 600.0, "A", "groceries")],
        schemas.SALES,
    )
    accounts = spark.createDataFrame(
        [("a", 1, "basic", 50.0, NOON), ("b", 1, "plus", 50.0, NOON), ("c", 2, "plus", 1000.0, datetime(2024, 1, 16))],
        schemas.ACCOUNTS,
    )
    report = bank.daily_spending_analytics(sales, accounts, DAY).persist()
    assert len(report.columns) == 39
    got = {r.client_id: r for r in report.collect()}
    one, two = got[1], got[2]
    assert (one.total_spent, one.unique_merchants, one.unique_categories) == (60.0, 2, 2)
    assert (one.food_spent, one.bills_spent, one.other_spent) == (10.0, 20.0, 30.0)
    assert (one.favorite_merchant, one.favorite_merchant_spending) == ("A", 30.0)
    assert (one.total_opening_balance, one.account_count, one.primary_account_type) == (100.0, 2, "plus")
    assert (one.percentile_25, one.percentile_75, one.avg_spending_all_clients) == (195.0, 465.0, 330.0)
    assert (one.spending_to_balance_ratio, one.risk_indicator) == (0.6, "Medium Risk")
    assert (one.customer_segment, one.shopping_preference, one.time_preference) == (
        "Bargain Hunter", "other", "Morning Person",
    )
    assert (two.account_count, two.risk_indicator, two.spending_tier) == (None, "Unknown", "Above Average")
    actions = {r.client_id: r.marketing_action for r in bank.marketing_actions(report).collect()}
    assert actions == {1: "Send Discount Offers", 2: "Standard Marketing"}
    assert bank.daily_spending_analytics(sales, accounts, "2020-01-01").count() == 0


def test_latency_texts(spark):
    events = spark.createDataFrame(
        [("d", "p", "m", "2025-01-10", "2025-01-10 01:00:00"), ("d", "p", "m", "2025-01-10", "2025-01-14 04:05:06"),
         ("d", "p", "m", "2024-11-01", "2025-01-14 04:05:06")],
        schemas.LATENCY_EVENTS,
    )
    (row,) = activity.latency_by_dataproduct(events, "2025-01-20").collect()
    assert (row.nr_of_events, row.min_sec, row.max_sec) == (2, 3600, 4 * 86400 + 4 * 3600 + 306)
    assert (row.min_time, row.max_time) == ("0d 0h 0m", "100:05:06")


def test_require_rows(spark):
    assert activity.require_rows(spark.range(1)).count() == 1
    with pytest.raises(ValueError, match="visits has no rows"):
        activity.require_rows(spark.range(0), "visits")
