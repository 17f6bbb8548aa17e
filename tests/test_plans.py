"""Physical plans: what must not occur, what must reach the scan, and what is split under a hot key."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import bank, retail
from checks.views import AS_OF, DAY, RESTRICTED, Views
from shopbank.operators import activity, baskets, discounts, products, revenue
from shopbank.operators.bank import daily_loan_analytics, daily_sales

FOLDER = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{k}": v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [c.name for c in (*retail.CHECKS, *bank.CHECKS)])
def test_no_cross_join_and_no_python(spark, name):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(entry.queries()[name](spark, FOLDER))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|BroadcastHashJoin|EvalPython|InPandas", text)


def test_day_filter_reaches_the_scan(spark):
    v = Views(spark, FOLDER)
    text = plan(daily_sales(v.sales, v.accounts, DAY))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """The larger tables with half of their rows on one product, customer, user and client."""
    v = Views(spark, "/root/testdata/sf0.01")
    folder = tmp_path_factory.mktemp("hot")

    def half(df, **keys):
        chosen = F.pmod(F.monotonically_increasing_id(), F.lit(2)) == 0
        hot = df.withColumn("chosen", chosen)
        for name, value in keys.items():
            hot = hot.withColumn(name, F.when(F.col("chosen"), F.lit(value)).otherwise(F.col(name)))
        path = str(folder / "-".join([*keys, df.columns[0]]))
        hot.drop("chosen").repartition(8).write.parquet(path)
        return spark.read.parquet(path)

    # Every line in the week of Wednesday 6 May 1998.
    in_week = F.expr("timestamp_ntz'1998-05-06' + make_dt_interval(cast(hour(transaction_date) % 7 as int))")
    return {
        "views": v,
        "lines": half(v.transactions, customer_id="12", product_id="7"),
        "one_week": half(v.transactions.withColumn("transaction_date", in_week), product_id="8"),
        "prices": half(v.prices, product_id="7"),
        "events": half(v.user_events, user_id=7),
        "loans": half(v.loans, client_id=7),
    }


SPLIT = {
    "customers": lambda h: discounts.missed_savings(h["lines"], h["views"].discounts, h["prices"], h["views"].customers),
    "restricted products": lambda h: baskets.underage_restricted(
        h["lines"], h["views"].customers, h["views"].products, AS_OF, RESTRICTED + ["ECONOMY", "STANDARD"]
    ),
    "a week": lambda h: revenue.flagged_sales(h["one_week"], h["views"].discounts),
    "product days": lambda h: products.daily_products(h["views"].products, h["prices"]),
    "users": lambda h: activity.recent_user_events(h["events"], h["views"].users, "2024-01-25", 100),
    "clients": lambda h: daily_loan_analytics(h["loans"], h["views"].delay_fees, h["views"].sales, DAY),
}


@pytest.mark.parametrize("case", list(SPLIT))
def test_hot_side_of_a_raw_join_is_split(spark, hot, case):
    small = {
        "autoBroadcastJoinThreshold": "-1",
        "files.maxPartitionBytes": "64k",
        "files.openCostInBytes": "0",
        "adaptive.advisoryPartitionSizeInBytes": "16k",
        "adaptive.coalescePartitions.enabled": "false",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "adaptive.skewJoin.skewedPartitionFactor": "2",
        "shuffle.partitions": "16",
    }
    with settings(spark, **small):
        df = SPLIT[case](hot)
        df.collect()
        assert "skew=true" in plan(df)
