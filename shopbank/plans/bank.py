"""The daily bank jobs, from daily snapshot files to appended tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shopbank.operators import bank
from shopbank.sources.files import read_daily

Write = Callable[[DataFrame, str], None]


def run_daily_sales(spark: SparkSession, root: str, day: date | str, write: Write) -> None:
    sales, accounts = (read_daily(spark, root, name, day) for name in ("sales", "accounts"))
    write(bank.daily_sales(sales, accounts, day), "daily_sales")


def _write_report(report: DataFrame, name: str, results: dict[str, DataFrame], write: Write) -> None:
    # ``results`` are derived from the report, which is persisted until all of them are written.
    write(report, name)
    for result, frame in results.items():
        write(frame, result)
    report.unpersist()


def run_loan_analytics(spark: SparkSession, root: str, day: date | str, write: Write) -> None:
    loans, fees, sales = (read_daily(spark, root, name, day) for name in ("loans", "delay_fees", "sales"))
    report = bank.daily_loan_analytics(loans, fees, sales, day).persist()
    _write_report(report, "daily_loan_analytics", {"loan_run_summary": bank.loan_run_summary(report)}, write)


def run_spending_analytics(spark: SparkSession, root: str, day: date | str, write: Write) -> None:
    sales, accounts = (read_daily(spark, root, name, day) for name in ("sales", "accounts"))
    report = bank.daily_spending_analytics(sales, accounts, day).persist()
    results = {
        "spending_run_summary": bank.spending_run_summary(report),
        "marketing_actions": bank.marketing_actions(report),
    }
    _write_report(report, "daily_spending_analytics", results, write)
