"""Daily bank reports: sales per client, loans, spending behaviour.

Every input is cut to the day by a half-open range on the raw timestamp column and summed per key before a join.
Loans are joined as they are, and a client may hold a third of them: the sums beside them are grouped
by key and day, one day being all there is, so that the join shuffles both its sides by the key alone
and adaptive execution can split a hot one. A side that arrives grouped by the very join key cannot be.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopbank.functions.bands import above, at_least, at_most, below, points
from shopbank.functions.calendar import as_date, on_day
from shopbank.functions.money import exact_sum, from_exact, to_exact
from shopbank.operators.quantiles import exact_quantiles


def daily_sales(sales: DataFrame, accounts: DataFrame, day: date | str) -> DataFrame:
    """Spend and balance of the accounts opened that day, per client with either of them."""
    spent = (
        sales.where(on_day(F.col("transaction_date"), day))
        .where("client_id is not null and amount >= 0")
        .groupBy("client_id")
        .agg(exact_sum(F.col("amount")).alias("total_spent"))
    )
    opened = (
        accounts.where(on_day(F.col("open_date"), day))
        .where("client_id is not null and opening_balance >= 0")
        .groupBy("client_id")
        .agg(exact_sum(F.col("opening_balance")).alias("opening_balance"))
    )
    return spent.join(opened, "client_id", "full").select(
        F.lit(as_date(day)).alias("event_date"),
        "client_id",
        F.coalesce("total_spent", F.lit(0.0)).alias("total_spent"),
        F.coalesce("opening_balance", F.lit(0.0)).alias("opening_balance"),
    )


def sales_of_day(sales: DataFrame, day: date | str) -> DataFrame:
    """Positive sales of the day, categories in lower case, amounts also as exact decimals."""
    return (
        sales.where(on_day(F.col("transaction_date"), day))
        .where("client_id is not null and amount > 0")
        .withColumn("category", F.lower("category"))
        .withColumn("exact", to_exact(F.col("amount")))
    )


# Fixed values of the loan report: thresholds with their labels, and the risk points of each rule apart.
LOAN_SIZES = [(10_000, "Small Loan"), (30_000, "Medium Loan")]
LARGE_LOAN = "Large Loan"
RATE_CATEGORIES = [(5, "Low Rate"), (8, "Normal Rate")]
HIGH_RATE = "High Rate"
PAYMENT_HISTORIES = [(30, "Bad at Paying"), (10, "Sometimes Forgets")]
GOOD_PAYER, NEVER_LATE = "Pretty Good", "Always On Time"
CLIENT_TYPES = [(300, "Spends Lots"), (100, "Spends Normal")]
SAVER, NO_SPENDING = "Saves Money", "Unknown"
HISTORY_POINTS = {"Bad at Paying": 3, "Sometimes Forgets": 1}
RATE_POINTS = {"High Rate": 3, "Normal Rate": 1}
SIZE_POINTS = {"Large Loan": 2}
BURDEN_POINTS = [(40, 2), (25, 1)]
RISK_LEVELS = [(6, "Risky"), (3, "Kinda Risky")]
LOW_RISK = "Pretty Safe"
PROFIT_LEVELS = [(0.20, "Makes Lots of Money"), (0.15, "Makes Good Money"), (0.10, "Makes Some Money")]
LOW_PROFIT = "Makes Little Money"
LOAN_COLUMNS = [
    "report_date", "loan_id", "client_id", "loan_type", "principal_amount", "interest_rate", "monthly_payment",
    "loan_size", "rate_category", "total_interest", "fees_collected", "total_revenue", "profit_ratio", "times_late",
    "max_days_late", "payment_history", "daily_spending", "client_type", "payment_burden_percent", "risk_score",
    "risk_level", "profit_level", "recommendation",
]


def _loan_terms(loans: DataFrame) -> DataFrame:
    """Simple interest over the term, annuity payment, size and rate class."""
    principal, months = F.col("principal_amount"), F.col("term_months")
    monthly_rate = F.col("interest_rate") / 100 / 12
    growth = F.pow(1 + monthly_rate, months)
    return loans.withColumns(
        {
            "total_interest": F.round(principal * (F.col("interest_rate") / 100) * (months / 12), 2),
            "monthly_payment": F.round(principal * (monthly_rate * growth) / (growth - 1), 2),
            "loan_size": below(principal, LOAN_SIZES, LARGE_LOAN),
            "rate_category": at_most(F.col("interest_rate"), RATE_CATEGORIES, HIGH_RATE),
        }
    )


def _recommendation() -> Column:
    ratio, history = F.col("profit_ratio"), F.col("payment_history")
    good, great = ratio >= 0.15, ratio >= 0.20
    return (
        F.when(great & history.isin(NEVER_LATE, GOOD_PAYER), "Great Customer - Give Them More!")
        .when(~good & (history == "Bad at Paying"), "Watch Out - Might Be Trouble")
        .when(good, "Good Loan - Keep It")
        .otherwise("Normal Loan")
    )


def daily_loan_analytics(loans: DataFrame, fees: DataFrame, sales: DataFrame, day: date | str) -> DataFrame:
    """One row per loan started that day: payment, revenue, risk and a recommendation.

    Fees are summed by loan alone, so a loan stays one row whoever paid its fees.
    """
    started = loans.where(on_day(F.col("start_date"), day)).where(
        "client_id is not null and principal_amount > 0 and interest_rate > 0"
    )
    charged = (
        fees.where(on_day(F.col("fee_date"), day))
        .where("client_id is not null and loan_id is not null and fee_amount > 0")
        .groupBy("loan_id", F.to_date("fee_date"))
        .agg(
            F.count("*").alias("late"),
            exact_sum(F.col("fee_amount")).alias("charged"),
            F.max("days_delayed").alias("longest"),
        )
        .select("loan_id", "late", "charged", "longest", above(F.col("longest"), PAYMENT_HISTORIES, GOOD_PAYER).alias("payer"))
    )
    spent = (
        sales_of_day(sales, day)
        .groupBy("client_id", F.to_date("transaction_date"))
        .agg(from_exact(F.sum("exact")).alias("spent"))
        .select("client_id", "spent", above(F.col("spent"), CLIENT_TYPES, SAVER).alias("spender"))
    )
    # Burden: payment as a share of thirty days of today's spending.
    burden = F.round(F.try_divide(F.col("monthly_payment"), F.col("spent") * 30) * 100, 1)
    score = points(F.col("payment_history"), HISTORY_POINTS) + points(F.col("rate_category"), RATE_POINTS)
    score = score + points(F.col("loan_size"), SIZE_POINTS) + above(F.col("payment_burden_percent"), BURDEN_POINTS, 0)
    return (
        _loan_terms(started)
        .join(charged, "loan_id", "left")
        .join(spent, "client_id", "left")
        .withColumns(
            {
                "report_date": F.lit(as_date(day).isoformat()),
                "times_late": F.coalesce("late", F.lit(0)),
                "max_days_late": F.coalesce("longest", F.lit(0)),
                "fees_collected": F.coalesce("charged", F.lit(0.0)),
                "payment_history": F.coalesce("payer", F.lit(NEVER_LATE)),
                "daily_spending": F.coalesce("spent", F.lit(0.0)),
                "client_type": F.coalesce("spender", F.lit(NO_SPENDING)),
                "payment_burden_percent": burden,
            }
        )
        .withColumn("total_revenue", F.col("total_interest") + F.col("fees_collected"))
        .withColumn("profit_ratio", F.round(F.col("total_revenue") / F.col("principal_amount"), 3))
        .withColumn("risk_score", score)
        .withColumns(
            {
                "risk_level": at_least(F.col("risk_score"), RISK_LEVELS, LOW_RISK),
                "profit_level": at_least(F.col("profit_ratio"), PROFIT_LEVELS, LOW_PROFIT),
                "recommendation": _recommendation(),
            }
        )
        .select(*LOAN_COLUMNS)
    )


def loan_run_summary(report: DataFrame) -> DataFrame:
    counts = report.agg(
        F.count("*").alias("total_loans"),
        F.count_if(F.col("risk_level") == "Risky").alias("high_risk_loans"),
        F.avg("risk_score").alias("avg_risk_score"),
    )
    share = F.round(F.try_divide("high_risk_loans", "total_loans") * 100, 1)
    return counts.withColumn("high_risk_percent", share)


# Fixed values of the spending report. All other categories, and none, are "other".
SPENDING_CATEGORIES = ["groceries", "food", "entertainment", "shopping", "transport", "bills"]
RISK_INDICATORS = [(0.8, "High Risk"), (0.5, "Medium Risk"), (0, "Low Risk")]
NO_RATIO = "Unknown"


def client_spending(sales: DataFrame, day: date | str) -> DataFrame:
    """Totals of the day per client: amounts, counts, weekend split, one column per category."""
    bought = sales_of_day(sales, day)
    hour = F.hour("transaction_date")
    weekend = F.dayofweek("transaction_date").isin(1, 7)

    def spent(rows=None):
        exact = F.col("exact") if rows is None else F.when(rows, F.col("exact")).otherwise(0)
        return from_exact(F.sum(exact))

    known = F.coalesce(F.col("category").isin(SPENDING_CATEGORIES), F.lit(False))
    return bought.groupBy("client_id").agg(
        F.sum("exact").alias("exact"),
        spent().alias("total_spent"),
        F.count("*").alias("transaction_count"),
        F.round(from_exact(F.sum("exact")) / F.count("*"), 2).alias("avg_transaction"),
        F.max("amount").alias("max_transaction"),
        F.min("amount").alias("min_transaction"),
        F.count_distinct("merchant").alias("unique_merchants"),
        F.count_distinct("category").alias("unique_categories"),
        spent(weekend).alias("weekend_spending"),
        spent(~weekend).alias("weekday_spending"),
        F.count_if(hour.between(6, 11)).alias("morning_transactions"),
        F.count_if(hour.between(18, 22)).alias("evening_transactions"),
        *[spent(F.col("category").eqNullSafe(c)).alias(f"{c}_spent") for c in SPENDING_CATEGORIES],
        spent(~known).alias("other_spent"),
    )


def _favourite_merchants(bought: DataFrame) -> DataFrame:
    totals = bought.groupBy("client_id", "merchant").agg(F.sum("exact").alias("exact"))
    most = Window.partitionBy("client_id").orderBy(F.desc("exact"), "merchant")
    return (
        totals.withColumn("place", F.row_number().over(most))
        .where("place = 1")
        .select(
            "client_id",
            F.col("merchant").alias("favorite_merchant"),
            from_exact(F.col("exact")).alias("favorite_merchant_spending"),
        )
    )


def _client_accounts(accounts: DataFrame, day: date | str) -> DataFrame:
    """Accounts opened up to the day: balance, number, and the kind of the largest."""
    opened = accounts.where(F.col("open_date") < F.date_add(F.lit(as_date(day)), 1))
    largest = F.max(F.struct("opening_balance", "account_type"))
    return (
        opened.where("client_id is not null and opening_balance is not null")
        .groupBy("client_id")
        .agg(
            exact_sum(F.col("opening_balance")).alias("total_opening_balance"),
            F.count("*").alias("account_count"),
            largest["account_type"].alias("primary_account_type"),
        )
    )


def _segment() -> Column:
    spent, mean = F.col("total_spent"), F.col("avg_transaction")
    return (
        F.when((spent > 2000) & (F.col("diversity_score") > 5), "VIP - High Value")
        .when(F.col("weekend_ratio") > 60, "Weekend Warrior")
        .when((F.col("unique_merchants") <= 3) & (F.col("transaction_count") > 8), "Routine Shopper")
        .when(mean < 50, "Bargain Hunter")
        .when(F.col("max_transaction") > mean * 5, "Impulsive Buyer")
        .otherwise("Regular Customer")
    )


def _tier() -> Column:
    spent, mean = F.col("total_spent"), F.col("avg_spending_all_clients")
    return (
        F.when(spent > mean + F.col("stddev_spending"), "High Spender")
        .when(spent > mean, "Above Average")
        .when(spent.between(F.col("percentile_25"), F.col("percentile_75")), "Average")
        .otherwise("Low Spender")
    )


def daily_spending_analytics(sales: DataFrame, accounts: DataFrame, day: date | str) -> DataFrame:
    """One row per client with sales that day: spending profile, segment and risk."""
    clients = client_spending(sales, day)
    totals = clients.select("exact", "total_spent")
    overall = totals.agg(
        F.struct(
            (from_exact(F.sum("exact")) / F.count("*")).alias("mean"),
            F.stddev_samp("total_spent").alias("deviation"),
        )
    )
    quartiles = exact_quantiles(totals, "exact", [0.25, 0.75]).select(F.struct("*"))
    spent, balance = F.col("total_spent"), F.col("total_opening_balance")
    by_category = [f"{c}_spent" for c in [*SPENDING_CATEGORIES, "other"]]
    largest = F.col("max_category_spending")
    preference = F.coalesce(*[F.when(F.col(f"{c}_spent") == largest, c) for c in SPENDING_CATEGORIES], F.lit("other"))
    mornings = F.col("morning_transactions") > F.col("evening_transactions")
    report = (
        clients.withColumns({"overall": overall.scalar(), "quartiles": quartiles.scalar()})
        .join(_favourite_merchants(sales_of_day(sales, day)), "client_id", "left")
        .join(_client_accounts(accounts, day), "client_id", "left")
        .withColumns(
            {
                "avg_spending_all_clients": F.col("overall.mean"),
                "stddev_spending": F.col("overall.deviation"),
                "percentile_25": from_exact(F.col("quartiles.q0")),
                "percentile_75": from_exact(F.col("quartiles.q1")),
                "spending_frequency": F.round(F.col("transaction_count") / 24, 2),
                "weekend_ratio": F.round(F.try_divide("weekend_spending", "total_spent") * 100, 1),
                "diversity_score": F.round((F.col("unique_merchants") + F.col("unique_categories")) / 2, 1),
                "spending_to_balance_ratio": F.round(F.try_divide(spent, balance), 3),
                "max_category_spending": F.greatest(*by_category),
            }
        )
        .withColumns(
            {
                "spending_tier": _tier(),
                "customer_segment": _segment(),
                "shopping_preference": preference,
                "risk_indicator": above(F.col("spending_to_balance_ratio"), RISK_INDICATORS, NO_RATIO),
                "time_preference": F.when(mornings, "Morning Person").otherwise("Evening Person"),
            }
        )
        .drop("exact", "overall", "quartiles")
    )
    return report.select(F.lit(as_date(day).isoformat()).alias("report_date"), "*")


def spending_run_summary(report: DataFrame) -> DataFrame:
    counts = report.agg(
        F.count("*").alias("total_clients"),
        F.count_if(F.col("customer_segment") == "VIP - High Value").alias("vip_clients"),
        F.count_if(F.col("risk_indicator") == "High Risk").alias("high_risk_clients"),
        F.try_divide(from_exact(F.sum(to_exact(F.col("total_spent")))), F.count("*")).alias("avg_spending"),
    )

    def share(part: str):
        return F.round(F.try_divide(part, "total_clients") * 100, 1)

    return counts.withColumns(
        {"vip_percent": share("vip_clients"), "high_risk_percent": share("high_risk_clients")}
    )


def marketing_actions(report: DataFrame) -> DataFrame:
    """What to offer each client of the spending report."""
    segment = F.col("customer_segment")
    action = (
        F.when(segment == "VIP - High Value", "Offer Premium Services")
        .when(segment == "Bargain Hunter", "Send Discount Offers")
        .when(segment == "Weekend Warrior", "Weekend Promotions")
        .when(F.col("risk_indicator") == "High Risk", "Financial Advisory Needed")
        .otherwise("Standard Marketing")
    )
    return report.select(
        "report_date", "client_id", "customer_segment", "risk_indicator", action.alias("marketing_action")
    )
