"""Check queries of the bank reports and the user-activity operators."""

from __future__ import annotations

from checks.registry import Check, rounded, total
from checks.views import DAY
from shopbank.operators import activity, bank

LATENCY_AS_OF = "1998-12-31"
RECENT_AS_OF = "2024-01-25"

ON_DAY = f"{{0}} >= timestamp '{DAY}' and {{0}} < timestamp '{DAY}' + interval 1 day"
SALES = f"""day_sales as (
  select transaction_id, client_id, transaction_date, amount, merchant, lower(category) as category
  from sales where amount > 0 and {ON_DAY.format('transaction_date')})"""

#: Fixed values of the reports. Bands: how a value passes a bound, the bounds, and a label for each number of bounds passed.
BANDS = {
    "loan_size": (">=", [10000, 30000], ["Small Loan", "Medium Loan", "Large Loan"]),
    "rate": (">", [5, 8], ["Low Rate", "Normal Rate", "High Rate"]),
    "payment": (">", [10, 30], ["Pretty Good", "Sometimes Forgets", "Bad at Paying"]),
    "spending": (">", [100, 300], ["Saves Money", "Spends Normal", "Spends Lots"]),
    "burden": (">", [25, 40], ["light", "heavy", "too heavy"]),
    "risk": (">=", [3, 6], ["Pretty Safe", "Kinda Risky", "Risky"]),
    "profit": (">=", [0.10, 0.15, 0.20], ["Makes Little Money", "Makes Some Money", "Makes Good Money", "Makes Lots of Money"]),
    "balance": (">", [0, 0.5, 0.8], ["Unknown", "Low Risk", "Medium Risk", "High Risk"]),
}
#: Risk points by band.
POINTS = {"payment": [0, 1, 3], "rate": [0, 1, 3], "burden": [0, 1, 2], "loan_size": [0, 0, 2]}
#: Rules of which the first that holds gives the label; the last holds always.
RULES = {
    "recommendation": [
        ("Great Customer - Give Them More!", "profit_ratio >= 0.20 and not coalesce(worst_delay > 10, false)"),
        ("Watch Out - Might Be Trouble", "worst_delay > 30 and profit_ratio < 0.15"),
        ("Good Loan - Keep It", "profit_ratio >= 0.15"),
        ("Normal Loan", "true"),
    ],
    "customer_segment": [
        ("VIP - High Value", "total_spent > 2000 and diversity_score > 5"),
        ("Weekend Warrior", "weekend_ratio > 60"),
        ("Routine Shopper", "unique_merchants <= 3 and transaction_count > 8"),
        ("Bargain Hunter", "avg_transaction < 50"),
        ("Impulsive Buyer", "max_transaction > avg_transaction * 5"),
        ("Regular Customer", "true"),
    ],
    "spending_tier": [
        ("High Spender", "total_spent - avg_spending_all_clients > deviation"),
        ("Above Average", "total_spent > avg_spending_all_clients"),
        ("Average", "total_spent between low_quarter and high_quarter"),
        ("Low Spender", "true"),
    ],
    "marketing_action": [
        ("Offer Premium Services", "customer_segment = 'VIP - High Value'"),
        ("Send Discount Offers", "customer_segment = 'Bargain Hunter'"),
        ("Weekend Promotions", "customer_segment = 'Weekend Warrior'"),
        ("Financial Advisory Needed", "risk_indicator = 'High Risk'"),
        ("Standard Marketing", "true"),
    ],
}
CATEGORIES = ["groceries", "food", "entertainment", "shopping", "transport", "bills"]


def passed(band: str, value: str) -> str:
    """Number of bounds that a value passes, from 1 for none, as places of lists count; none for null."""
    sign, bounds, _ = BANDS[band]
    return "1 + " + " + ".join(f"coalesce({value} {sign} {bound}, false)::int" for bound in bounds)


def label(band: str, value: str) -> str:
    return f"{BANDS[band][2]}[{passed(band, value)}]"


def points(band: str, value: str) -> str:
    return f"{POINTS[band]}[{passed(band, value)}]"


def first_rule(name: str) -> str:
    return "coalesce(" + ", ".join(f"if({holds}, '{text}', null)" for text, holds in RULES[name]) + ")"


# DuckDB lets a column of a select be used in the ones behind it, so each report is one select over what is summed up before.
GROWTH = "pow(1 + interest_rate / 100 / 12, term_months)"
LOANS = f"""{SALES},
loan_report as (
  select '{DAY}' as report_date, loan_id, l.client_id as client_id, loan_type, principal_amount, interest_rate,
    {rounded(f'principal_amount * (interest_rate / 100 / 12 * {GROWTH}) / ({GROWTH} - 1)', 2)} as monthly_payment,
    {rounded('principal_amount * (interest_rate / 100) * (term_months / 12::double)', 2)} as total_interest,
    {label('loan_size', 'principal_amount')} as loan_size, {label('rate', 'interest_rate')} as rate_category,
    coalesce(late.fees, 0) as fees_collected, coalesce(late.n, 0) as times_late, coalesce(late.worst_delay, 0) as max_days_late,
    if(late.n is null, 'Always On Time', {label('payment', 'late.worst_delay')}) as payment_history,
    total_interest + fees_collected as total_revenue, {rounded('total_revenue / principal_amount', 3)} as profit_ratio,
    coalesce(spent.amount, 0) as daily_spending,
    if(spent.amount is null, 'Unknown', {label('spending', 'spent.amount')}) as client_type,
    if(daily_spending > 0, {rounded('monthly_payment / (daily_spending * 30) * 100', 1)}, null) as payment_burden_percent,
    cast({points('loan_size', 'principal_amount')} + {points('rate', 'interest_rate')} + {points('payment', 'late.worst_delay')}
      + {points('burden', 'payment_burden_percent')} as int) as risk_score,
    {label('risk', 'risk_score')} as risk_level, {label('profit', 'profit_ratio')} as profit_level,
    {first_rule('recommendation')} as recommendation
  from loans l
  left join (
    select client_id, {total('amount')} as amount from day_sales group by client_id) spent on spent.client_id = l.client_id
  left join (
    select loan_id as late_loan, count(*) as n, max(days_delayed) as worst_delay, {total('fee_amount')} as fees
    from delay_fees where {ON_DAY.format('fee_date')} and fee_amount > 0 group by loan_id) late on late_loan = loan_id
  where {ON_DAY.format('start_date')} and least(principal_amount, interest_rate) > 0)"""


def part(where: str) -> str:
    return f"coalesce({total('amount', where)}, 0)"


BY_CATEGORY = {f"{c}_spent": f"category = '{c}'" for c in CATEGORIES} | {"other_spent": f"coalesce(category not in {tuple(CATEGORIES)}, true)"}
#: Counts by part of the day, and sums by part of the week, as the reports draw the lines.
BY_TIME = {
    "morning_transactions": "count(*) filter (where hour(transaction_date) between 6 and 11)",
    "evening_transactions": "count(*) filter (where hour(transaction_date) between 18 and 22)",
    "weekend_spending": part("dayofweek(transaction_date) in (0, 6)"),
    "weekday_spending": part("dayofweek(transaction_date) between 1 and 5"),
}


def columns(named: dict[str, str]) -> str:
    return ", ".join(f"{value} as {name}" for name, value in named.items())


SPENDING = f"""{SALES},
by_merchant as (
  select client_id as buyer, max({{'spent': spent, 'reversed': -place, 'merchant': merchant}}) as best
  from (
    select client_id, merchant, {total('amount')} as spent, row_number() over (partition by client_id order by merchant) as place
    from day_sales group by client_id, merchant)
  group by client_id),
clients as (
  select client_id, count(*) as transaction_count, {total('amount')} as total_spent, min(amount) as min_transaction,
    max(amount) as max_transaction, {rounded('total_spent / transaction_count', 2)} as avg_transaction,
    count(distinct category) as unique_categories, count(distinct merchant) as unique_merchants, {columns(BY_TIME)},
    {columns({name: part(where) for name, where in BY_CATEGORY.items()})}
  from day_sales group by client_id),
spending_report as (
  select '{DAY}' as report_date, c.*, best.merchant as favorite_merchant, best.spent as favorite_merchant_spending,
    b.balance as total_opening_balance, b.accounts as account_count, b.largest.kind as primary_account_type,
    mean as avg_spending_all_clients, round(deviation, 6) as stddev_spending,
    round(low_quarter, 6) as percentile_25, round(high_quarter, 6) as percentile_75,
    {rounded('transaction_count / 24', 2)} as spending_frequency,
    {rounded('weekend_spending / nullif(total_spent, 0) * 100', 1)} as weekend_ratio,
    {rounded('(unique_merchants + unique_categories) / 2', 1)} as diversity_score,
    {rounded('total_spent / nullif(b.balance, 0)', 3)} as spending_to_balance_ratio,
    greatest({', '.join(BY_CATEGORY)}) as max_category_spending,
    {first_rule('spending_tier')} as spending_tier, {first_rule('customer_segment')} as customer_segment,
    {[c.removesuffix('_spent') for c in BY_CATEGORY]}[list_position([{', '.join(BY_CATEGORY)}], max_category_spending)] as shopping_preference,
    {label('balance', 'spending_to_balance_ratio')} as risk_indicator,
    if(morning_transactions > evening_transactions, 'Morning Person', 'Evening Person') as time_preference
  from clients c
  join by_merchant on buyer = client_id
  cross join (
    select {total('total_spent')} / count(*) as mean, stddev_samp(total_spent) as deviation,
      quantile_cont(total_spent, 0.25) as low_quarter, quantile_cont(total_spent, 0.75) as high_quarter from clients)
  left join (
    select client_id as owner, count(*) as accounts, {total('opening_balance')} as balance,
      max({{'amount': opening_balance, 'kind': account_type}}) as largest
    from accounts where open_date < timestamp '{DAY}' + interval 1 day group by client_id) b on owner = client_id)"""


def _loans(v):
    return bank.daily_loan_analytics(v.loans, v.delay_fees, v.sales, DAY)


def _spending(v):
    return bank.daily_spending_analytics(v.sales, v.accounts, DAY)


def _clock(seconds: str) -> str:
    return (
        f"case when {seconds} < 86400 then '0d 0h 0m' else format('{{:02d}}:{{:02d}}:{{:02d}}', "
        f"{seconds} // 3600, {seconds} % 3600 // 60, {seconds} % 60) end"
    )


def _rounded_spending(v):
    report = _spending(v)
    exact = {"stddev_spending", "percentile_25", "percentile_75"}
    return report.selectExpr(*[f"round({c}, 6) as {c}" if c in exact else c for c in report.columns])


VISITS = "select user_id, cast(hour(ts) as int) as hour, count(*) as visits from visits group by 1, 2"

CHECKS = [
    Check("daily_sales", lambda v: bank.daily_sales(v.sales, v.accounts, DAY), f"""
with spent as (
  select client_id, {total('amount')} as total_spent from sales
  where amount >= 0 and {ON_DAY.format('transaction_date')} group by 1),
opened as (
  select client_id, {total('opening_balance')} as opening_balance from accounts
  where opening_balance >= 0 and {ON_DAY.format('open_date')} group by 1)
select date '{DAY}' as event_date, client_id, coalesce(total_spent, 0) as total_spent,
  coalesce(opening_balance, 0) as opening_balance from spent full join opened using (client_id)"""),
    Check("daily_loan_analytics", _loans, f"with {LOANS} select * from loan_report"),
    Check("loan_run_summary", lambda v: bank.loan_run_summary(_loans(v)), f"""
with {LOANS} select count(*) as total_loans, count(*) filter (where risk_level = 'Risky') as high_risk_loans,
  avg(risk_score) as avg_risk_score,
  {rounded("count(*) filter (where risk_level = 'Risky') / count(*) * 100", 1)} as high_risk_percent from loan_report"""),
    Check("daily_spending_analytics", _rounded_spending, f"with {SPENDING} select * from spending_report"),
    Check("spending_run_summary", lambda v: bank.spending_run_summary(_spending(v)), f"""
with {SPENDING}, counted as (
  select count(*) as total_clients, count(*) filter (where customer_segment = 'VIP - High Value') as vip_clients,
    count(*) filter (where risk_indicator = 'High Risk') as high_risk_clients,
    {total('total_spent')} / count(*) as avg_spending from spending_report)
select *, {rounded('vip_clients / total_clients * 100', 1)} as vip_percent,
  {rounded('high_risk_clients / total_clients * 100', 1)} as high_risk_percent from counted"""),
    Check("marketing_actions", lambda v: bank.marketing_actions(_spending(v)), f"""
with {SPENDING} select report_date, client_id, customer_segment, risk_indicator,
  {first_rule('marketing_action')} as marketing_action
from spending_report"""),
    Check("recent_user_events", lambda v: activity.recent_user_events(v.user_events, v.users, RECENT_AS_OF), f"""
select e.*, u.country from user_events e join users u using (user_id)
where e.event_time >= date '{RECENT_AS_OF}' - interval 7 days"""),
    Check("visits_by_hour", lambda v: activity.visits_by_hour(v.visits), VISITS),
    Check(
        "latency_by_dataproduct",
        lambda v: activity.latency_by_dataproduct(v.latency_events, LATENCY_AS_OF),
        f"""
with delays as (
  select dataset, dataproduct, mandant, cast(epoch("timestamp") - epoch(refdate) as bigint) as s from latency_events
  where refdate >= date '{LATENCY_AS_OF}' - interval 30 days),
stats as (
  select dataset, dataproduct, mandant, count(*) as nr_of_events, min(s) as min_sec,
    cast(trunc(avg(s)) as bigint) as avg_sec, max(s) as max_sec from delays group by 1, 2, 3)
select *, {_clock('min_sec')} as min_time, {_clock('avg_sec')} as avg_time, {_clock('max_sec')} as max_time from stats"""),
    Check("sales_per_user", lambda v: activity.sales_per_user(v.user_sales), f"""
select user_id, {total('price * quantity')} as total_per_user from user_sales group by 1"""),
]
