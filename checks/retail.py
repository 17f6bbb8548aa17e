"""Check queries of the retail operators."""

from __future__ import annotations

from checks.registry import Check, day_sum, rounded, total
from checks.views import AS_OF, DOMAIN, RESTRICTED, RULES, TARGET, YEAR, wednesday
from shopbank.operators import (
    baskets,
    customers,
    discounts,
    items,
    names,
    prices,
    products,
    quality,
    recommend,
    revenue,
    trends,
)

START, END = f"{YEAR}-01-01", f"{YEAR}-12-31"


def in_year(column: str) -> str:
    return f"{column} >= date '{YEAR}-01-01' and {column} < date '{YEAR + 1}-01-01'"


KINDS = r"(?:Str\.|Strada|Bd\.|Bulevardul|Calea|Aleea|Splaiul)"
STREET = (
    rf"trim(regexp_extract(address, '{KINDS}\s+([A-Za-zĂÂÎȘȚăâîșț\- ]+?)(?:\s*,|\s*nr\.|\s+\d)', 1))"
)
NUMBER = r"""coalesce(nullif(regexp_extract(address, 'nr\.?\s*(\d+)', 1, 'i'), ''),
    list_extract(regexp_extract_all(address, '\b(\d{1,4})\b', 1), -1))"""
DIGITS = "regexp_replace(phone_number, '[^0-9]', '', 'g')"
CARD_TYPE = "case when json_valid(fidelity_card) then json_extract_string(fidelity_card, '$.type') end"
CARD_DATE = "try_cast(json_extract_string(fidelity_card, '$.issue_date') as date)"


def age_group(age: str) -> str:
    return f"""case when {age} is null then 'unknown' when {age} < 18 then 'underage' when {age} < 25 then '[18-25)'
      when {age} < 35 then '[25-35)' when {age} < 50 then '[35-50)' when {age} < 65 then '[50-65)' else '65+' end"""


AGE = f"cast(datesub('year', birth_date, date '{AS_OF}') as int)"
AGES = f"""ages as (
  select *, {CARD_TYPE} as fidelity_type, {CARD_DATE} as fidelity_issue_date, {AGE} as age_years,
    {age_group(AGE)} as age_group
  from customers where birth_date is not null)"""
PROFILE = f"""profile as (
  select *, {CARD_TYPE} as fidelity_type, {AGE} as age_years, {age_group(AGE)} as age_group,
    case when email like '%@%' then split_part(lower(email), '@', 2) end as email_provider,
    regexp_matches(phone_number, '^\\s*(\\+?\\s*40|0040)') as prefixed
  from customers)"""
TENURE = f"""{AGES}, tenure as (
  select customer_id, city, fidelity_type, fidelity_issue_date,
    cast(datesub('year', fidelity_issue_date, date '{AS_OF}') as int) as tenure_years
  from ages where fidelity_issue_date is not null)"""
MATCHED = """matched as (
  select d.discount_id, d.product_id, d.valid_from, d.valid_to, count(*) as purchase_count,
    cast(sum(t.quantity) as bigint) as units_sold
  from transactions t join discounts d on t.product_id = d.product_id
    and cast(t.transaction_date as date) between d.valid_from and d.valid_to
  group by all)"""
ENDS = """outer_prices as (
  select product_id, min({'day': valid_date, 'price': price}) as first, max({'day': valid_date, 'price': price}) as last
  from prices group by product_id),
ends as (
  select product_id, first['price'] as first_price, first['day'] as first_date, last['price'] as last_price, last['day'] as last_date,
    (last['price'] - first['price']) / first['price'] as delta_pct
  from outer_prices)"""
LAGGED = f"""lagged as (
  select product_id, price, lag(price) over (partition by product_id order by valid_date, price) as prev
  from prices where {in_year('valid_date')})"""
GRID = """days as (
  select cast(unnest(generate_series(min(valid_date), max(valid_date), interval 1 day)) as date) as valid_date from prices),
grid as (select product_id, valid_date from products cross join days),
per_day as (select product_id, valid_date, max(price) as price from prices group by all)"""
YEAR_LINES = f"lines as (select *, cast(transaction_date as date) as the_date from transactions where {in_year('transaction_date')})"
FLAGGED = """covered as (
  select distinct product_id, cast(unnest(generate_series(valid_from, valid_to, interval 1 day)) as date) as day
  from discounts),
flagged as (
  select t.*, t.quantity * t.unit_price_at_purchase as revenue, c.day is not null as on_discount
  from transactions t left join covered c on c.product_id = t.product_id and c.day = cast(t.transaction_date as date))"""
SPENT = total("quantity * unit_price_at_purchase")


def taxed(where: str) -> str:
    return f"""sold as (
  select product_id, {total('quantity * unit_price_at_purchase')} as revenue
  from transactions where {where} group by 1),
taxed as (
  select revenue, revenue * tva_rate / (tva_rate + 1) as tva
  from sold join products using (product_id))"""


def _ages(v):
    return customers.customer_ages(v.customers, AS_OF)


def _profile(v):
    return quality.profile_customers(v.customers, AS_OF)


def _lines(v):
    return trends.lines_of_year(v.transactions, YEAR)


def _clean(v):
    clean = customers.clean_customers(v.customers)
    card = "fidelity_card_struct"
    return clean.selectExpr(
        *[c for c in clean.columns if c != card],
        f"{card}.card_id as card_id", f"{card}.issue_date as card_issue_date", f"{card}.type as card_type",
    )


def _stats(v):
    return quality.email_domain_age_stats(_profile(v), DOMAIN).selectExpr(
        "customers", "avg_age", "round(stddev_age, 6) as stddev_age"
    )


def _forecast(v):
    fit = prices.inflation_prediction(v.prices, TARGET)
    figures = ["slope_per_week", "intercept", "base_avg_price", "predicted_avg_price", "inflation_pct"]
    return fit.selectExpr("history_start_week", "target_date", *[f"round({c}, 5) as {c}" for c in figures])


CHECKS = [
    # Data preparation
    Check("customers_clean", _clean, rf"""
select customer_id, first_name, last_name, birth_date, email, phone_number,
  case when regexp_matches({DIGITS}, '^(0040|40|0)[0-9]{{9}}$') then '+40' || right({DIGITS}, 9) end as phone_normalized,
  case substr(regexp_replace({DIGITS}, '^(00)?40([0-9]{{9}})', '0\2'), 1, 4)
    when '0744' then 'Orange' when '0722' then 'Vodafone' when '0772' then 'Digi' when '0735' then 'Telekom' end
    as mobile_operator,
  address, regexp_extract(address, '{KINDS}') as street_type, {STREET} as street_name, {NUMBER} as street_number,
  city, fidelity_card, customer_type, json_extract_string(fidelity_card, '$.card_id') as card_id,
  json_extract_string(fidelity_card, '$.issue_date') as card_issue_date,
  json_extract_string(fidelity_card, '$.type') as card_type
from customers"""),
    Check("missing_prices", lambda v: prices.missing_prices(v.prices, v.products), f"""
with {GRID} select product_id, valid_date from grid anti join per_day using (product_id, valid_date)"""),
    Check("prices_filled", lambda v: prices.filled_prices(v.prices, v.products), f"""
with {GRID}
select g.product_id, g.valid_date, p.price,
  last_value(p.price ignore nulls) over (partition by g.product_id order by g.valid_date) as price_filled
from grid g left join per_day p using (product_id, valid_date)"""),
    # Price changes
    Check("frequent_price_changes", lambda v: prices.frequent_price_changes(v.prices, YEAR), f"""
with {LAGGED} select product_id, count(*) as change_count from lagged where price <> prev group by 1"""),
    Check("never_decreased", lambda v: prices.never_decreased(v.prices, YEAR), f"""
with {LAGGED} select product_id, cast(count(*) filter (where price < prev) as bigint) as decrease_events
from lagged group by 1 having count(*) filter (where price < prev) = 0"""),
    Check("increase_before_discount", lambda v: prices.increase_before_discount(v.prices, v.discounts), f"""
with near_far as (
  select d.discount_id, d.product_id, d.valid_from,
    {total("p.price", "p.valid_date >= d.valid_from - 7")} / count(*) filter (where p.valid_date >= d.valid_from - 7) as price_near,
    {total("p.price", "p.valid_date < d.valid_from - 7")} / count(*) filter (where p.valid_date < d.valid_from - 7) as price_far
  from discounts d join prices p on p.product_id = d.product_id
    and p.valid_date between d.valid_from - 14 and d.valid_from - 1
  group by 1, 2, 3)
select * from near_far where price_near > price_far"""),
    Check("price_over_30_increase", lambda v: prices.price_increases(prices.first_and_last_prices(v.prices)), f"""
with {ENDS} select * from ends where delta_pct > 0.30"""),
    Check("top20_cheaper", lambda v: prices.top_cheaper(prices.first_and_last_prices(v.prices)), f"""
with {ENDS} select * from ends where delta_pct < 0 order by delta_pct, product_id limit 20"""),
    Check("inflation_prediction", _forecast, f"""
with weekly as (
  select {wednesday('valid_date')} as week, {total('price')} / count(*) as p from prices group by 1),
numbered as (select week, p, cast(row_number() over (order by week) - 1 as double) as t from weekly),
fit as (
  select min(week) as w, coalesce(regr_slope(p, t), 0) as slope, avg(p) as mp, avg(t) as mt, arg_min(p, week) as base
  from numbered),
line as (
  select *, mp - slope * mt as icpt, floor(datediff('day', w, date '{TARGET}') / 7) as ahead from fit),
forecast as (select *, icpt + slope * ahead as predicted from line)
select w as history_start_week, date '{TARGET}' as target_date, round(slope, 5) as slope_per_week,
  round(icpt, 5) as intercept, round(base, 5) as base_avg_price, round(predicted, 5) as predicted_avg_price,
  round((predicted / base - 1) * 100, 5) as inflation_pct
from forecast"""),
    # Price aggregation
    Check("weekly_avg_price_by_category", lambda v: prices.weekly_avg_price_by_category(v.prices, v.products), f"""
select category, {wednesday('valid_date')} as week_start, {rounded(total('price') + ' / count(*)', 2)} as avg_price
from prices join products using (product_id) group by 1, 2"""),
    Check("net_and_tax_per_product", lambda v: prices.net_and_tax_per_product(v.prices, v.products), f"""
with latest as (
  select *, row_number() over (partition by product_id order by valid_date desc, price desc) as n from prices),
taxed as (
  select product_id, product_name, valid_date as price_date, price as gross_price, tva_rate,
    {rounded('price * tva_rate / (tva_rate + 1)', 4)} as tva_amount
  from latest join products using (product_id) where n = 1)
select *, {rounded('gross_price - tva_amount', 4)} as net_price from taxed"""),
    # Categories
    Check("inferred_categories", lambda v: products.inferred_categories(v.products, RULES), f"""
select product_id, product_name, category as original_category,
  case when category <> 'ALTELE' then category
    {' '.join(f"when contains(lower(product_name), '{word}') then '{c}'" for word, c in RULES)} end as inferred_category
from products"""),
    Check("age_restricted_categories", lambda v: products.age_restricted_categories(v.products, RESTRICTED), """
select distinct category from products where category in ('PROMO', 'SMALL')"""),
    # Discounts
    Check("avg_discount_per_week", lambda v: discounts.avg_discount_per_week(v.discounts), f"""
select valid_from as week_start,
  {rounded(total('discount_percentage') + ' / count(*)', 4)} as avg_discount_pct
from discounts group by 1"""),
    Check("discounts_per_category", lambda v: discounts.discounts_per_category(v.discounts, v.products, YEAR), f"""
select category, count(*) as discount_events from discounts join products using (product_id)
where {in_year('valid_from')} group by 1"""),
    Check("frequent_discount_products", lambda v: discounts.frequent_discount_products(v.discounts), """
select product_id, count(*) as discount_count from discounts group by 1 having count(*) >= 3"""),
    Check("discounted_prices", lambda v: discounts.discounted_prices(v.discounts, v.prices), f"""
select d.discount_id, d.product_id, d.valid_from, d.valid_to, d.discount_percentage, p.price as gross_price,
  {rounded('p.price * (1 - d.discount_percentage)', 2)} as price_with_fidelity,
  {rounded('p.price * (1 - d.discount_percentage * 0.5::double)', 2)} as price_without_fidelity
from discounts d join prices p on p.product_id = d.product_id and p.valid_date = d.valid_from"""),
    Check("purchases_during_discount", lambda v: discounts.purchases_during_discount(v.transactions, v.discounts), f"""
with {MATCHED} select * from matched"""),
    Check(
        "never_purchased_discounted",
        lambda v: discounts.never_purchased_discounted(
            v.discounts, discounts.purchases_during_discount(v.transactions, v.discounts)
        ),
        f"""
with {MATCHED} select distinct product_id from discounts where product_id not in (select product_id from matched)"""),
    Check(
        "missed_savings",
        lambda v: discounts.missed_savings(v.transactions, v.discounts, v.prices, v.customers),
        f"""
with bought as (
  select t.product_id, cast(t.transaction_date as date) as day, sum(t.quantity) as quantity
  from transactions t join customers using (customer_id) where fidelity_card is null group by 1, 2),
priced as (
  select product_id, valid_date as day, {total('price')} as price from prices group by 1, 2)
select {rounded(total('price * discount_percentage * 0.5::double * quantity'), 2)} as total_missed_savings
from bought join priced using (product_id, day) join discounts using (product_id)
where day between valid_from and valid_to"""),
    # Demographics
    Check(
        "customer_ages",
        lambda v: _ages(v).select(
            "customer_id", "birth_date", "city", "fidelity_type", "fidelity_issue_date", "age_years", "age_group"
        ),
        f"""
with {AGES} select customer_id, birth_date, city, fidelity_type, fidelity_issue_date, age_years, age_group from ages"""),
    Check("age_group_by_city", lambda v: customers.age_group_by_city(_ages(v)), f"""
with {AGES} select city, age_group, count(*) as customer_count from ages where city is not null group by 1, 2"""),
    Check("youngest_oldest_by_city", lambda v: customers.youngest_oldest_by_city(_ages(v)), f"""
with {AGES}, ranked as (
  select *, row_number() over (partition by city order by birth_date desc, customer_id desc) as y,
    row_number() over (partition by city order by birth_date, customer_id) as o
  from ages where city is not null)
select a.city, a.customer_id as youngest_customer_id, a.birth_date as youngest_birth_date, a.age_years as youngest_age,
  b.customer_id as oldest_customer_id, b.birth_date as oldest_birth_date, b.age_years as oldest_age
from ranked a join ranked b on a.city = b.city where a.y = 1 and b.o = 1"""),
    Check("avg_age_by_city", lambda v: customers.avg_age_by_city(_ages(v)), f"""
with {AGES} select city, avg(age_years) as avg_age from ages where city is not null group by 1"""),
    Check("avg_age_by_card_type", lambda v: customers.avg_age_by_card_type(_ages(v)), f"""
with {AGES} select fidelity_type, avg(age_years) as avg_age from ages where fidelity_type is not null group by 1"""),
    Check("underage_count", lambda v: customers.underage_count(_ages(v)), f"""
with {AGES} select count(*) as underage_customers from ages where age_years < 18"""),
    Check("card_tenure", lambda v: customers.card_tenure(_ages(v), AS_OF), f"""
with {TENURE} select * from tenure"""),
    Check("top5_tenure_by_city", lambda v: customers.top_tenure_by_city(customers.card_tenure(_ages(v), AS_OF)), f"""
with {TENURE}, ranked as (
  select *, cast(row_number() over (partition by city order by tenure_years desc, fidelity_issue_date, customer_id)
    as int) as rank from tenure)
select * from ranked where rank <= 5"""),
    Check("card_before_25", lambda v: customers.card_before_25(_ages(v)), f"""
with {AGES}, issued as (
  select customer_id, birth_date, fidelity_issue_date,
    -- whole years, rounded down for cards issued before birth
    cast(year(fidelity_issue_date) - year(birth_date) - case when (month(fidelity_issue_date), day(fidelity_issue_date))
      < (month(birth_date), day(birth_date)) then 1 else 0 end as int) as age_at_issue
  from ages where fidelity_issue_date is not null)
select *, age_at_issue < 25 as got_card_before_25 from issued"""),
    # Data quality
    Check("missing_address_by_card", lambda v: quality.missing_address_by_card(_profile(v)), f"""
with {PROFILE} select coalesce(fidelity_type, 'no_card') as fidelity_type, count(*) as total,
  count(*) filter (where address is null) as missing_address from profile group by 1"""),
    Check("missing_contact_counts", lambda v: quality.missing_contact_counts(_profile(v)), """
select count(*) as total_customers, count(*) filter (where phone_number is null) as missing_phone,
  count(*) filter (where email is null) as missing_email,
  count(*) filter (where phone_number is null and email is null) as missing_both from customers"""),
    Check("phone_prefix_share", lambda v: quality.phone_prefix_share(_profile(v)), f"""
with {PROFILE} select count(phone_number) as customers_with_phone, count(*) filter (where prefixed) as with_country_prefix,
  count(*) filter (where prefixed) / count(phone_number) as ratio_with_prefix from profile"""),
    Check("phone_any_share", lambda v: quality.phone_any_share(_profile(v)), """
select count(*) as total_customers, count(phone_number) as customers_with_phone,
  count(phone_number) / count(*) as ratio_with_phone from customers"""),
    Check("age_group_missing_phone", lambda v: quality.age_group_missing_phone(_profile(v)), f"""
with {PROFILE} select age_group, count(*) as missing_phone_count from profile where phone_number is null group by 1"""),
    Check("email_providers", lambda v: quality.email_providers(_profile(v)), f"""
with {PROFILE} select email_provider, count(*) as customer_count from profile where email_provider is not null group by 1"""),
    Check("corporate_email_age_stats", _stats, f"""
with {PROFILE} select count(*) as customers, avg(age_years) as avg_age, round(stddev_samp(age_years), 6) as stddev_age
from profile where email_provider = '{DOMAIN}'"""),
    # Names and addresses
    Check("common_streets_by_city", lambda v: names.common_streets_by_city(v.customers), f"""
with counted as (
  select city, {STREET} as street_name, count(*) as occurrences from customers
  where address is not null and city is not null group by 1, 2),
ranked as (
  select *, cast(row_number() over (partition by city order by occurrences desc, street_name) as int) as rank
  from counted where street_name <> '')
select * from ranked where rank <= 5"""),
    Check("common_family_names", lambda v: names.common_family_names(v.customers), """
select last_name, count(*) as occurrences from customers where last_name is not null group by 1"""),
    Check("identical_full_names", lambda v: names.identical_full_names(v.customers), """
select lower(first_name || ' ' || last_name) as full_name, count(*) as customer_count
from customers where last_name is not null group by 1 having count(*) > 1"""),
    # Customer metrics
    Check("products_per_customer", lambda v: baskets.products_per_customer(v.transactions), """
select customer_id, cast(sum(quantity) as bigint) as total_items, count(distinct product_id) as distinct_products,
  count(distinct transaction_id) as transactions from transactions group by 1"""),
    Check("basket_by_payment", lambda v: baskets.basket_by_payment(v.transactions), f"""
with baskets as (
  select transaction_id, payment_method, sum(quantity) as items, {SPENT} as amount from transactions group by 1, 2)
select payment_method, {rounded('sum(items) / count(*)', 2)} as avg_items_per_basket,
  {rounded(total('amount') + ' / count(*)', 2)} as avg_amount_per_basket, count(*) as baskets
from baskets group by 1"""),
    Check("card_vs_no_card", lambda v: baskets.card_vs_no_card(v.transactions, v.customers), f"""
with groups as (
  select case when fidelity_card is not null then 'fidelity' else 'no_fidelity' end as "group",
    count(distinct customer_id) as customers, {SPENT} as total_spent, cast(sum(quantity) as bigint) as total_items
  from transactions join customers using (customer_id) group by 1)
select *, {rounded('total_spent / customers', 2)} as avg_spent_per_customer from groups"""),
    Check("top10_spenders", lambda v: baskets.top_spenders(v.transactions, YEAR), f"""
select customer_id, {rounded(SPENT, 2)} as total_spent from transactions where {in_year('transaction_date')}
group by 1 order by 2 desc, 1 limit 10"""),
    Check("top10_buyers", lambda v: baskets.top_buyers(v.transactions, YEAR), f"""
select customer_id, cast(sum(quantity) as bigint) as total_items from transactions where {in_year('transaction_date')}
group by 1 order by 2 desc, 1 limit 10"""),
    Check(
        "underage_restricted",
        lambda v: baskets.underage_restricted(v.transactions, v.customers, v.products, AS_OF, RESTRICTED),
        f"""
with {AGES} select customer_id, category, cast(sum(quantity) as bigint) as items_bought
from transactions join ages using (customer_id) join products using (product_id)
where age_years < 18 and category in ('PROMO', 'SMALL') group by 1, 2"""),
    # Item metrics
    Check("most_purchased", lambda v: items.most_purchased(v.transactions), """
select product_id, cast(sum(quantity) as bigint) as total_units, count(distinct transaction_id) as transactions
from transactions group by 1"""),
    Check("bought_together", lambda v: items.bought_together(v.transactions), """
with items as (select distinct transaction_id, product_id from transactions)
select a.product_id as product_a, b.product_id as product_b, count(*) as co_occurrences
from items a join items b on a.transaction_id = b.transaction_id and a.product_id < b.product_id group by 1, 2"""),
    Check("top10_december", lambda v: items.top_of_month(v.transactions), """
select product_id, cast(sum(quantity) as bigint) as units_in_december from transactions where month(transaction_date) = 12
group by 1 order by 2 desc, 1 limit 10"""),
    Check("category_most_discounts", lambda v: discounts.discounts_per_category(v.discounts, v.products), """
select category, count(*) as discount_events from discounts join products using (product_id) group by 1"""),
    # Temporal trends
    Check("closure_days", lambda v: trends.closure_days(_lines(v), YEAR), f"""
with {YEAR_LINES}, days as (
  select cast(unnest(generate_series(date '{START}', date '{END}', interval 1 day)) as date) as the_date)
select the_date from days where the_date not in (select the_date from lines)"""),
    Check("busiest_month", lambda v: trends.busiest_month(_lines(v)), f"""
with {YEAR_LINES} select cast(month(the_date) as int) as month, {day_sum} as total_items from lines group by 1"""),
    Check("top10_days", lambda v: trends.top_days(_lines(v)), f"""
with {YEAR_LINES} select the_date, {day_sum} as total_items from lines group by 1 order by 2 desc, 1 limit 10"""),
    Check("peak_hour_per_day", lambda v: trends.peak_hour_per_day(_lines(v)), f"""
with {YEAR_LINES}, hourly as (
  select the_date, cast(hour(transaction_date) as int) as peak_hour, {day_sum} as items from lines group by 1, 2),
ranked as (select *, row_number() over (partition by the_date order by items desc, peak_hour) as n from hourly)
select the_date, peak_hour, items from ranked where n = 1"""),
    Check("hourly_item_stats", lambda v: trends.hourly_item_stats(_lines(v)), f"""
with {YEAR_LINES}, hourly as (
  select the_date, cast(hour(transaction_date) as int) as hour, {day_sum} as items from lines group by 1, 2)
select hour, min(items) as min_items, max(items) as max_items, avg(items) as avg_items from hourly group by 1"""),
    Check("max_tx_open_close", lambda v: trends.max_tx_open_close(_lines(v)), f"""
with {YEAR_LINES}, counted as (
  select case hour(transaction_date) when 7 then 'opening' else 'closing' end as slot, the_date,
    count(distinct transaction_id) as tx_count
  from lines where hour(transaction_date) in (7, 21) group by 1, 2),
ranked as (select *, row_number() over (partition by slot order by tx_count desc, the_date) as n from counted)
select slot, the_date, tx_count from ranked where n = 1"""),
    Check("daily_distribution", lambda v: trends.daily_distribution(_lines(v)), f"""
with {YEAR_LINES} select cast(dayofweek(the_date) + 1 as int) as dow, count(distinct customer_id) as unique_customers,
  count(distinct transaction_id) as transactions, {day_sum} as items from lines group by 1"""),
    Check("friday_trends", lambda v: trends.friday_trends(_lines(v)), f"""
with {YEAR_LINES} select the_date, count(distinct transaction_id) as transactions, {day_sum} as items
from lines where dayofweek(the_date) = 5 group by 1"""),
    # Revenue and tax
    Check("flagged_sales", lambda v: revenue.flagged_sales(v.transactions, v.discounts), f"""
with {FLAGGED} select transaction_id, customer_id, product_id, transaction_date, quantity,
  unit_price_at_purchase as unit_price, revenue, on_discount from flagged"""),
    Check("revenue_totals", lambda v: revenue.revenue_totals(v.transactions, v.discounts, YEAR), f"""
with {FLAGGED} select {rounded(total('revenue'), 2)} as total_income,
  {rounded(total('revenue', 'not on_discount'), 2)} as income_excl_discount,
  {rounded(total('revenue', 'on_discount'), 2)} as income_only_discount
from flagged where {in_year('transaction_date')}"""),
    Check("revenue_monthly", lambda v: revenue.revenue_monthly(v.transactions, YEAR), f"""
with {YEAR_LINES} select cast(month(the_date) as int) as month, {rounded(SPENT, 2)} as monthly_income
from lines group by 1"""),
    Check("tax_total", lambda v: revenue.tax_total(v.transactions, v.products, YEAR), f"""
with {taxed(in_year('transaction_date'))} select {rounded(total('tva'), 2)} as total_tva_{YEAR} from taxed"""),
    Check(
        "tax_refundable_legal",
        lambda v: revenue.tax_refundable_legal(v.transactions, v.products, v.customers, YEAR),
        f"""
with {taxed(in_year('transaction_date') + " and customer_id in (select customer_id from customers "
            "where customer_type = 'persoana_juridica')")}
select {rounded(total('revenue'), 2)} as legal_entities_revenue, {rounded(total('tva'), 2)} as refundable_tva
from taxed"""),
    # Recommendations
    Check("next_products", lambda v: recommend.next_products(v.transactions, v.products), """
with bought as (
  select customer_id, product_id, category, sum(quantity) as units
  from transactions join products using (product_id) group by 1, 2, 3),
favourites as (
  select customer_id, category from (
    select customer_id, category, row_number() over (partition by customer_id order by sum(units) desc, category) as n
    from bought group by 1, 2) where n <= 3),
popular as (
  select category, product_id, popularity from (
    select category, product_id, cast(sum(units) as bigint) as popularity,
      row_number() over (partition by category order by sum(units) desc, product_id) as n
    from bought group by 1, 2) where n <= 10),
fresh as (
  select f.customer_id, p.* from favourites f join popular p using (category)
  where not exists (select 1 from bought b where b.customer_id = f.customer_id and b.product_id = p.product_id)),
ranked as (
  select *, cast(row_number() over (partition by customer_id order by popularity desc, product_id) as int)
    as recommendation_rank from fresh)
select * from ranked where recommendation_rank <= 5"""),
]
