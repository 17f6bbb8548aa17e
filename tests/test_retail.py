"""Retail operators against brute force in Python, with ties, duplicates, gaps and hot keys."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from itertools import combinations

import pytest
from conftest import rows

from shopbank.operators import baskets, discounts, items, prices, products, recommend, revenue, trends
from shopbank.sources import schemas

START = date(2025, 1, 1)


def days(n):
    return START + timedelta(days=n)


@pytest.fixture(scope="module")
def price_rows():
    # Product "hot" holds most rows, with many copies and several prices a day.
    random.seed(5)
    out = [("hot", days(random.randrange(40)), float(random.randrange(1, 6))) for _ in range(600)]
    out += [(f"p{i}", days(random.randrange(60)), float(random.randrange(1, 9))) for i in range(8) for _ in range(9)]
    out += [("p1", days(3), None), (None, days(3), 4.0), ("p2", None, 4.0), ("orphan", days(5), 2.0)]
    return out


@pytest.fixture(scope="module")
def price_table(spark, price_rows):
    return spark.createDataFrame([(None, *r) for r in price_rows], schemas.PRICES)


@pytest.fixture(scope="module")
def product_table(spark):
    names = ["hot", *[f"p{i}" for i in range(8)], "unpriced"]
    return spark.createDataFrame([(n, n, f"c{len(n)}", 0.25, 1.0, "false") for n in names], schemas.PRODUCTS)


def history(price_rows):
    by_product = defaultdict(list)
    for product, day, price in price_rows:
        if product and day and price is not None:
            by_product[product].append((day, price))
    return {p: sorted(h) for p, h in by_product.items()}


def brute_fill(price_rows, listed, first, last):
    known = history(price_rows)
    out = []
    for product in listed:
        day = first
        while day <= last:
            today = [p for d, p in known.get(product, []) if d == day]
            before = [(d, p) for d, p in known.get(product, []) if d <= day]
            out.append((product, day, max(today) if today else None, max(before)[1] if before else None))
            day += timedelta(days=1)
    return sorted(out, key=repr)


def test_filled_prices_over_whole_table(price_table, product_table, price_rows):
    listed = [r[0] for r in product_table.select("product_id").collect()]
    dated = [d for p, d, _ in price_rows if p and d]
    expected = brute_fill(price_rows, listed, min(dated), max(dated))
    assert rows(prices.filled_prices(price_table, product_table)) == expected
    missing = [r[:2] for r in expected if r[2] is None]
    assert rows(prices.missing_prices(price_table, product_table)) == sorted(missing, key=repr)


@pytest.mark.parametrize("first, last", [(10, 20), (-5, 3), (70, 75), (30, 30)])
def test_filled_prices_of_a_period(price_table, product_table, price_rows, first, last):
    listed = [r[0] for r in product_table.select("product_id").collect()]
    expected = brute_fill(price_rows, listed, days(first), days(last))
    assert rows(prices.filled_prices(price_table, product_table, days(first), days(last))) == expected


def test_changes_count_in_order_of_day_and_price(price_table, price_rows):
    changes, drops = Counter(), Counter()
    for product, known in history(price_rows).items():
        known = [k for k in known if k[0].year == 2025]
        changes[product] = sum(a[1] != b[1] for a, b in zip(known, known[1:]))
        drops[product] = sum(b[1] < a[1] for a, b in zip(known, known[1:]))
    assert dict(rows(prices.frequent_price_changes(price_table, 2025))) == {p: n for p, n in changes.items() if n}
    assert dict(rows(prices.never_decreased(price_table, 2025))) == {p: 0 for p, n in drops.items() if not n}


def test_first_and_last(price_table, price_rows):
    got = {r[0]: r for r in rows(prices.first_and_last_prices(price_table))}
    for product, known in history(price_rows).items():
        (d1, p1), (d2, p2) = known[0], known[-1]
        assert got[product] == (product, p1, d1, p2, d2, (p2 - p1) / p1)


def test_forecast(spark):
    def forecast(points):
        df = spark.createDataFrame([(None, "p", d, p) for d, p in points], schemas.PRICES)
        return prices.inflation_prediction(df, "2026-12-31").collect()

    (one,) = forecast([(date(2025, 1, 1), 10.0)])
    assert (one.slope_per_week, one.intercept, one.predicted_avg_price, one.inflation_pct) == (0, 10, 10, 0)
    (two,) = forecast([(date(2025, 1, 1), 10.0), (date(2025, 1, 8), 11.0)])
    weeks = (date(2026, 12, 31) - date(2025, 1, 1)).days // 7
    assert two.history_start_week == date(2025, 1, 1)
    assert two.predicted_avg_price == pytest.approx(10 + weeks)
    assert two.inflation_pct == pytest.approx(weeks * 10)
    assert forecast([]) == []


@pytest.fixture(scope="module")
def discount_rows():
    random.seed(6)
    out = []
    for i in range(60):
        start = days(random.randrange(60))
        product = "hot" if i % 3 == 0 else f"p{random.randrange(8)}"
        # Usual weeks, long windows, one-day and empty ones.
        out.append((f"d{i}", product, random.choice([0.1, 0.25]), start, start + timedelta(days=random.choice([6, 30, 0, -1]))))
    return out + [("dx", None, 0.1, days(1), days(2)), ("dy", "p1", 0.1, days(1), None)]


@pytest.fixture(scope="module")
def discount_table(spark, discount_rows):
    return spark.createDataFrame(discount_rows, schemas.DISCOUNTS)


@pytest.fixture(scope="module")
def line_rows():
    from datetime import datetime

    random.seed(7)
    out = []
    for i in range(500):
        tx = "t-hot" if i % 3 == 0 else f"t{random.randrange(80)}"
        customer = "c-hot" if i % 3 == 0 else f"c{random.randrange(12)}"
        product = "hot" if i % 4 == 0 else f"p{random.randrange(8)}"
        moment = datetime(2025, 1, 1) + timedelta(days=random.randrange(60), hours=random.randrange(7, 22))
        out.append((tx, customer, product, random.randrange(1, 5), moment, "card", "S1", random.randrange(100, 900) / 100))
    return out


@pytest.fixture(scope="module")
def line_table(spark, line_rows):
    return spark.createDataFrame(line_rows, schemas.TRANSACTIONS)


def open_windows(discount_rows):
    return [d for d in discount_rows if d[1] and d[4] and d[3] <= d[4]]


def test_purchases_during_discount(line_table, discount_table, line_rows, discount_rows):
    expected = []
    for d in open_windows(discount_rows):
        hit = [r for r in line_rows if r[2] == d[1] and d[3] <= r[4].date() <= d[4]]
        if hit:
            expected.append((d[0], d[1], d[3], d[4], len(hit), sum(r[3] for r in hit)))
    got = discounts.purchases_during_discount(line_table, discount_table)
    assert rows(got) == sorted(expected, key=repr)
    bought = {e[1] for e in expected}
    never = {d[1] for d in discount_rows if d[1] and d[4]} - bought
    assert {r[0] for r in rows(discounts.never_purchased_discounted(discount_table, got))} == never


def test_flags_and_totals(line_table, discount_table, line_rows, discount_rows):
    windows = open_windows(discount_rows)

    def flagged(r):
        return any(d[1] == r[2] and d[3] <= r[4].date() <= d[4] for d in windows)

    expected = Counter((r[0], r[2], r[4], r[3], flagged(r)) for r in line_rows)
    got = revenue.flagged_sales(line_table, discount_table).select(
        "transaction_id", "product_id", "transaction_date", "quantity", "on_discount"
    )
    assert Counter(tuple(r) for r in got.collect()) == expected

    cents = {flag: sum(round(r[3] * r[7] * 100) for r in line_rows if flagged(r) is flag) for flag in (True, False)}
    total = revenue.revenue_totals(line_table, discount_table, 2025).first()
    assert total == ((cents[True] + cents[False]) / 100, cents[False] / 100, cents[True] / 100)


def test_increase_before_discount(price_table, discount_table, price_rows, discount_rows):
    known = history(price_rows)
    expected = {}
    for d in discount_rows:
        if d[1] and d[3]:
            gap = [((d[3] - day).days, p) for day, p in known.get(d[1], [])]
            near, far = ([p for g, p in gap if lo < g <= hi] for lo, hi in ((0, 7), (7, 14)))
            if near and far and sum(near) / len(near) > sum(far) / len(far):
                expected[d[0]] = (sum(near) / len(near), sum(far) / len(far))
    got = {r.discount_id: (r.price_near, r.price_far) for r in prices.increase_before_discount(price_table, discount_table).collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k]) for k in got)


@pytest.mark.parametrize("block", [2, 3, 500])
def test_pairs_of_a_hot_basket(line_table, line_rows, block):
    contents = defaultdict(set)
    for r in line_rows:
        contents[r[0]].add(r[2])
    expected = Counter(pair for basket in contents.values() for pair in combinations(sorted(basket), 2))
    got = items.bought_together(line_table, block)
    assert {(a, b): n for a, b, n in rows(got)} == expected


def test_large_basket_is_shared_out(spark):
    basket = spark.range(1200).selectExpr(
        "'t' as transaction_id", "cast(id as string) as product_id", "1 as quantity", "now() as transaction_date"
    )
    assert items.bought_together(basket, 100).count() == 1200 * 1199 // 2


def test_metrics_of_customers(spark, line_table, line_rows):
    people = spark.createDataFrame(
        [(f"c{i}", None, None, date(2015 if i < 3 else 1980, 1, 1), None, None, None, None, "312.5" if i % 2 else None, None)
         for i in range(12)] + [("c-hot", None, None, date(1980, 1, 1), None, None, None, None, "{}", None)],
        schemas.CUSTOMERS,
    )
    card = {f"c{i}": bool(i % 2) for i in range(12)} | {"c-hot": True}
    spent = defaultdict(float)
    for r in line_rows:
        spent[r[1]] += r[3] * r[7]
    got = {r.group: r for r in baskets.card_vs_no_card(line_table, people).collect()}
    for group, owns in (("fidelity", True), ("no_fidelity", False)):
        buyers = [c for c in spent if card[c] is owns]
        assert got[group].customers == len(buyers)
        assert got[group].total_spent == pytest.approx(sum(spent[c] for c in buyers))
    top = rows(baskets.top_spenders(line_table, 2025, 3))
    assert {r[0] for r in top} == set(sorted(spent, key=spent.get, reverse=True)[:3])


def test_recommendations_are_new_to_the_customer(line_table, product_table, line_rows):
    got = rows(recommend.next_products(line_table, product_table))
    bought = {(r[1], r[2]) for r in line_rows}
    assert got and not bought & {(c, p) for c, _, p, _, _ in got}
    assert all(rank <= 5 for *_, rank in got)


def test_trends(line_table, line_rows):
    lines = trends.lines_of_year(line_table, 2025)
    open_days = {r[4].date() for r in line_rows}
    closed = {START + timedelta(days=i) for i in range(365)} - open_days
    assert {r[0] for r in rows(trends.closure_days(lines, 2025))} == closed
    hours = defaultdict(Counter)
    for r in line_rows:
        hours[r[4].date()][r[4].hour] += r[3]
    expected = [(d, *max(c.items(), key=lambda kv: (kv[1], -kv[0]))) for d, c in hours.items()]
    assert rows(trends.peak_hour_per_day(lines)) == sorted(expected, key=repr)


def test_unsorted_products(spark):
    df = spark.createDataFrame(
        [("1", "Detergent rufe", "ALTELE"), ("2", "Ceva", "ALTELE"), ("3", "Vin roșu", "Cadouri"), ("4", None, None)],
        "product_id string, product_name string, category string",
    )
    got = {r.product_id: r.inferred_category for r in products.inferred_categories(df).collect()}
    assert got == {"1": "Curățenie", "2": None, "3": "Cadouri", "4": None}
