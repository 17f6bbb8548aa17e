"""Column rules on literal rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shopbank.functions import calendar, categories, contact, money
from shopbank.operators import customers, names, quality
from shopbank.sources import schemas


def apply(spark, value, rule, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(rule(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "raw, expected, carrier",
    [
        ("+40744123456", "+40744123456", "Orange"),
        ("+40 722 123 456", "+40722123456", "Vodafone"),
        ("0772-123-456", "+40772123456", "Digi"),
        ("0040735123456", "+40735123456", "Telekom"),
        ("0799123456", "+40799123456", None),
        ("0744", None, "Orange"),
        ("074", None, None),
        ("07441234567", None, "Orange"),
        ("312.5", None, None),
        ("no digits", None, None),
        (None, None, None),
    ],
)
def test_phone(spark, raw, expected, carrier):
    assert apply(spark, raw, contact.normalized_phone) == expected
    assert apply(spark, raw, contact.mobile_carrier) == carrier


@pytest.mark.parametrize(
    "phone, expected", [("+40744", True), (" + 40 7", True), ("00407", True), ("0744", False), (None, None)]
)
def test_country_prefix(spark, phone, expected):
    assert apply(spark, phone, contact.has_country_prefix) is expected


@pytest.mark.parametrize(
    "address, kind, name, number",
    [
        ("Str. Mihai Viteazu, nr. 12, ap. 4, Iași", "Str.", "Mihai Viteazu", "12"),
        ("Bulevardul Unirii nr. 7", "Bulevardul", "Unirii", "7"),
        ("Calea Florilor 33, bl. A12, ap. 5, Cluj", "Calea", "Florilor", "5"),
        ("Cluj, Aleea Gării, NR 250", "Aleea", "Gării", "250"),
        ("Strada Fără-Număr", "Strada", "", None),
        ("312.5", "", "", "5"),
        ("12345", "", "", None),
        (None, None, None, None),
    ],
)
def test_address(spark, address, kind, name, number):
    assert apply(spark, address, contact.street_type) == kind
    assert apply(spark, address, contact.street_name) == name
    assert apply(spark, address, contact.street_number) == number


@pytest.mark.parametrize(
    "email, domain", [("Ana@Mail.example", "mail.example"), ("312.5", None), ("a@", ""), (None, None)]
)
def test_email(spark, email, domain):
    assert apply(spark, email, contact.email_domain) == domain


def test_week_runs_from_wednesday_to_tuesday(spark):
    january = [(date(2025, 1, day),) for day in range(1, 32)]
    df = spark.createDataFrame(january, "d date")
    for d, start, place in df.select("d", calendar.week_start(F.col("d")), calendar.day_in_week(F.col("d"))).collect():
        assert start.weekday() == 2 and 0 <= (d - start).days <= 6 and place == (d - start).days


def test_age_groups(spark):
    groups = {
        None: "unknown", 17: "underage", 18: "[18-25)", 24: "[18-25)", 25: "[25-35)", 34: "[25-35)", 35: "[35-50)",
        49: "[35-50)", 50: "[50-65)", 64: "[50-65)", 65: "65+",
    }
    df = spark.createDataFrame([(a,) for a in groups], "a int")
    assert {r.a: r.g for r in df.select("a", categories.age_group(F.col("a")).alias("g")).collect()} == groups


def test_keyword_rules_first_match_wins(spark):
    def category(name):
        return apply(spark, name, categories.category_by_keyword)

    assert category("Bere blondă la vin") == "Băuturi alcoolice"
    assert category("DETERGENT cu lapte") == "Curățenie"
    assert category("Ceva") is None and category(None) is None


def test_day_filters(spark):
    rows = [(datetime(2024, 1, 15),), (datetime(2024, 1, 15, 23, 59, 59),), (datetime(2024, 1, 16),), (None,)]
    df = spark.createDataFrame(rows, "t timestamp")
    assert df.where(calendar.on_day(F.col("t"), "2024-01-15")).count() == 2
    assert df.where(calendar.within_year(F.col("t"), 2024)).count() == 3


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1] * 10 + [1e9, -1e9, 0.2]
    for order in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(x,) for x in order], "x double").repartition(3)
        assert df.agg(money.exact_sum(F.col("x"))).first()[0] == 1.2
    assert df.where("x is null").agg(money.exact_sum(F.col("x")), money.exact_avg(F.col("x"))).first() == (None, None)


def test_exact_sum_loses_nothing(spark):
    small = spark.range(1_000_000).select(F.lit(0.00004).alias("x"))
    assert small.agg(money.exact_sum(F.col("x"))).first()[0] == 40.0
    large = spark.range(300).select(F.lit(1e15).alias("x"))
    assert large.agg(money.exact_sum(F.col("x"))).first()[0] == 3e17
    for unfit in (float("nan"), float("inf"), 1e300):
        with pytest.raises(Exception, match="not an amount of money"):
            spark.createDataFrame([(1.0,), (unfit,)], "x double").agg(money.exact_sum(F.col("x"))).collect()


CUSTOMERS = [
    # id, first, last, birth, email, phone, address, city, card, type
    ("c1", "Ana", "Pop", date(2000, 3, 1), "ana@corp.example", "0744123456", "Str. Unirii, nr. 1", "Iași",
     '{"card_id": "k1", "issue_date": "2020-03-01", "type": "gold"}', "persoana_fizica"),
    ("c2", "ana", "pop", date(2000, 3, 1), "312.5", None, None, "Iași", "312.5", "persoana_fizica"),
    ("c3", "Ion", None, None, None, None, "Str. Unirii, nr. 2", "Iași", None, "persoana_juridica"),
    ("c4", "Ion", "Stan", date(2010, 1, 1), None, "+40722123456", "Calea Lungă 5", None,
     '{"card_id": "k4", "issue_date": "never", "type": "silver"}', "persoana_fizica"),
    (None, "X", "Y", date(1990, 1, 1), None, None, None, "Iași", None, None),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS)


def test_clean_customers_keeps_all_rows(people):
    clean = {r.customer_id: r for r in customers.clean_customers(people).collect()}
    assert len(clean) == 5 and len(clean["c1"]) == 16
    assert clean["c1"].fidelity_card_struct.type == "gold"
    assert clean["c2"].fidelity_card_struct.type is None
    assert clean["c3"].fidelity_card_struct is None


def test_ages_and_cards(people):
    ages = customers.customer_ages(people, "2025-03-01").persist()
    by_id = {r.customer_id: r for r in ages.collect()}
    assert set(by_id) == {"c1", "c2", "c4"}
    assert (by_id["c1"].age_years, by_id["c1"].age_group) == (25, "[25-35)")
    assert by_id["c4"].fidelity_type == "silver" and by_id["c4"].fidelity_issue_date is None
    assert customers.customer_ages(people, "2025-02-28").where("customer_id = 'c1'").first().age_years == 24
    ends = customers.youngest_oldest_by_city(ages).collect()
    assert [(r.city, r.youngest_customer_id, r.oldest_customer_id) for r in ends] == [("Iași", "c2", "c1")]
    assert customers.underage_count(ages).first()[0] == 1
    before = customers.card_before_25(ages).collect()
    assert [(r.customer_id, r.age_at_issue, r.got_card_before_25) for r in before] == [("c1", 20, True)]


def test_quality_of_dirty_rows(people):
    profile = quality.profile_customers(people, "2025-03-01").persist()
    assert quality.missing_contact_counts(profile).first() == (4, 2, 2, 1)
    assert {tuple(r) for r in quality.missing_address_by_card(profile).collect()} == {
        ("gold", 1, 0), ("silver", 1, 0), ("no_card", 2, 1),
    }
    assert {tuple(r) for r in quality.age_group_missing_phone(profile).collect()} == {("[25-35)", 1), ("unknown", 1)}
    assert [tuple(r) for r in quality.email_providers(profile).collect()] == [("corp.example", 1)]
    assert quality.email_domain_age_stats(profile, "corp.example").first() == (1, 25.0, None)


def test_empty_input_gives_no_division_error(people):
    none = quality.profile_customers(people.where("false"), "2025-03-01")
    assert quality.phone_any_share(none).first() == (0, 0, None)
    assert quality.phone_prefix_share(none).first() == (0, 0, None)


def test_names(people):
    assert [tuple(r) for r in names.identical_full_names(people).collect()] == [("ana pop", 2)]
    assert [tuple(r) for r in names.common_streets_by_city(people).collect()] == [("Iași", "Unirii", 2, 1)]
