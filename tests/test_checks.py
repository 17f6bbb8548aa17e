"""Every check query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert {c.name for c in entry.CHECKS} == {c.name for c in entry.CHECKS if c.body}


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "discount_id", "product_id", "valid_from", "valid_to", "purchase_count", "units_sold",
    ]


@pytest.mark.parametrize("name", [c.name for c in entry.CHECKS])
def test_equals_sql(spark, duck, name):
    text, count = difference(spark, duck, FOLDER, name)
    assert text == ""
    assert count > 0
