"""Phone, address, e-mail and loyalty-card expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mobile carrier by the first four digits of the national number.
CARRIER_BY_PREFIX = {
    "0744": "Orange", "0745": "Orange", "0746": "Orange",
    "0722": "Vodafone", "0726": "Vodafone", "0727": "Vodafone",
    "0772": "Digi", "0773": "Digi",
    "0735": "Telekom", "0736": "Telekom",
}

# The street grammar. Kinds of streets, and a kind with the name behind it up to a comma, "nr." or a number.
STREET_KINDS = "Str\\.|Strada|Bd\\.|Bulevardul|Calea|Aleea|Splaiul"
STREET_NAME = f"(?:{STREET_KINDS})\\s+([A-Za-zĂÂÎȘȚăâîșț\\- ]+?)(?=\\s*,|\\s*nr\\.|\\s+\\d)"

CARD_SCHEMA = "card_id string, issue_date string, type string"


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def normalized_phone(raw: Column) -> Column:
    """``+40`` and nine digits, or null. Accepts the prefixes 0, 40 and 0040."""
    subscriber = F.regexp_extract(_digits(raw), "^(?:0040|40|0)([0-9]{9})$", 1)
    return F.when(subscriber != "", F.concat(F.lit("+40"), subscriber))


def mobile_carrier(raw: Column) -> Column:
    national = F.regexp_replace(_digits(raw), "^(?:00)?40(?=[0-9]{9})", "0")
    carriers = F.create_map(*[F.lit(x) for pair in CARRIER_BY_PREFIX.items() for x in pair])
    return F.try_element_at(carriers, F.substring(national, 1, 4))


def has_country_prefix(phone: Column) -> Column:
    return phone.rlike(r"^\s*(\+?\s*40|0040)")


def street_type(address: Column) -> Column:
    return F.regexp_extract(address, f"({STREET_KINDS})", 1)


def street_name(address: Column) -> Column:
    return F.trim(F.regexp_extract(address, STREET_NAME, 1))


def street_number(address: Column) -> Column:
    """The number after "nr", else the last free-standing number of up to four digits."""
    marked = F.nullif(F.regexp_extract(address, "(?i)nr\\.?\\s*(\\d+)", 1), F.lit(""))
    free = F.regexp_extract_all(address, F.lit("\\b(\\d{1,4})\\b"), F.lit(1))
    return F.coalesce(marked, F.try_element_at(free, F.lit(-1)))


def email_domain(email: Column) -> Column:
    return F.get(F.split(F.lower(email), "@"), 1)


def card(raw: Column) -> Column:
    """The card as a struct. Text that is no JSON object gives a struct of nulls."""
    return F.from_json(raw, CARD_SCHEMA)
