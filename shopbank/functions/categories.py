"""Product categories from keywords, restricted categories and age groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopbank.functions.bands import below

# Keyword and category, tried in this order.
KEYWORD_RULES = [
    ("detergent", "Curățenie"),
    ("săpun", "Igienă"),
    ("șampon", "Igienă"),
    ("pastă de dinți", "Igienă"),
    ("hârtie", "Curățenie"),
    ("bere", "Băuturi alcoolice"),
    ("vin", "Băuturi alcoolice"),
    ("vodka", "Băuturi alcoolice"),
    ("whisky", "Băuturi alcoolice"),
    ("energizant", "Băuturi energizante"),
    ("țigări", "Țigări"),
    ("cafea", "Cafea"),
    ("ceai", "Ceai"),
    ("suc", "Sucuri"),
    ("apă", "Apă"),
    ("lapte", "Lactate"),
    ("iaurt", "Lactate"),
    ("brânză", "Lactate"),
]

# Categories that may not be sold to minors, and the catch-all category.
RESTRICTED = ["Băuturi alcoolice", "Băuturi energizante", "Țigări"]
UNSORTED = "ALTELE"


def category_by_keyword(name: Column, rules: Sequence[tuple[str, str]] = KEYWORD_RULES) -> Column:
    """Category of the first rule whose keyword occurs in the name, else null."""
    text = F.lower(name)
    return F.coalesce(*[F.when(text.contains(word), F.lit(category)) for word, category in rules])


# Upper age limits of the groups.
AGE_GROUPS = [(18, "underage"), (25, "[18-25)"), (35, "[25-35)"), (50, "[35-50)"), (65, "[50-65)")]


def age_group(age: Column) -> Column:
    return F.when(age.isNull(), "unknown").otherwise(below(age, AGE_GROUPS, "65+"))
