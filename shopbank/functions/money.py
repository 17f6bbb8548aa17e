"""Exact sums of money held as doubles.

Adding doubles gives an answer that depends on the order of the rows, so a retried task or another
partitioning may change the last digits. Amounts are therefore added as decimals of ten fractional
digits: the sum is exact, needs no order and keeps hash aggregation with map-side combine. An amount
that is no finite number, or has more than 28 digits before the point, raises; none is left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,10)"


def to_exact(amount: Column) -> Column:
    """The amount as a decimal."""
    exact = amount.try_cast(EXACT)
    unfit = F.raise_error(F.concat(F.lit("not an amount of money: "), amount.cast("string"))).cast(EXACT)
    return F.when(amount.isNotNull() & exact.isNull(), unfit).otherwise(exact)


def from_exact(total: Column) -> Column:
    return total.cast("double")


def exact_sum(amount: Column) -> Column:
    return from_exact(F.sum(to_exact(amount)))


def exact_avg(amount: Column) -> Column:
    return F.try_divide(exact_sum(amount), F.count(amount))
