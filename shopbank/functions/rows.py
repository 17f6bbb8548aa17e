"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def having(df: DataFrame, *columns: str) -> DataFrame:
    """The rows with a value in every one of the columns.

    Written as single null tests, which reach the file scan and match the tests that joins add by
    themselves, so that equal inputs stay equal plans and share one shuffle. ``dropna`` does neither.
    """
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
