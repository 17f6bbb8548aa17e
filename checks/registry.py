"""What a check is, and SQL fragments shared by the checks."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from checks.views import VIEW_SQL, Views

day_sum = "cast(sum(quantity) as bigint)"


def total(amount: str, where: str | None = None) -> str:
    """Sum of money: the digits each amount is printed with, added as decimals. No rounding before the report's own."""
    rows = f" filter (where {where})" if where else ""
    return f"cast(sum(cast(cast(cast({amount} as double) as varchar) as decimal(38, 10))){rows} as double)"


def rounded(value: str, digits: int) -> str:
    """Half-up rounding of the digits a double is printed with, which is how Spark rounds one."""
    return f"cast(round(cast(cast(cast({value} as double) as varchar) as decimal(38, 18)), {digits}) as double)"


@dataclass
class Check:
    name: str
    run: Callable[[Views], DataFrame]
    body: str | None = None

    @property
    def sql(self) -> str:
        """The body after the views it names, as one statement."""
        used = [name for name in VIEW_SQL if re.search(rf"\b{name}\b", self.body)]
        views = ", ".join(f"{name} as ({VIEW_SQL[name]})" for name in used)
        body = self.body.strip()
        if not views:
            return body
        return f"with {views}, {body[5:]}" if body.startswith("with ") else f"with {views} {body}"
