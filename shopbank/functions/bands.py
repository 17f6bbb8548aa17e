"""Labels by threshold. Steps are tried in order; a null value gets the last label."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from operator import ge, gt, le, lt

from pyspark.sql import Column
from pyspark.sql import functions as F

Steps = Sequence[tuple[float, object]]


def _band(test: Callable, value: Column, steps: Steps, otherwise) -> Column:
    return F.coalesce(*[F.when(test(value, limit), F.lit(label)) for limit, label in steps], F.lit(otherwise))


def below(value: Column, steps: Steps, otherwise) -> Column:
    return _band(lt, value, steps, otherwise)


def at_most(value: Column, steps: Steps, otherwise) -> Column:
    return _band(le, value, steps, otherwise)


def above(value: Column, steps: Steps, otherwise) -> Column:
    return _band(gt, value, steps, otherwise)


def at_least(value: Column, steps: Steps, otherwise) -> Column:
    return _band(ge, value, steps, otherwise)


def points(label: Column, by_label: dict[str, int]) -> Column:
    """Points of a label, 0 for labels without any."""
    scores = F.create_map(*[F.lit(x) for pair in by_label.items() for x in pair])
    return F.coalesce(F.try_element_at(scores, label), F.lit(0))
