"""Exact quantiles of a column too long for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 256


def exact_quantiles(df: DataFrame, value: str, fractions: Sequence[float], buckets: int = BUCKETS) -> DataFrame:
    """One row with the interpolated quantiles ``q0``, ``q1``, … of a column, nulls left out.

    ``percentile`` builds one map of all distinct values in one task. Here equal values are counted
    first, approximate quantiles cut the values into ``buckets`` ranges, and the counts of the ranges
    (at most ``buckets`` + 1 rows) tell which ranges hold the wanted ranks. Only the values of those
    ranges, about 1/``buckets`` of all for each rank, are put in order. The cuts decide how the work
    is shared out, never the answer.
    """
    values = df.where(F.col(value).isNotNull()).select(F.col(value).alias("value"))
    steps = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    cuts = values.agg(F.expr(f"percentile_approx(value, array({steps}), {10 * buckets})")).scalar()
    placed = (
        values.groupBy("value")
        .agg(F.count("*").alias("copies"))
        .withColumn("cuts", cuts)
        .select("value", "copies", F.size(F.filter("cuts", lambda cut: cut < F.col("value"))).alias("bucket"))
    )
    in_order = Window.orderBy("bucket")
    ranges = (
        placed.groupBy("bucket")
        .agg(F.sum("copies").alias("size"))
        .select(
            "bucket",
            F.sum("size").over(in_order).alias("upto"),
            (F.sum("size").over(in_order) - F.col("size")).alias("before"),
            F.sum("size").over(Window.partitionBy()).alias("total"),
        )
    )

    # Zero-based rank of each quantile, and the whole ranks around it.
    def position(fraction: float):
        return (F.col("total") - 1) * F.lit(float(fraction))

    def holds(rank):
        return (rank >= F.col("before")) & (rank < F.col("upto"))

    wanted = [rank(position(f)) for f in fractions for rank in (F.floor, F.ceil)]
    needed = ranges.where(reduce(lambda a, b: a | b, [holds(rank) for rank in wanted]))
    # A map of at most two entries per fraction.
    by_bucket = needed.agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", F.struct("before", "total"))))
    ).scalar()
    found = placed.withColumn("range", F.try_element_at(by_bucket, F.col("bucket"))).where("range is not null")
    found = found.select("bucket", "value", "copies", "range.before", "range.total")
    upto = F.col("before") + F.sum("copies").over(
        Window.partitionBy("bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = found.select("value", "total", upto.alias("upto"), (upto - F.col("copies")).alias("before"))

    def at(rank):
        return F.max(F.when(holds(rank), F.col("value")))

    columns = []
    for i, fraction in enumerate(fractions):
        place = position(fraction)
        columns += [
            at(F.floor(place)).alias(f"low{i}"),
            at(F.ceil(place)).alias(f"high{i}"),
            F.max(place - F.floor(place)).alias(f"part{i}"),
        ]
    return ranked.agg(*columns).select(
        *[F.expr(f"low{i} + (high{i} - low{i}) * part{i}").alias(f"q{i}") for i in range(len(fractions))]
    )
