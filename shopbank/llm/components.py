"""Connected components of a graph given as rows of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored


def fingerprint(edges: DataFrame) -> tuple:
    """Number of rows and a sum that differs, but for chance, if the rows do."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """Rows (a, b): each node of an edge but the smallest of its component, and that smallest node.

    Large and small stars by turns: each node hands its larger neighbours, then its smaller ones, to the smallest. Both
    steps are a sum over the edges and a join, so a node with very many edges is no task of its own.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = fingerprint(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e"))
        small = small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct()
        edges = stored(small, "edges")
        now = fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges
