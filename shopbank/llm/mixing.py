"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only.

Each document has a 60-bit hash. A source's words are summed by the top bits of the hash; the sums of 4,096 buckets show in
which bucket the budget runs out. Only that bucket is summed again by the next 12 bits, and so on: five nested levels
find the hash at which the budget ends. The documents below it are taken. Nothing is sorted, and a source of any size
spreads over all tasks, since sums are combined before they are shuffled.

Defined results: a null source is a source of its own, the last in order. A null text has no words. Null ids are allowed.
Rows equal in id and text have one hash; where the budget ends within them, as many are taken as fit best. An empty
table gives an empty table. Columns other than the named three pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
LEVELS, LEVEL_BITS = 5, 12
HASH_BITS = LEVELS * LEVEL_BITS


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id, or of the text where the id is null."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most_repeats: int) -> DataFrame:
    """Rows (source, source_size) with the column ``target``.

    Sources in order of code points, null last, weigh ``weights`` in turn. They share all words by weight; a share over
    ``most_repeats`` times the source's size is cut to that, and the rest shared among the others in the same way. This
    is done in one pass: sources are cut in order of size by weight, up to the first that the rest would not overfill.
    The windows run over one row for each source.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    total = F.sum("source_size").over(everything)
    rest = total - most_repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rest_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    fits = F.col("weight") * F.col("rest") / F.col("rest_weight") <= most_repeats * F.col("source_size")
    ranked = sizes.withColumn("weight", weight.cast("long"))
    ranked = ranked.select("*", rest.alias("rest"), rest_weight.alias("rest_weight"), F.row_number().over(by_ratio).alias("rank"))
    ranked = ranked.withColumn("first", F.min(F.when(fits, F.struct("rank", "rest", "rest_weight"))).over(everything))
    share = F.col("weight") * F.col("first.rest") / F.col("first.rest_weight")
    whole = F.lit(most_repeats).cast("double") * F.col("source_size")
    cut = F.col("first").isNull() | (F.col("rank") < F.col("first.rank"))
    return ranked.select("source", "source_size", F.when(cut, whole).otherwise(share).alias("target"))


def thresholds(sized: DataFrame, weights: tuple[int, ...], most_repeats: int) -> DataFrame:
    """For each source: target, whole repeats, and the hash below which one repeat more is taken.

    ``sized`` has (source, size, hash) and is read once for each level; only the first level reads all rows of a source.
    ``budget`` is what is left of the target after whole repeats; ``below`` are the words of the hashes below ``edge``,
    the hash at which the budget ends.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = source_targets(sizes, weights, most_repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = state.withColumn("whole", whole.cast("long"))
    state = state.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    state = state.withColumns({"edge": F.lit(0).cast("long"), "below": F.lit(0).cast("long")})
    for level in range(LEVELS):
        state = stored(state, "mixing-edge")
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        edges = state.select(F.col("source").alias("edge_source"), "edge", "below", "budget")
        inside = F.col("source").eqNullSafe(F.col("edge_source")) & (
            F.shiftright("hash", shift + LEVEL_BITS) == F.shiftright("edge", shift + LEVEL_BITS)
        )
        buckets = (
            sized.join(edges, inside)
            .groupBy("source", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.first("below").alias("below"), F.first("budget").alias("budget"))
        )
        upto = F.col("below") + F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        # The first bucket that the budget does not fill whole: the budget ends in it.
        past = (
            buckets.withColumn("upto", upto)
            .where(F.col("upto") > F.col("budget"))
            .groupBy(F.col("source").alias("past_source"))
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("below"))).alias("hit"))
        )
        state = state.join(past, F.col("source").eqNullSafe(F.col("past_source")), "left").select(
            "source", "source_size", "target", "whole", "budget",
            F.coalesce(F.shiftleft(F.col("hit.bucket"), shift), F.col("edge")).alias("edge"),
            F.coalesce(F.col("hit.below"), F.col("below")).alias("below"),
        )
    return stored(state, "mixing-edge")


def copies(hashed: DataFrame, edges: DataFrame, size: Column) -> DataFrame:
    """``hashed`` (with source, hash, row) with source_size, target and ``n_copies``, how often each row is taken.

    Rows at the very edge share one hash, so they are rows of one document (or a hash collision); they are counted off, and
    those up to the budget, rounded to the nearer row, are taken. ``size`` is evaluated for them alone.
    """
    edges = edges.withColumnRenamed("source", "edge_source")
    joined = hashed.join(edges, F.col("source").eqNullSafe(F.col("edge_source"))).drop("edge_source")
    at_edge = F.col("hash") == F.col("edge")
    plain = joined.where(~at_edge).withColumn("n_copies", F.col("whole") + (F.col("hash") < F.col("edge")).cast("long"))
    upto = F.sum("own").over(
        Window.partitionBy("source", "hash").orderBy("own", "row").rowsBetween(Window.unboundedPreceding, 0)
    )
    more = F.col("budget") >= F.col("below") + F.col("upto") - F.col("own") / 2
    tied = joined.where(at_edge).withColumn("own", size).withColumn("upto", upto)
    tied = tied.withColumn("n_copies", F.col("whole") + more.cast("long")).drop("own", "upto")
    return plain.unionByName(tied).drop("whole", "budget", "edge", "below")


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    most_repeats: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row (doc_id, source, row, size, source_size, target, n_copies) for each document."""
    sized = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{source_column}`").alias("source"),
        word_count(F.col(f"`{text_column}`")).alias("size"),
        hash_of(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")).alias("hash"),
        F.xxhash64(f"`{text_column}`").alias("row"),
    )
    sized = stored(sized, "mixing-sizes")
    return copies(sized, thresholds(sized, weights, most_repeats), F.col("size")).drop("hash")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents with their own columns, each as often as the mix takes it.

    Thresholds are found from sizes and hashes alone; the texts are then filtered in place. The few rows of equal hash
    at an edge are counted off by number.
    """
    weights, most = settings.get("weights", (5, 2, 1)), settings.get("most_repeats", 3)
    id_column, text_column, source_column = (settings.get(f"{x}_column", y) for x, y in (("id", "doc_id"), ("text", "text"), ("source", "source")))
    text = F.col(f"`{text_column}`")
    source = F.col(f"`{source_column}`").alias("source")
    hashed = hash_of(F.col(f"`{id_column}`"), text).alias("hash")
    sized = stored(docs.select(source, word_count(text).alias("size"), hashed), "mixing-sizes")
    rows = docs.select(F.struct("*").alias("__document"), source, hashed, F.xxhash64(text).alias("row"))
    size = word_count(F.col("__document").getField(text_column))
    taken = copies(rows, thresholds(sized, weights, most), size).where("n_copies > 0")
    repeated = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    return repeated.select(*[F.col("__document").getField(c).alias(c) for c in docs.columns])
