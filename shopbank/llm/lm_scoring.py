"""Cross-entropy difference: documents scored by two n-gram models, of a target text and of all text.

Tokens are bytes, told apart as 64 symbols; that vocabulary, the order (4) and the smoothing are the same in both models.
A token's probability mixes its relative frequencies after three, two, one and no symbols with fixed weights, so a model does not
depend on how much text it has seen, and the two are matched. A document's score is the mean over its tokens of the loss under
the target model less that under the background model: the lower, the more it reads like the target.

Counts cover all bytes of all documents: each task counts the n-grams of its batches, Spark sums them. There are at most 2^24
different n-grams whatever the corpus, so the table of loss differences is of bounded size (64 MB) and is broadcast. All documents are
background, so no n-gram of a scored document is unseen.

Defined results: a null or empty text has no tokens and a null score. A document is target if any label row with its id says so; a null id
is never. Without any target text the target model is uniform. An empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored
from shopbank.llm.symbols import BITS, SYMBOLS, grams
from shopbank.llm.words import texts_of

ORDER = 4
#: Weight of the frequencies after three, two, one and no symbols; the rest is spread evenly over the symbols.
WEIGHTS = (0.55, 0.25, 0.12, 0.07)


def gram_counts(docs: DataFrame) -> DataFrame:
    """Rows (gram, target, background) from rows (text, is_target)."""
    schema = pa.schema([("gram", pa.int32()), ("target", pa.int64()), ("background", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, wanted = texts_of(batch.column(0)), batch.column(1).to_pylist()
            held: dict[bool, list[np.ndarray]] = {True: [], False: []}
            for text, target in zip(texts, wanted, strict=True):
                held[target].append(grams(text, ORDER))
            for target, parts in held.items():
                if parts:
                    found, counts = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.astype(np.int32)), pa.array(counts * target), pa.array(counts)], schema=schema
                    )

    rows = docs.mapInArrow(run, "gram int, target long, background long")
    return rows.groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def loss_differences(counts: DataFrame) -> DataFrame:
    """Rows (gram, difference): loss under the target model less loss under the background model, in nats.

    Frequencies of shorter n-grams are sums over longer ones, so four sums over at most 2^24 rows, joined to them.
    """
    out = counts
    names = []
    for size in range(ORDER, 0, -1):
        own = F.col("gram").bitwiseAND(F.lit((1 << BITS * size) - 1)) if size < ORDER else F.col("gram")
        sums = counts.groupBy(own.alias(f"gram{size}")).agg(F.sum("target").alias("t"), F.sum("background").alias("b"))
        after = F.shiftright(f"gram{size}", BITS)
        totals = sums.groupBy(after.alias("after")).agg(F.sum("t").alias("all_t"), F.sum("b").alias("all_b"))
        share = sums.join(totals, after == F.col("after")).select(
            f"gram{size}",
            F.when(F.col("all_t") > 0, F.col("t") / F.col("all_t")).alias(f"target{size}"),
            (F.col("b") / F.col("all_b")).alias(f"background{size}"),
        )
        out = out.withColumn(f"gram{size}", own).join(share, f"gram{size}").drop(f"gram{size}")
        names.append(size)

    def mixed(name: str):
        """Where a model has not seen what stands before, the next shorter frequency takes that weight."""
        shorter = F.lit(1.0 / SYMBOLS)
        mean = F.lit(1.0 - sum(WEIGHTS)) * shorter
        for size, weight in zip(reversed(names), reversed(WEIGHTS), strict=True):
            shorter = F.coalesce(F.col(f"{name}{size}"), shorter)
            mean = mean + F.lit(weight) * shorter
        return mean

    return out.select("gram", (F.log(mixed("background")) - F.log(mixed("target"))).cast("float").alias("difference"))


def scored(docs: DataFrame, differences: DataFrame) -> DataFrame:
    """Rows (doc_id, n_tokens, score)."""
    spark = docs.sparkSession
    rows = differences.toPandas()
    table = np.zeros(1 << BITS * ORDER, np.float32)
    table[rows["gram"].to_numpy(np.int64)] = rows["difference"].to_numpy(np.float32)
    shared = spark.sparkContext.broadcast(table)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            texts = texts_of(batch.column(1))
            scores = [float(table[grams(t, ORDER)].mean(dtype=np.float64)) if t else None for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array(scores, pa.float64())], schema=schema
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, score double")


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Scores of all documents against the target, the documents whose id is in ``target_ids``."""
    wanted = target_ids.select(F.col("doc_id").alias("target_id")).where("target_id is not null").distinct()
    # Target ids grow with the corpus: the join is a merge at every size, and skewed ids can be split.
    flagged = docs.select("doc_id", "text").join(wanted.hint("merge"), F.col("doc_id") == F.col("target_id"), "left")
    counts = gram_counts(flagged.select("text", F.col("target_id").isNotNull()))
    return scored(docs, loss_differences(stored(counts, "gram-counts")))
