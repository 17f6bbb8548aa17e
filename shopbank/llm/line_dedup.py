"""Lines that many documents share, dropped from all but one of them; in DataFrame functions only.

A line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at both ends, with A-Z in lower case. Lines are exploded to rows
(document, place, 128-bit hash of the key); a key held by ``min_docs`` documents or more goes from each of them but the one with the
largest id. What is left is put together again by place.

Cost: the rows of lines are shuffled twice, as hashes; distinct (key, document) pairs are dealt by both, and counts are combined before
they meet, so a line that every document has is no task of its own. Only (key, largest id) of the frequent keys goes back to the lines,
in a join that adaptive execution may split. Texts are shuffled once, as arrays of lines, to meet the places of their dropped lines;
the places to keep are a set difference, linear in the lines of a text.

Defined results: a null or empty text is one empty line. Rows of one doc_id are one document, and rows without an id are one document
with the smallest id. Of rows equal in id and text each gets the same result. A text that loses all its lines becomes empty. A very
long text is one row of lines throughout; no step compares its lines with each other. An empty table gives an empty table. Columns
other than the two named are left alone, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored

WHITE = "".join(map(chr, (32, *range(9, 14))))
MIN_CHARS, MIN_DOCS = 20, 3


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_rows(texts: DataFrame, min_chars: int) -> DataFrame:
    """Rows (doc_id, text_key, place, h1, h2) of the lines whose keys are long enough; ``texts`` has doc_id, text_key, text."""
    lines = texts.select("doc_id", "text_key", F.posexplode(lines_of(lower_ascii(F.col("text")))).alias("place", "line"))
    keyed = lines.withColumn("key", F.btrim("line", F.lit(WHITE))).where(F.char_length("key") >= min_chars)
    hashes = F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2")
    return keyed.select("doc_id", "text_key", "place", *hashes)


def common_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """Rows (h1, h2, last): keys of so many documents, and the largest id that has the key."""
    held = lines.select("h1", "h2", "doc_id").distinct()
    counts = held.groupBy("h1", "h2").agg(F.count("*").alias("documents"), F.max("doc_id").alias("last"))
    return counts.where(F.col("documents") >= min_docs).drop("documents")


def without_common_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Rows (doc_id, n_lines, n_dropped, text) for all documents: lines before and dropped, and the text of those that stay."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    texts = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    lines = stored(line_rows(texts, min_chars), "lines")
    gone = lines.join(common_keys(lines, min_docs), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    gone = gone.groupBy(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).agg(F.collect_set("place").alias("gone"))
    whole = texts.select("doc_id", "text_key", lines_of(F.col("text")).alias("lines"))
    met = whole.join(gone, (F.col("text_key") == F.col("gone_key")) & F.col("doc_id").eqNullSafe(F.col("gone_id")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    left = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get(F.col("lines"), i)))
    return met.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(left, "\n").alias("text"),
    )
