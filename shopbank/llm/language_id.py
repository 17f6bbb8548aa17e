"""Language of web pages by fusing evidence: text, declared language, address suffix, and what the host's other pages say.

- Text: likelihoods of 3-grams of 64 byte symbols, one model for each language of a labelled table; counts cover all of it. Neighbouring
  n-grams overlap and depend on each other, so log likelihoods are weighed by ``TEXT_WEIGHT``.
- Declared: how often pages whose text reads as a language declare this or that in ``<html lang=...>``.
- Suffix and host: the languages seen on a host, smoothed towards those seen under its address suffix, smoothed towards those of
  all pages (``STRENGTH`` pages' worth each). A page's own vote is taken out of the host's, the suffix's and the overall count.

All counts are grouped aggregations with a row for each (group, language), summed before they are shuffled, so a host with
a third of all pages is a few rows. The model is broadcast: 64^3 numbers for each language, of which the table may have ``MOST_LANGUAGES``.

Defined results: a page without text (null, empty or only markup) is judged by the other evidence; one without address has host and suffix
"", without declaration declares "". Null ids and repeated rows are judged row by row. Without labelled text all languages would be
unknown: ``language`` is null. An empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored
from shopbank.llm.symbols import BITS, SYMBOLS, grams
from shopbank.llm.words import texts_of

ORDER = 3
TEXT_WEIGHT = 0.2
STRENGTH = 5.0
MOST_LANGUAGES = 256

_OPENING = re.compile(rb"<(script|style|nav|head)\b|<!--", re.I)
_CLOSING = {name: re.compile(rb"</" + name + rb"\s*>", re.I) for name in (b"script", b"style", b"nav", b"head")} | {None: re.compile(rb"-->")}
_TAG = re.compile(rb"<[^>]*>")


def visible(html: bytes) -> bytes:
    """Text of a page without scripts, styles, menus, head and tags, in time linear in the page.

    An element that is not closed is only a tag; that it has no end is found out once for each kind. A ``<`` behind the last ``>`` is text.
    """
    kept, at, searched, unclosed = [], 0, 0, set()
    while opening := _OPENING.search(html, searched):
        kind = opening[1] and opening[1].lower()
        closing = None if kind in unclosed else _CLOSING[kind].search(html, opening.end())
        if closing:
            kept.append(html[at : opening.start()])
            at = searched = closing.end()
        else:
            unclosed.add(kind)
            searched = opening.start() + 1
    kept.append(html[at:])
    rest = b" ".join(kept)
    tagged = rest.rfind(b">") + 1
    return b" ".join((_TAG.sub(b" ", rest[:tagged]) + rest[tagged:]).split())


def language_counts(labelled: DataFrame) -> DataFrame:
    """Rows (lang, gram, n) over all labelled texts."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_language: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                by_language.setdefault(lang, []).append(grams(text, ORDER))
            for lang, parts in by_language.items():
                found, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array(found.astype(np.int32)), pa.array(counts)], schema=schema
                )

    rows = labelled.where("lang is not null").select("lang", "text").mapInArrow(run, "lang string, gram int, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def language_model(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log probability of each symbol after two others in each."""
    rows = language_counts(labelled).toPandas()
    languages = sorted(rows["lang"].unique())
    if not languages:
        return [], np.zeros((0, SYMBOLS**ORDER), np.float32)
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the model holds {MOST_LANGUAGES}")
    counts = np.full((len(languages), SYMBOLS**ORDER), 0.1, np.float32)
    at = {lang: i for i, lang in enumerate(languages)}
    counts[rows["lang"].map(at).to_numpy(np.int64), rows["gram"].to_numpy(np.int64)] += rows["n"].to_numpy(np.float32)
    after = counts.reshape(len(languages), -1, SYMBOLS)
    return languages, np.log(after / after.sum(axis=2, keepdims=True)).reshape(counts.shape)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, r"^(www|m)\.", "")


def declared_of(html: Column) -> Column:
    tag = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,8})", 1)
    return F.lower(tag)


def text_evidence(pages: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """Rows (page_id, host, suffix, declared, likelihoods, vote); the vote is the text's likeliest language, null without text."""
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = pa.schema(
        [("page_id", pa.int64()), ("host", pa.string()), ("declared", pa.string()), ("likelihoods", pa.list_(pa.float64())), ("vote", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            likelihoods, votes = [], []
            for html in texts_of(batch.column(3)):
                found = grams(visible(html), ORDER)
                own = model[:, found].sum(axis=1, dtype=np.float64)
                likelihoods.append(own.tolist())
                votes.append(int(own.argmax()) if len(found) and len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(likelihoods, schema.field(3).type), pa.array(votes, pa.int32())],
                schema=schema,
            )

    rows = pages.select(
        F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"), declared_of(F.col("html")).alias("declared"), "html"
    )
    rows = rows.mapInArrow(run, "page_id long, host string, declared string, likelihoods array<double>, vote int")
    return rows.withColumn("suffix", F.element_at(F.split("host", r"\."), -1))


def votes_by(rows: DataFrame, column: str, n: int) -> DataFrame:
    """Rows (column, column_votes): how many pages of each group vote for each language."""
    votes = F.array(*[F.sum((F.col("vote") == i).cast("long")) for i in range(n)])
    return rows.where("vote is not null").groupBy(column).agg(votes.alias(f"{column}_votes"))


def identified(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """Rows (page_id, host, suffix, declared, text_language, language, confidence)."""
    languages, model = language_model(labelled)
    n = len(languages)
    rows = stored(text_evidence(pages, languages, model), "page-evidence")
    if not n:
        nothing = F.lit(None).cast("string")
        return rows.select("page_id", "host", "suffix", "declared", nothing.alias("text_language"), nothing.alias("language"), F.lit(None).cast("double").alias("confidence"))
    joined = rows
    for column in ("host", "suffix", "declared"):
        joined = joined.join(votes_by(rows, column, n), column, "left")
    totals = rows.agg(*[F.sum((F.col("vote") == i).cast("long")).alias(f"n{i}") for i in range(n)], F.count_distinct("declared").alias("kinds"))
    total = [x or 0 for x in totals.first()]
    kinds = total.pop()
    everything = F.array(*[F.lit(float(x)) for x in total])

    def own(i: int) -> Column:
        return F.coalesce((F.col("vote") == i).cast("double"), F.lit(0.0))

    def others(votes: Column, i: int) -> Column:
        return F.coalesce(F.get(votes, F.lit(i)), F.lit(0)) - own(i)

    def count(votes: Column) -> Column:
        return F.aggregate(F.coalesce(votes, F.array(F.lit(0).cast("long"))), F.lit(0.0), lambda a, x: a + x) - F.col("vote").isNotNull().cast("double")

    posterior = []
    for i in range(n):
        overall = (others(everything, i) + 1.0) / (F.lit(float(sum(total))) - F.col("vote").isNotNull().cast("double") + n)
        by_suffix = (others(F.col("suffix_votes"), i) + STRENGTH * overall) / (count(F.col("suffix_votes")) + STRENGTH)
        by_host = (others(F.col("host_votes"), i) + STRENGTH * by_suffix) / (count(F.col("host_votes")) + STRENGTH)
        declares = (others(F.col("declared_votes"), i) + 1.0 / max(kinds, 1)) / (F.lit(float(total[i])) - own(i) + 1.0)
        posterior.append(F.lit(TEXT_WEIGHT) * F.col("likelihoods")[i] + F.log(by_host) + F.log(declares))
    joined = joined.withColumn("posterior", F.array(*posterior)).withColumn("most", F.array_max("posterior"))
    names = F.array(*map(F.lit, languages))
    mass = F.aggregate("posterior", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    return joined.select(
        "page_id", "host", "suffix", "declared", F.get(names, F.col("vote")).alias("text_language"),
        F.get(names, F.array_position("posterior", F.col("most")).cast("int") - 1).alias("language"), (F.lit(1.0) / mass).alias("confidence"),
    )
