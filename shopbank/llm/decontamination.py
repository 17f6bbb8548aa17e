"""Benchmark decontamination: an FM-index of each training shard is searched for the phrases of a benchmark.

A phrase is a window of 13 words of an item, or the whole of a shorter item. Words of both sides are lower-cased (A-Z) runs of
``[0-9a-z]`` and of characters beyond ASCII. A task turns the documents of a shard (about ``SHARD_WORDS`` words) into runs
of words that the benchmark knows; no phrase reaches beyond such a run, and a run shorter than the shortest phrase holds
none. Over the runs it builds an FM-index (suffix order, wavelet matrix of the BWT, sampled suffix places), finds all phrases
by backward search at once, locates their occurrences by walking to the next sampled place, and merges them into spans.

The documents are not shuffled and nothing is broadcast. Tasks make the phrases of pieces of about ``PIECE_BYTES`` of benchmark text,
long items cut into overlapping parts, and write a file for each below the shared folder, which Python must be able to read as well
(pyarrow's file systems). A task searches its shard for one piece after the other and holds one, two while it reads the next.

Defined results: a null or empty text has no words and no hits; an item without words has no phrase. Equal phrases of several items count
for each of them; rows of one item_id are one item; a null item_id is the item named "". Documents are judged row by row, so null
and repeated ids are allowed. An empty benchmark marks nothing; an empty table gives an empty table. Other columns are left
alone, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import parquet
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored
from shopbank.llm.words import covered, released, spans, texts_of

WIDTH = 13
SHARD_WORDS = 1 << 20
PIECE_BYTES = 2 << 20
#: Longer items are cut into parts of so many windows.
PART_WINDOWS = 1 << 13
#: Every so many places of a run are sampled.
SAMPLE = 8

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if (c + 32 if 65 <= c <= 90 else c) in _ALNUM else 32 for c in range(256))


def item_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Phrases:
    """The distinct phrases of some items, as symbols from 1: padded rows, their lengths, and the items of each."""

    def __init__(self, items: list[tuple[str, bytes]], width: int = WIDTH):
        self.symbols: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            word = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in item_words(text)]
            for i in range(max(1, len(word) - width + 1) if word else 0):
                found.setdefault(tuple(word[i : i + width]), set()).add(name)
        self.length = np.array([len(p) for p in found], np.int64)
        self.rows = np.zeros((len(found), width), np.int64)
        for i, p in enumerate(found):
            self.rows[i, : len(p)] = p
        self.items = [sorted(x) for x in found.values()]


def ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 0."""
    return np.unique(keys, return_inverse=True)[1]


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places in the order of the suffixes that begin there and end with their run; ``left`` counts the symbols to the run's end.

    By doubling: ranks of twice as many symbols from pairs of ranks. Equal suffixes of runs keep the order of their
    places, as if each run ended with a symbol of its own.
    """
    n, step = len(text), 1
    rank = ranks(text)
    longest = int(left.max()) if n else 0
    while step < longest:
        after = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > step)
        after[inside] = rank[inside + step] + 1
        rank = ranks(rank * (n + 1) + after)
        step *= 2
        if rank.max() == n - 1:
            break
    return np.argsort(rank, kind="stable")


class WaveletMatrix:
    """Symbols by bits, highest first; counts a symbol before places in as many steps as there are bits."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (values >> bit) & 1
            before = np.concatenate(([0], np.cumsum(ones, dtype=np.int32)))
            zeros = len(values) - int(before[-1])
            self.levels.append((bit, before, zeros))
            values = np.concatenate((values[ones == 0], values[ones == 1]))

    def count(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        begin, at = np.zeros(len(places), np.int64), places.astype(np.int64)
        for bit, before, zeros in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            begin = np.where(one, zeros + before[begin], begin - before[begin])
            at = np.where(one, zeros + before[at], at - before[at])
        return at - begin


class FMIndex:
    """Index of runs of symbols from 1; ``place`` says where each symbol stood in the shard."""

    def __init__(self, text: np.ndarray, left: np.ndarray, place: np.ndarray, top: int):
        order = suffix_order(text, left)
        first = np.ones(len(text), bool)
        first[1:] = left[:-1] == 1
        starts = np.flatnonzero(first)
        in_run = np.arange(len(text)) - np.repeat(starts, np.diff(np.append(starts, len(text))))
        previous = np.where(first, 0, np.concatenate(([0], text[:-1])))
        # Suffixes are preceded by rows that stand for the ends of runs, one each, in the order of the runs.
        self.smaller = len(starts) + np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        last = np.append(starts[1:], len(text)) - 1
        self.bwt = np.concatenate((text[last], previous[order]))
        self.wavelet = WaveletMatrix(self.bwt, top)
        at_sample = in_run[order] % SAMPLE == 0
        self.sampled = np.concatenate((np.zeros(len(starts), bool), at_sample))
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[at_sample]
        self.place = place
        self.n = len(self.bwt)

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """The range of rows of each phrase, all phrases extended to the left by a symbol at a time."""
        begin = np.zeros(len(phrases.length), np.int64)
        end = np.full(len(phrases.length), self.n, np.int64)
        for back in range(1, phrases.rows.shape[1] + 1):
            live = np.flatnonzero((phrases.length >= back) & (begin < end))
            symbol = phrases.rows[live, phrases.length[live] - back]
            begin[live] = self.smaller[symbol] + self.wavelet.count(symbol, begin[live])
            end[live] = self.smaller[symbol] + self.wavelet.count(symbol, end[live])
        return begin, end

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the shard of the suffixes in these rows: steps to the left until a sampled place is met."""
        out, steps = np.empty(len(rows), np.int64), 0
        todo, at = np.arange(len(rows)), rows.copy()
        while len(todo):
            hit = self.sampled[at]
            out[todo[hit]] = self.samples[self.sample_rank[at[hit]]] + steps
            todo, at = todo[~hit], at[~hit]
            symbol = self.bwt[at]
            at = self.smaller[symbol] + self.wavelet.count(symbol, at)
            steps += 1
        return self.place[out]


def occurrences(words: np.ndarray, document: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, place) of all occurrences in a shard; ``words`` are symbols, 0 for words that the benchmark lacks."""
    none = np.zeros(0, np.int64)
    if not len(phrases.length) or not len(words):
        return none, none
    known = words > 0
    edge = np.ones(len(words), bool)
    edge[1:] = ~known[:-1] | ~known[1:] | (document[1:] != document[:-1])
    starts = np.flatnonzero(edge)
    lengths = np.diff(np.append(starts, len(words)))
    long = known[starts] & (lengths >= phrases.length.min())
    inside = np.repeat(long, lengths)
    if not inside.any():
        return none, none
    end = np.repeat(starts + lengths, lengths)
    place = np.flatnonzero(inside)
    index = FMIndex(words[place], (end - np.arange(len(words)))[place], place, len(phrases.symbols))
    begin, stop = index.search(phrases)
    found = np.flatnonzero(stop > begin)
    counts = (stop - begin)[found]
    rows = np.repeat(begin[found], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(found, counts), index.locate(rows)


def scan(texts: list[bytes], pieces: Iterable[Phrases]) -> list[tuple[int, np.ndarray, list[str]]]:
    """For each text: number of words, merged spans of hit words, and names of the items that occur."""
    lengths, hits, items = np.zeros(len(texts), np.int64), None, [set() for _ in texts]
    for phrases in pieces:
        parts = []
        for i, text in enumerate(texts):
            words = item_words(text)
            lengths[i] = len(words)
            parts.append(np.fromiter(map(phrases.symbols.get, words, repeat(0)), np.int64, len(words)))
        words = np.concatenate(parts)
        document = np.repeat(np.arange(len(texts)), lengths)
        if hits is None:
            hits = np.zeros(len(words), bool)
        which, place = occurrences(words, document, phrases)
        for width in np.unique(phrases.length[which]):
            mask = np.zeros(len(words), bool)
            mask[place[phrases.length[which] == width]] = True
            hits |= covered(mask, int(width))[: len(words)]
        many = max(1, len(phrases.items))
        for pair in np.unique(document[place] * many + which).tolist():
            items[pair // many].update(phrases.items[pair % many])
    if hits is None:
        lengths[:] = [len(item_words(text)) for text in texts]
        hits = np.zeros(int(lengths.sum()), bool)
    ends = np.cumsum(lengths)
    return [
        (int(n), spans(hits[end - n : end]), sorted(found)) for n, end, found in zip(lengths, ends, items, strict=True)
    ]


def item_parts(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (item, words): an item's words joined by spaces, long ones in parts that share ``width`` - 1 words, so no window is cut."""
    schema = pa.schema([("item", pa.string()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words = item_words(text)
                starts = range(0, max(1, len(words) - width + 1) if words else 0, PART_WINDOWS)
                parts = [b" ".join(words[i : i + PART_WINDOWS + width - 1]) for i in starts]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(parts), pa.string()), pa.array(parts, pa.binary())], schema=schema)

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    return items.mapInArrow(run, "item string, words binary")


def stored_phrases(benchmark: DataFrame, width: int = WIDTH) -> list[str]:
    """Files in the shared folder, each with the phrases of one piece, made by the tasks."""
    parts = stored(item_parts(benchmark, width), "benchmark-parts")
    pieces = -(-(parts.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // PIECE_BYTES)
    if not pieces:
        return []

    def made(piece: pd.DataFrame) -> pd.DataFrame:
        phrases = Phrases(list(zip(piece["item"], map(bytes, piece["words"]), strict=True)), width)
        return pd.DataFrame({"phrases": [pickle.dumps(phrases)]})

    dealt = parts.withColumn("piece", F.pmod(F.xxhash64("item", "words"), F.lit(pieces)))
    phrases = stored(dealt.groupBy("piece").applyInPandas(made, "phrases binary"), "benchmark-phrases", maxRecordsPerFile=1)
    # Files without rows are not named by any row.
    return sorted(r[0] for r in phrases.select(F.col("_metadata.file_path")).distinct().collect())


class Pieces:
    """Phrases read from files one after the other. Each pass goes the other way, so it begins with the piece that is held."""

    def __init__(self, files: list[str]):
        self.files = list(files)
        self.held: tuple[str, Phrases] | None = None

    def __iter__(self) -> Iterator[Phrases]:
        for name in self.files:
            if self.held is None or self.held[0] != name:
                system, path = FileSystem.from_uri(name)
                self.held = name, pickle.loads(parquet.read_table(path, filesystem=system, partitioning=None)["phrases"][0].as_py())
            yield self.held[1]
        self.files.reverse()


def by_shard(files: list[str], text_at: int, finish: Callable[[pa.RecordBatch, list], pa.RecordBatch]) -> Callable:
    """A function over Arrow batches: cuts them into shards, scans each, and has ``finish`` make the output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Pieces(files)
        for batch in batches:
            texts = texts_of(batch.column(text_at))
            sizes = np.cumsum([len(t) // 5 for t in texts])
            begin = 0
            while begin < len(texts):
                upto = (int(sizes[begin - 1]) if begin else 0) + SHARD_WORDS
                end = max(begin + 1, int(np.searchsorted(sizes, upto, side="right")))
                yield finish(batch.slice(begin, end - begin), scan(texts[begin:end], phrases))
                begin = end

    return released(run)


def contaminated(n_words: int, n_hit: int) -> bool:
    """At least a twentieth of the words is hit."""
    return n_hit > 0 and 20 * n_hit >= n_words


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("contaminated", pa.bool_())]
    + [("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))]
)
DDL = "doc_id long, n_words long, n_hit long, contaminated boolean, items array<string>, spans array<array<long>>"


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each document: words, hit words, verdict, the items that occur, and the spans [start, end) of words to remove."""

    def finish(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        rows = []
        for i, (n, hit, items) in zip(batch.column(0).to_pylist(), found, strict=True):
            n_hit = int((hit[:, 1] - hit[:, 0]).sum())
            rows.append({"doc_id": i, "n_words": n, "n_hit": n_hit, "contaminated": contaminated(n, n_hit), "items": items, "spans": hit.tolist()})
        return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return docs.select("doc_id", "text").mapInArrow(by_shard(stored_phrases(benchmark, width), 1, finish), DDL)


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, with all their columns, that are not contaminated."""

    def finish(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        clean = [not contaminated(n, int((hit[:, 1] - hit[:, 0]).sum())) for n, hit, _ in found]
        return batch.filter(pa.array(clean, pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scanned = plain.mapInArrow(by_shard(stored_phrases(benchmark, width), docs.columns.index("text"), finish), plain.schema)
    return scanned.toDF(*docs.columns)

