"""Repeated passages by recompression: runs and pairs of tokens get names round by round, and long repeats show as shared names.

Each round replaces neighbours by one name: first runs of two equal words, then pairs whose left name has side bit 0 and whose right
name has side bit 1, as long as the parts are short (``ROUNDS``). Whether two neighbours are joined depends on these two alone, so
equal passages get equal names but for a few words at their edges: at most ``EDGE`` = 10 words on each side are disturbed, and a name covers
at most ``LONGEST`` = 8 words. So the middle 15 words of a 35-word window hold at least one whole name, and all whole names there are the
same wherever the window occurs.

A name is a 64-bit hash of its parts. That makes it the same in all tasks without a table of names, so the rounds need no
shuffle. Spark then compares names globally, in packed blocks (``exchange``): a name that occurs once in all documents rules
out every window around it. The windows left, about the ones that are repeated, are verified by 128-bit names of their 35 words, again
compared globally. What is shuffled is the names once each per block, 16 bytes for a window left, and bits in return.

Defined results: a null or empty text has no words. Documents below 35 words lose nothing. Null and repeated ids are allowed: a repeated
row repeats its windows, so both copies go. An empty table gives no rows. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.llm.exchange import answer, ask, attach, part_count, replies_in_order, seen_twice, seen_twice_wide
from shopbank.llm.scratch import stored
from shopbank.llm.words import U64, Names, covered, factor, mixed, spans, texts_of

WIDTH = 35
#: Longest parts, in words, that a round of pairs joins.
ROUNDS = (1, 1, 2, 4)
LONGEST = 2 * ROUNDS[-1]
EDGE = 2 + sum(ROUNDS)
BLOCK_BYTES = 4 << 20

BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("texts", pa.binary()), ("n_words", pa.int64())])


def text_blocks(docs: DataFrame) -> DataFrame:
    """Rows (block, ids, sizes, texts, n_words): documents packed to about ``BLOCK_BYTES``, their texts compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def packed() -> pa.RecordBatch:
            whole = b"\n".join(texts)
            row = {
                "block": number, "ids": ids, "sizes": [len(t) for t in texts],
                "texts": zstandard.compress(whole), "n_words": len(whole.split()),
            }
            return pa.RecordBatch.from_pylist([row], schema=BLOCK)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                ids.append(i)
                texts.append(text)
                held += len(text) + 16
                if held >= BLOCK_BYTES:
                    yield packed()
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield packed()

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "block long, ids array<long>, sizes array<long>, texts binary, n_words long")


class Words:
    """The words of a block: 64-bit names in a row, and where each document's words end."""

    def __init__(self, row: dict):
        whole = zstandard.decompress(row["texts"])
        self.words: list[list[bytes]] = []
        at = 0
        for size in row["sizes"]:
            self.words.append(whole[at : at + size].split())
            at += size + 1
        names = Names()
        self.names = np.concatenate([names.of(w) for w in self.words]) if self.words else np.zeros(0, U64)
        self.ends = np.cumsum([len(w) for w in self.words])

    def window_starts(self) -> np.ndarray:
        """Mask of the places at which a window begins that ends in the same document."""
        left = np.repeat(self.ends, [len(w) for w in self.words]) - np.arange(len(self.names))
        return left >= WIDTH


def named(left: np.ndarray, right: np.ndarray, turn: int) -> np.ndarray:
    return mixed(left * factor(2 * turn) + right * factor(2 * turn + 1))


def joined(symbols: np.ndarray, ends: np.ndarray, join: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with those marked in ``join`` and their right neighbours made one."""
    at = np.flatnonzero(join)
    symbols, ends = symbols.copy(), ends.copy()
    symbols[at] = named(symbols[at], symbols[at + 1], turn)
    ends[at] = ends[at + 1]
    keep = np.ones(len(symbols), bool)
    keep[at + 1] = False
    return symbols[keep], ends[keep]


def recompressed(names: np.ndarray, document_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, starts, ends) after all rounds; no symbol reaches beyond its document."""
    symbols, ends = names, np.arange(1, len(names) + 1)
    closes = np.zeros(len(names) + 1, bool)
    closes[document_ends] = True
    if len(symbols) > 1:
        equal = (symbols[1:] == symbols[:-1]) & ~closes[ends[:-1]]
        alone = equal.copy()
        alone[1:] &= ~equal[:-1]
        alone[:-1] &= ~equal[1:]
        symbols, ends = joined(symbols, ends, np.append(alone, False), 0)
    for turn, longest in enumerate(ROUNDS, 1):
        lengths = np.diff(ends, prepend=0)
        side = (mixed(symbols ^ factor(500 + turn)) & U64(1)).astype(bool)
        short = lengths <= longest
        join = np.zeros(len(symbols), bool)
        join[:-1] = short[:-1] & short[1:] & ~side[:-1] & side[1:] & ~closes[ends[:-1]]
        symbols, ends = joined(symbols, ends, join, turn)
    return symbols, np.concatenate((ends[:0], [0], ends[:-1])) if len(ends) else ends, ends


def candidates(words: Words, starts: np.ndarray, ends: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Places of the windows of which all whole symbols in the middle are shared."""
    n = len(words.names)
    windows = np.flatnonzero(words.window_starts())
    unshared = np.concatenate(([0], np.cumsum(~shared)))
    # The first symbol that begins at a place or later; the number of symbols that end at a place or before.
    beginning = np.cumsum(np.bincount(starts, minlength=n + 1))
    first = np.concatenate(([0], beginning))
    closing = np.cumsum(np.bincount(ends, minlength=n + 1))
    low, high = first[windows + EDGE], closing[windows + WIDTH - EDGE]
    return windows[unshared[np.maximum(high, low)] == unshared[low]]


def wide_names(names: np.ndarray, places: np.ndarray) -> np.ndarray:
    """128-bit names (n x 2) of the windows at these places, by doubling of polynomial hashes."""
    out = np.empty((len(places), 2), U64)
    for k, base in enumerate(np.array([[factor(900)], [factor(901)]])):
        level, power, size = mixed(names + base), base, 1
        total, at = np.zeros(len(places), U64), places
        rest = WIDTH
        while rest:
            if rest & 1:
                total = total * power + level[at]
                at = at + size
            rest >>= 1
            if rest:
                level = level[: len(level) - size] * power + level[size:]
                power, size = power * power, size * 2
        out[:, k] = mixed(total)
    return out


def window_questions(row: dict, parts: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """With the answers on symbols: the words, candidate places, their distinct wide names, which one each place has, and counts."""
    words = Words(row)
    symbols, starts, ends = recompressed(words.names, words.ends)
    keys, inverse = np.unique(symbols, return_inverse=True)
    shared = replies_in_order(row, keys, parts, bool)[inverse]
    places = candidates(words, starts, ends, shared)
    wide = wide_names(words.names, places)
    order = np.lexsort((wide[:, 1], wide[:, 0]))
    ordered = wide[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return words, places, ordered[new], which, np.bincount(which, minlength=int(new.sum()))


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("text", pa.string())])


def without_repeats(docs: DataFrame) -> DataFrame:
    """For each document: number of words, the removed spans [start, end) of words, and the text left (words joined by a space)."""
    spark = docs.sparkSession
    blocks = stored(text_blocks(docs), "text-blocks")
    parts = part_count(spark, 3 * (blocks.agg(F.sum("n_words")).first()[0] or 0))

    def symbol_keys(row: dict) -> tuple[np.ndarray, np.ndarray]:
        words = Words(row)
        keys, counts = np.unique(recompressed(words.names, words.ends)[0], return_counts=True)
        return keys, counts > 1

    def window_keys(row: dict) -> tuple[np.ndarray, np.ndarray]:
        _, _, wide, _, counts = window_questions(row, parts)
        return wide, counts > 1

    texts = blocks.select("block", "sizes", "texts")
    # Only answers are stored, a bit for each name; the texts stay where they are until they are joined to answers.
    symbols = attach(blocks.select("block"), answer(ask(texts, symbol_keys, parts), seen_twice))
    symbols = stored(symbols, "symbol-replies")
    windows = answer(ask(texts.join(symbols, "block"), window_keys, parts), seen_twice_wide)
    windows = windows.groupBy("block").agg(F.collect_list(F.struct("part", "reply")).alias("window_replies"))
    rows = blocks.join(symbols.join(windows, "block", "left"), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words, places, wide, which, _ = window_questions(row, parts)
                repeated = replies_in_order({"replies": row["window_replies"]}, wide, parts, bool)[which]
                starts = np.zeros(len(words.names), bool)
                starts[places[repeated]] = True
                gone = covered(starts, WIDTH)[: len(starts)]
                out, at = [], 0
                for doc_id, own in zip(row["ids"], words.words, strict=True):
                    lost = gone[at : at + len(own)]
                    at += len(own)
                    left = [w for w, x in zip(own, lost.tolist(), strict=True) if not x] if lost.any() else own
                    out.append({"doc_id": doc_id, "n_words": len(own), "spans": spans(lost).tolist(), "text": b" ".join(left).decode()})
                yield pa.RecordBatch.from_pylist(out, schema=OUT)

    return rows.mapInArrow(run, "doc_id long, n_words long, spans array<array<long>>, text string")
