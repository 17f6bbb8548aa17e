"""Groups of spelling variants: words of a corpus that differ by one letter inserted, deleted or replaced, found with bidirectional FM-indexes.

Two such words agree, but for the letters at one place, in all before and all behind it; so the shorter one's left half or right half
stands in both, at the same end. A word is entered under the halves it may share (``windows``: the half left out is where the error may
be), once as the shorter and once as the longer word of a pair. Words under one key go to one shard. Each shard's words, set
between delimiters, are one text with a bidirectional FM-index: two Burrows-Wheeler transforms, of the text and of the reversed text, whose
suffix-rank intervals are kept in step. All queries of a shard run at once: the exact half is matched outwards to its
delimiter, then the match is extended across the window with one error at any of its places, then to the other delimiter. The
shorter word, or the one with the smaller letter, asks; a pair counts for both.

Scale: a shard is about ``SHARD_SYMBOLS`` letters, whatever the vocabulary. A key of more letters than that (very many words with one half)
is replaced by keys that leave out only half of its window, and so on down to a single place, where the alphabet bounds the words
of a key. Words are counted in each task before they meet. Roots are found by pointer doubling; counts at least double
from word to form, so a few rounds do.

Defined results: a null text has no words; the checksum of a row without an id is that of ``:`` and the run. Repeated rows count each time.
Runs of any length are words. Ties between near words of equal count go by code points. An empty table gives no rows. Columns other than
the two named are left alone, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored
from shopbank.llm.words import texts_of

LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
#: One in so many words of a document, by checksum, loses a letter. None for a corpus whose misspellings are its own.
SLIP = 97
SHARD_SYMBOLS = 1 << 18
#: Places between the stored counts of a transform.
STEP = 32
#: States that are extended at a time.
AT_ONCE = 1 << 14
#: Different words that a task counts before it hands them on, and their letters.
MOST_WORDS, MOST_LETTERS = 1 << 17, 1 << 23

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_SPACED = bytes(c if 97 <= c <= 122 or c > 127 else 32 for c in _LOWER)
#: Bytes of texts in which all that is beyond ASCII are letters: the two bytes of À to ÿ.
_KNOWN = bytes([*range(128), 0xC3, *range(0x80, 0xC0)])


def runs_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters."""
    if text.translate(None, _KNOWN):
        return _RUN.findall(text.translate(_LOWER))
    return text.translate(_SPACED).split()


# Vocabulary


class Tally:
    """Counts of words by number, while a task meets them; the checksums of all words of a document at once.

    A checksum is affine in what was read before: that of a document's prefix and a word is the word's own, changed by a value that depends
    on the prefix and the word's length alone.
    """

    SHORT = 64

    def __init__(self, slip: int | None):
        self.slip = slip
        self.zeros = [crc32(bytes(k)) for k in range(self.SHORT)]
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.checksums = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)
        self.counts = np.zeros(1024, np.int64)
        self.slips: Counter[bytes] = Counter()
        self.letters = 0

    def full(self) -> bool:
        return len(self.words) + len(self.slips) > MOST_WORDS or self.letters > MOST_LETTERS

    def _meet(self, word: bytes) -> int:
        n = self.number[word] = len(self.words)
        if n == len(self.counts):
            more = np.zeros(n, np.int64)
            self.checksums, self.lengths, self.counts = (np.concatenate((x, more)) for x in (self.checksums, self.lengths, self.counts))
        self.checksums[n], self.lengths[n] = crc32(word), len(word)
        self.words.append(word)
        self.letters += len(word)
        return n

    def add(self, prefix: bytes, text: bytes) -> None:
        """The words of a text whose document has that prefix."""
        found = Counter(runs_of(text))
        met = np.fromiter(map(self.number.get, found, repeat(-1)), np.int64, len(found))
        if len(new := np.flatnonzero(met < 0)):
            words = list(found)
            met[new] = [self._meet(words[i]) for i in new.tolist()]
        counts = np.fromiter(found.values(), np.int64, len(found))
        if self.slip:
            length, begun, shifts = self.lengths[met], crc32(prefix), np.zeros(self.SHORT, np.int64)
            after = begun
            for k in range(1, self.SHORT):
                after = crc32(b"\0", after)
                shifts[k] = after ^ self.zeros[k]
            checksum = self.checksums[met] ^ shifts[np.minimum(length, self.SHORT - 1)]
            for i in np.flatnonzero(length >= self.SHORT).tolist():
                checksum[i] = crc32(self.words[met[i]], begun)
            for i in np.flatnonzero(checksum % self.slip == 0).tolist():
                word = self.words[met[i]].decode()
                place = int(checksum[i]) % len(word)
                left = (word[:place] + word[place + 1 :]).encode()
                self.slips[left] += int(counts[i])
                self.letters += len(left)
                counts[i] = 0
        self.counts[met] += counts

    def rows(self) -> tuple[list[str], list[int]]:
        """Words that are long enough, and their counts; a word may stand twice."""
        kept = [(w.decode(), n) for w, n in zip(self.words, self.counts.tolist()) if n and len(w) >= LEAST_LETTERS]
        kept += [(w.decode(), n) for w, n in self.slips.items()]
        kept = [x for x in kept if len(x[0]) >= LEAST_LETTERS]
        return [w for w, _ in kept], [n for _, n in kept]


def vocabulary(docs: DataFrame, slip: int | None = SLIP) -> DataFrame:
    """Rows (word, n) of all words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(slip)

        def counted() -> pa.RecordBatch:
            words, n = tally.rows()
            tally.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                tally.add(f"{'' if i is None else i}:".encode(), text)
                if tally.full():
                    yield counted()
        yield counted()

    counts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# Keys


ENTRY = pa.schema(
    [("key", pa.binary()), ("word", pa.string()), ("n", pa.int64()), ("shorter", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]
)
ENTRY_DDL = "key binary, word string, n long, shorter int, low int, high int"


def entry(word: str, n: int, shorter: int, low: int, high: int) -> dict:
    """The key of a word in pairs whose shorter word has ``shorter`` letters, with the error in its letters ``low`` to ``high``."""
    exact = f"{shorter} {low} {high} {word[:low]} {word[len(word) - (shorter - high) :]}"
    return {"key": xxhash.xxh3_128_digest(exact.encode()), "word": word, "n": n, "shorter": shorter, "low": low, "high": high}


def entries(words: DataFrame) -> DataFrame:
    """Each word under the left and the right halves, as the shorter and as the longer word of a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for shorter in (len(word), len(word) - 1):
                    if shorter >= LEAST_LETTERS:
                        half = shorter // 2
                        out += [entry(word, n, shorter, 0, half), entry(word, n, shorter, half, shorter)]
            yield pa.RecordBatch.from_pylist(out, schema=ENTRY)

    return words.select("word", "n").mapInArrow(run, ENTRY_DDL)


def halved(rows: DataFrame) -> DataFrame:
    """Entries with the window in two: what was left out is exact but for one half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                middle = (x["low"] + x["high"]) // 2
                for low, high in ((x["low"], middle), (middle, x["high"])):
                    out.append(entry(x["word"], x["n"], x["shorter"], low, high))
            yield pa.RecordBatch.from_pylist(out, schema=ENTRY)

    return rows.select(ENTRY.names).mapInArrow(run, ENTRY_DDL)


def even_entries(words: DataFrame, most: int = SHARD_SYMBOLS) -> DataFrame:
    """Entries whose keys have at most so many letters of words, or windows of a single letter."""
    rows, done = stored(entries(words), "spelling-keys"), None
    while True:
        sizes = rows.groupBy("key").agg(F.sum(F.char_length("word")).alias("letters"), F.max(F.col("high") - F.col("low")).alias("window"))
        hot = stored(sizes.where((F.col("letters") > most) & (F.col("window") > 1)).select("key"), "hot-keys")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        even = rows.join(hot, "key", "left_anti")
        done = even if done is None else done.unionByName(even)
        rows = stored(halved(rows.join(hot, "key", "left_semi")), "spelling-keys")


# Bidirectional FM-index


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places in the order of the suffixes; the last symbol, 0, occurs once. Ranks of 8 symbols, then of twice as many each round."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.int64)))
    packed = np.zeros(n, np.int64)
    for i in range(8):
        packed = packed << 7 | padded[i : i + n]
    rank, step = np.unique(packed, return_inverse=True)[1], 8
    while rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class Transform:
    """Burrows-Wheeler transform of a text of symbols, with counts of every symbol before every ``STEP``-th place."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        self.symbols, self.length = symbols, len(text)
        held = np.bincount(text, minlength=symbols)
        self.first = np.cumsum(held) - held
        blocks = len(text) // STEP + 1
        padded = np.full(blocks * STEP, symbols, np.uint8)
        padded[: len(text)] = text[order - 1]
        self.blocks = padded.reshape(blocks, STEP)
        own = np.bincount((np.arange(blocks)[:, None] * (symbols + 1) + self.blocks).ravel(), minlength=blocks * (symbols + 1))
        own = own.reshape(blocks, symbols + 1)[:, :symbols].astype(np.int32)
        self.before = np.cumsum(own, axis=0, dtype=np.int32) - own
        #: Where the suffixes begin that start with a delimiter, in their order.
        self.delimiters = order[self.first[1] : self.first[1] + held[1]]

    def count(self, symbol: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        block, rest = places // STEP, (places % STEP).astype(np.uint8)
        inside = (self.blocks[block] == symbol[:, None].astype(np.uint8)) & (_PLACES < rest[:, None])
        return self.before[block, symbol] + inside.sum(axis=1)

    def counts(self, places: np.ndarray) -> np.ndarray:
        """For each place, how often every symbol stands before it."""
        block, rest = places // STEP, places % STEP
        symbols = np.where(_PLACES < rest[:, None], self.blocks[block], self.symbols)
        flat = (np.arange(len(places))[:, None] * (self.symbols + 1) + symbols).ravel()
        inside = np.bincount(flat, minlength=len(places) * (self.symbols + 1)).reshape(-1, self.symbols + 1)
        return self.before[block] + inside[:, : self.symbols]


_PLACES = np.arange(STEP, dtype=np.uint8)


class States(NamedTuple):
    """Matches in progress: query, the next of its symbols, the interval of ranks of the match in the transform that extends it."""

    query: np.ndarray
    at: np.ndarray
    rank: np.ndarray
    size: np.ndarray

    def take(self, which) -> States:
        return States(*(x[which] for x in self))

    def moved(self, by: int = 1) -> States:
        return self._replace(at=self.at + by)

    @staticmethod
    def together(parts: list[States]) -> States:
        return States(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def extended(states: States, symbol: np.ndarray, transform: Transform) -> States:
    """The states whose extension by their symbol occurs."""
    parts = [states.take(slice(0, 0))]
    for i in range(0, len(symbol), AT_ONCE):
        part, own = states.take(slice(i, i + AT_ONCE)), symbol[i : i + AT_ONCE]
        begin = transform.count(own, part.rank)
        size = transform.count(own, part.rank + part.size) - begin
        parts.append(part._replace(rank=transform.first[own] + begin, size=size).take(np.flatnonzero(size)))
    return States.together(parts)


def branches(states: States, transform: Transform) -> tuple[np.ndarray, np.ndarray, States]:
    """All extensions by a symbol that occur: number of the state, symbol, the longer match."""
    begin = transform.counts(states.rank)
    sizes = transform.counts(states.rank + states.size) - begin
    which, symbol = np.nonzero(sizes)
    rank = transform.first[symbol] + begin[which, symbol]
    return which, symbol, States(states.query[which], states.at[which], rank, sizes[which, symbol])


class Patterns:
    """Words as symbols, read from the side where the exact part is: ``exact`` symbols, then the window up to ``end``, then the rest."""

    def __init__(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray, exact: np.ndarray, end: np.ndarray, from_right: np.ndarray):
        self.flat, self.length, self.exact, self.end = flat, length, exact, end
        self.origin = np.where(from_right, start + length - 1, start)
        self.way = np.where(from_right, -1, 1)

    def symbol(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The symbol of each query at a place; the delimiter before its first and behind its last."""
        inside = (at >= 0) & (at < self.length[query])
        place = np.where(inside, self.origin[query] + self.way[query] * at, 0)
        return np.where(inside, self.flat[place], 1)


def matched_halves(patterns: Patterns, queries: np.ndarray, outward: Transform, inward: Transform) -> States:
    """The exact parts, matched from their inner end outwards to the delimiter; as ranks of ``inward``, which extends them at their inner end.

    Each step keeps both intervals: the one in ``inward`` moves by the occurrences of smaller symbols in the one in ``outward``.
    """
    n, done = len(queries), []
    states = States(queries, patterns.exact[queries] - 1, np.zeros(n, np.int64), np.full(n, outward.length, np.int64))
    other = np.zeros(n, np.int64)
    while len(states.query):
        symbol, parts = patterns.symbol(states.query, states.at), []
        for i in range(0, len(symbol), AT_ONCE):
            part, own = states.take(slice(i, i + AT_ONCE)), symbol[i : i + AT_ONCE]
            begin = outward.counts(part.rank)
            sizes = outward.counts(part.rank + part.size) - begin
            row = np.arange(len(own))
            smaller = (np.cumsum(sizes, axis=1) - sizes)[row, own]
            longer = part._replace(rank=outward.first[own] + begin[row, own], size=sizes[row, own])
            parts.append((longer, other[i : i + AT_ONCE] + smaller))
        states, other = States.together([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        # A half that only the word itself has leads nowhere else.
        live, ended = states.size > 1, states.at < 0
        last = np.flatnonzero(live & ended)
        done.append(states.take(last)._replace(rank=other[last]))
        on = np.flatnonzero(live & ~ended)
        states, other = states.take(on).moved(-1), other[on]
    halves = States.together(done) if done else states
    return halves._replace(at=patterns.exact[halves.query])


def one_error(patterns: Patterns, queries: np.ndarray, outward: Transform, inward: Transform) -> tuple[np.ndarray, np.ndarray]:
    """(query, rank) of all words that have, inside the window, one symbol more than the query or a larger one in place of its own. Ranks
    count the delimiters of ``inward``."""
    exact = matched_halves(patterns, queries, outward, inward)
    erred = exact.take(slice(0, 0))
    found = [erred]
    while len(exact.query) or len(erred.query):
        fresh, on = [], [exact.take(slice(0, 0))]
        for i in range(0, len(exact.query), AT_ONCE):
            part = exact.take(slice(i, i + AT_ONCE))
            which, symbol, longer = branches(part, inward)
            inside, own = part.at < patterns.end[part.query], patterns.symbol(part.query, part.at)[which]
            letter = symbol > 1
            fresh.append(longer.take(np.flatnonzero(letter)))
            fresh.append(longer.take(np.flatnonzero(letter & (symbol > own) & inside[which])).moved())
            on.append(longer.take(np.flatnonzero((symbol == own) & inside[which] & (longer.size > 1))).moved())
        longer = extended(erred, patterns.symbol(erred.query, erred.at), inward)
        ended = longer.at == patterns.length[longer.query]
        found.append(longer.take(np.flatnonzero(ended)))
        exact, erred = States.together(on), States.together([longer.take(np.flatnonzero(~ended)).moved(), *fresh])
    hits = States.together(found)
    return hits.query, hits.rank - inward.first[1]


def near_words(words: list[str], query: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of words of a shard, by number, that differ by one letter, each pair in both orders.

    ``query`` numbers the words that are entered as the shorter, or equally long, ones, with the windows ``low`` to ``high``; words are distinct.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    length = np.array([len(w) for w in words], np.int64)
    alphabet, letters = np.unique(codes, return_inverse=True)
    symbols = len(alphabet) + 2
    start = np.cumsum(length + 1) - length
    text = np.ones(len(letters) + len(words) + 2, np.int64)
    inside = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(len(letters))
    text[inside] = letters + 2
    text[-1] = 0
    forward, backward = Transform(text, symbols), Transform(np.concatenate((text[-2::-1], [0])), symbols)

    def behind_delimiters(transform: Transform, places: np.ndarray) -> np.ndarray:
        """Which word a suffix leads to that starts with a delimiter."""
        number = np.full(len(text), -1, np.int64)
        number[places] = np.arange(len(words))
        return number[transform.delimiters]

    word_forward = behind_delimiters(forward, start - 1)
    word_backward = behind_delimiters(backward, len(text) - 2 - (start + length))
    own, from_right = length[query], low == 0
    patterns = Patterns(text, start[query], own, np.where(from_right, own - high, low), np.where(from_right, own, high), from_right)
    pairs = []
    # A match is extended to the left by the transform of the text, to the right by that of the reversed one.
    for mask, outward, inward, word_of in ((~from_right, forward, backward, word_backward), (from_right, backward, forward, word_forward)):
        which, rank = one_error(patterns, np.flatnonzero(mask), outward, inward)
        a, b = query[which], word_of[rank]
        pairs += [a * len(words) + b, b * len(words) + a]
    pairs = np.unique(np.concatenate(pairs))
    return pairs // len(words), pairs % len(words)


def near_pairs(words: DataFrame) -> DataFrame:
    """Rows (word, near, near_n): each word with each of its near words and that one's count."""
    rows = stored(even_entries(words), "spelling-entries")
    letters = rows.agg(F.sum(F.char_length("word"))).first()[0] or 0
    shards = max(1, -(-letters // SHARD_SYMBOLS))

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        # A key of one word leads nowhere.
        frame = frame[frame.duplicated("key", keep=False)]
        if not len(frame):
            return pd.DataFrame({"word": np.zeros(0, object), "near": np.zeros(0, object), "near_n": np.zeros(0, np.int64)})
        query, words = pd.factorize(frame["word"])
        n = np.zeros(len(words), np.int64)
        n[query] = frame["n"].to_numpy()
        asks = (frame["shorter"] == frame["word"].str.len()).to_numpy()
        a, b = near_words(list(words), query[asks], *(frame[c].to_numpy(np.int64)[asks] for c in ("low", "high")))
        return pd.DataFrame({"word": words[a], "near": words[b], "near_n": n[b]})

    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")
    found = rows.select(shard, *ENTRY.names).groupBy("shard").applyInPandas(search, "word string, near string, near_n long")
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) for the rows (word, form): the last of the forms that follow each other."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(reached.join(further, "root", "left"), "spelling-roots")
        if joined.where("next is not null").isEmpty():
            return reached
        reached = joined.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame, slip: int | None = SLIP) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for all words."""
    words = stored(vocabulary(docs, slip), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    found = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    met = words.join(found, "word", "left")
    has_form = -F.col("best.order") >= RATIO * F.col("n")
    met = met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, -F.col("best.order")).alias("form_n"),
    )
    met = stored(met, "spelling-forms")
    rooted = met.join(roots(met.where("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
