"""Exact token counts at every prefix of a text, by dynamic programming over the prefixes of its words.

For vocabularies in which text is lower-cased, split into words by a pattern, and each word is merged by ranks with an end-of-word
mark. A word's merged form is the one sequence of tokens of which each two neighbours stay two when merged alone. So the last token of
each prefix, with a count one above that of the prefix before it, follows from earlier prefixes: ``last[i]`` is the token
that ends at i and gets on with ``last`` at its start. The same step with the end mark gives the count if the text ended there.

A text's count at a prefix is that of its whole words before plus that of the cut word. ``run_table`` stores the counts at the ends of
all runs between spaces; ``token_prefixes`` stores them at every character. Lengths and budgets are looked up there: a count is an entry, a budget
a binary search and the prefixes of one run; no text is encoded again. Words are remembered per worker, in two generations of bounded size; getting-on is
remembered for pairs of tokens. Special tokens inside a text count as one, as the library has it by default.

One pass over the rows, no shuffle; the vocabulary, a file of known size, is broadcast.

Defined results: a null text counts as empty: no bytes, no tokens. Positions are code points of the normal form (NFC, lower case); they
are the text's own unless composing or lower-casing changes a character's length. Repeated and null ids are allowed; an empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = "</w>"
#: Words a worker remembers in each generation.
REMEMBERED = 400_000
#: Longer runs, in characters, are not remembered.
LONG_RUN = 64
#: Documents whose tables leave a task together.
ROWS = 500
_PAIRS = 1_000_000


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Remembered:
    """Values for strings seen lately: when the young generation is full it becomes the old one, which is forgotten."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key: str):
        known = self.young.get(key)
        if known is None and (known := self.old.get(key)) is not None:
            self[key] = known
        return known

    def __setitem__(self, key: str, value) -> None:
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[key] = value


class PrefixCounter:
    """Counts of a vocabulary, given as the parsed JSON file."""

    def __init__(self, spec: dict):
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if model["end_of_word_suffix"] != END or steps[1]["use_regex"] or spec["post_processor"]:
            raise ValueError("not a vocabulary of lower-cased words with end marks")
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.halves = {a + b: (a, b) for a, b in reversed(self.ranks)}
        self.kinds = self.string_kinds(model["vocab"])
        self.words = regex.compile(steps[0]["pattern"]["Regex"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.bytes = byte_characters()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.chunks, self.pieces, self.every = Remembered(), Remembered(), Remembered()

    def string_kinds(self, vocabulary: dict[str, int]) -> dict[str, int]:
        """For each string that ends a token (marks aside): 1 if it is a token inside a word, plus 2 if one at a word's end.

        A token that its own letters do not merge to never occurs and is left out.
        """
        kinds: dict[str, int] = {}
        for token in vocabulary:
            bare = token.removesuffix(END)
            if bare and self.merged(self.letters(token)) == [token]:
                kinds[bare] = kinds.get(bare, 0) | (2 if bare != token else 1)
                for i in range(1, len(bare)):
                    kinds.setdefault(bare[i:], 0)
        return kinds

    def merged(self, symbols: list[str]) -> list[str]:
        """Symbols after all merges, lowest rank first."""
        while len(symbols) > 1:
            rank, best = min((self.ranks.get(p, 1 << 60), p) for p in zip(symbols, symbols[1:], strict=False))
            if rank == 1 << 60:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    @staticmethod
    def letters(token: str) -> list[str]:
        """Single characters, the last one with the end mark if the token has it."""
        bare = token.removesuffix(END)
        out = list(bare)
        out[-1] += token[len(bare) :]
        return out

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """What stands at a token's left (0) or right (1) edge as it is merged, first to last, and the rank of the next merge there."""
        out, rank = [], 1 << 60
        while token in self.halves:
            out.append((token, rank))
            rank = self.ranks[self.halves[token]]
            token = self.halves[token][side]
        out.append((token, rank))
        return out[::-1]

    def gets_on(self, left: str, right: str) -> bool:
        """Whether two tokens side by side stay as they are: no merge over their border comes before those within them.

        Of equal merges the one further left comes first.
        """
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > _PAIRS:
                self.pairs.clear()
            x, y, i, j, known = self.edge(left, 1), self.edge(right, 0), 0, 0, True
            while known:
                over = self.ranks.get((x[i][0], y[j][0]), 1 << 60)
                if over < x[i][1] and over <= y[j][1] and over < 1 << 60:
                    known = False
                elif i + 1 == len(x) and j + 1 == len(y):
                    break
                elif x[i][1] <= y[j][1]:
                    i += 1
                else:
                    j += 1
            self.pairs[left, right] = known
        return known

    def word_prefixes(self, s: str, every: bool) -> list[int]:
        """Tokens of s[:i] taken as a word, for i from 0, or of s alone. ``s`` is in byte characters."""
        kinds, pairs, gets_on = self.kinds, self.pairs, self.gets_on
        last, counts, out, n = [""], [0], [0], len(s)
        for i in range(1, n + 1):
            inside, ending = (-1, -1) if every else (-1, 0) if i < n else (0, -1)
            for j in range(i - 1, -1, -1):
                token = s[j:i]
                kind = kinds.get(token)
                if kind is None:
                    break
                if inside < 0 and kind & 1:
                    known = True if not j else pairs.get((last[j], token))
                    if known or known is None and gets_on(last[j], token):
                        inside = j
                        if ending >= 0:
                            break
                if ending < 0 and kind & 2 and (not j or gets_on(last[j], token + END)):
                    ending = j
                    if inside >= 0:
                        break
            last.append(s[inside:i])
            counts.append(counts[inside] + 1)
            out.append(counts[ending] + 1)
        return out if every else out[-1:]

    def in_bytes(self, piece: str) -> str:
        return piece if piece.isascii() and piece.isprintable() else "".join(map(self.bytes.__getitem__, piece.encode()))

    def piece(self, piece: str) -> list[int]:
        """Tokens at the end of each character of a match of the pattern."""
        known = self.every.get(piece)
        if known is not None:
            return known
        counts = self.word_prefixes(self.in_bytes(piece), True)
        out = [counts[n] for n in np.cumsum([len(c.encode()) for c in piece]).tolist()]
        if piece[0] == "'":  # a cut contraction is an apostrophe and letters
            for i in range(2, len(piece)):
                cut = self.words.findall(piece[:i])
                if len(cut) > 1:
                    out[i - 1] = sum(self.piece(p)[-1] for p in cut)
        self.every[piece] = out
        return out

    def chunk(self, chunk: str) -> int:
        """Tokens of a run without spaces. What it reads is remembered, run by run and word by word, long runs aside."""
        known = self.chunks.get(chunk)
        if known is None:
            known = 0
            for word in self.words.findall(chunk):
                n = self.pieces.get(word)
                if n is None:
                    n = self.word_prefixes(self.in_bytes(word), False)[0]
                    if len(word) <= LONG_RUN:
                        self.pieces[word] = n
                known += n
            if len(chunk) <= LONG_RUN:
                self.chunks[chunk] = known
        return known

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def segments(self, text: str) -> Iterator[tuple[str, str]]:
        """(normal form of ordinary text, special token after it or "")."""
        at = 0
        for match in self.special.finditer(text):
            yield self.normal(text[at : match.start()]), match[0]
            at = match.end()
        yield self.normal(text[at:]), ""

    def run_ends(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """For each run of the text, its end and the tokens of the prefix up to there.

        Runs are what single spaces part, each with its space, and special tokens. An empty text has one run, which is empty.
        """
        lengths, tokens = [], []
        for segment, special in self.segments(text):
            chunks, get = segment.split(" "), self.chunks.young.get
            lengths += map(len, chunks)
            # The spaces go to the runs before them.
            lengths[-len(chunks) : -1] = [n + 1 for n in lengths[-len(chunks) : -1]]
            found = list(map(get, chunks))
            if None in found:
                found = [self.chunk(chunk) if n is None else n for n, chunk in zip(found, chunks, strict=True)]
            tokens += found
            if special:
                lengths.append(len(special))
                tokens.append(1)
        return np.cumsum(lengths, dtype=np.int64), np.cumsum(tokens, dtype=np.int64)

    def total(self, text: str) -> int:
        return int(self.run_ends(text)[1][-1])

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of text[:i] for i from 0 to the length (of the normal form, if that differs)."""
        parts, n = [np.zeros(1, np.int64)], 0
        for segment, special in self.segments(text):
            own = self.plain_prefixes(segment)
            parts.append(n + own[1:])
            if special:  # cut inside, it is ordinary text
                cut = self.plain_prefixes(segment + special[:-1])
                parts += [n + cut[len(segment) + 1 :], np.array([n + own[-1] + 1])]
            n += int(own[-1]) + bool(special)
        return np.concatenate(parts)

    def plain_prefixes(self, text: str) -> np.ndarray:
        steps, n = np.zeros(len(text) + 1, np.int64), 0
        for match in self.words.finditer(text):
            counts = np.array(self.piece(match[0]), np.int64)
            steps[match.start() + 1 : match.end() + 1] = np.diff(counts, prepend=0)
            n += int(counts[-1])
        return np.cumsum(steps)

    def fitting(self, text: str, ends: np.ndarray, tokens: np.ndarray, budget: int) -> int:
        """Length of the longest prefix of at most ``budget`` tokens, by the text's ``run_ends``.

        They are searched for the run in which the budget ends: a longer prefix holds that run whole. Only this run is looked into.
        """
        at = int(np.searchsorted(tokens, budget, side="right"))
        if at == len(ends):
            return int(ends[-1])
        begin, n = (int(ends[at - 1]), int(tokens[at - 1])) if at else (0, 0)
        run = "".join(a + b for a, b in self.segments(text))[begin : int(ends[at])]
        if self.special.fullmatch(run):  # cut inside, a special token is ordinary text
            return int(np.flatnonzero(self.prefixes(text) <= budget)[-1])
        for match in self.words.finditer(run):
            word = self.chunk(match[0])
            if n + word > budget:
                counts = self.piece(match[0])
                return begin + match.start() + max(k for k in range(len(counts) + 1) if not k or n + counts[k - 1] <= budget)
            n += word
        raise AssertionError("a run over the budget has a word over it")


class Vocabulary:
    """A broadcast vocabulary with a number that workers can tell it by."""

    def __init__(self, docs: DataFrame, path: str):
        with open(path, encoding="utf-8") as file:
            self.spec = docs.sparkSession.sparkContext.broadcast(json.load(file))
        self.id = self.spec._jbroadcast.id()

    def __getstate__(self) -> dict:
        return {"spec": self.spec, "id": self.id}

    @property
    def value(self) -> dict:
        return self.spec.value


_COUNTERS: dict[int, PrefixCounter] = {}


def counter_of(vocabulary: Vocabulary) -> PrefixCounter:
    """One counter for each worker and broadcast vocabulary, kept from task to task."""
    if vocabulary.id not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[vocabulary.id] = PrefixCounter(vocabulary.value)
    return _COUNTERS[vocabulary.id]


TABLE = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("run_ends", pa.list_(pa.int32())), ("run_tokens", pa.list_(pa.int32())), ("fitting_chars", pa.int64())]
)


def run_table(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """For each document: bytes, the end of each run and the tokens of the prefix up to it, and the longest prefix that fits into the budget.

    The length of that prefix is read from the two arrays and the counts at all prefixes of the one run in which the budget ends.
    """
    vocabulary = Vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                sizes, ends, tokens, fits = [], [], [], []
                for text in batch.column(1).to_pylist():
                    text = text or ""
                    own = counter.run_ends(text)
                    sizes.append(len(text.encode()))
                    ends.append(own[0].astype(np.int32))
                    tokens.append(own[1].astype(np.int32))
                    fits.append(len(text) if own[1][-1] <= budget else counter.fitting(text, *own, budget))
                arrays = [pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32())), pa.array(fits, pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=TABLE)

    columns = "doc_id long, n_bytes long, run_ends array<int>, run_tokens array<int>, fitting_chars long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, columns)


def token_counts(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """For each document: bytes, tokens, and the length of the longest prefix that fits into the budget; tokens are the last entry of its table."""
    n = F.element_at("run_tokens", -1).cast("long").alias("n_tokens")
    return run_table(docs, path, budget).select("doc_id", "n_bytes", n, "fitting_chars")


def token_prefixes(docs: DataFrame, path: str) -> DataFrame:
    """For each document the array of token counts at every prefix, the empty one first."""
    vocabulary = Vocabulary(docs, path)
    schema = pa.schema([("doc_id", pa.int64()), ("prefix_tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = {"doc_id": i, "prefix_tokens": counter.prefixes(text or "").tolist()}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, prefix_tokens array<long>")
