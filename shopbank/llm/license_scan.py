"""License scan: winnowed fingerprints of templates pick candidates, banded alignment reports what matches and where.

Words are runs of ASCII letters and digits, lower-cased, and of characters beyond ASCII. The index holds, of each template's 3-word
windows, the least of each 4 neighbours (winnowing), so any 6 words copied from a template hold an indexed window; a template with
fewer windows has its least one. A document's windows are all looked up. From each hit in turn whose words are not yet taken, the template
is aligned to the words around within a band of ``BAND`` diagonals on either side (match 2, other steps -1), until no hit is left, so
each of several occurrences is found. Pieces that follow one another in the template are chained over insertions of up to the template's
length. Reported are the share of the template's words that match and the span from the first to the last of them.

One pass over the rows, no shuffle; the templates are a parameter, indexed on the driver and sent with the code.

Defined results: a null or empty text has no match. Overlapping matches are reported for the best template only (matched words, coverage,
then name). Repeated and null ids are allowed; an empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopbank.llm.license_templates import MARKED, MARKS, TEMPLATES
from shopbank.llm.words import U64, Names, texts_of, window_names

GRAM, WINNOW = 3, 4
BAND = 12
LEAST_COVERAGE = 0.75

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPLIT = bytes(c if _WORD.match(bytes([c])) else 32 for c in _LOWER)


def license_words(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


class Index:
    """Templates as rows of word names, and an inverted index from fingerprints to (template, place)."""

    def __init__(self, templates: dict[str, list[str]]):
        names = Names()
        self.labels = [name for name, texts in templates.items() for _ in texts]
        self.rows = [names.of(license_words(text.encode())) for texts in templates.values() for text in texts]
        self.marks = names.of([mark.encode() for mark in sorted(MARKS)])
        #: For templates of families that differ by single words, the places of those words.
        self.marked = [
            frozenset(np.flatnonzero(np.isin(row, self.marks)).tolist()) if label.split("-")[0] in MARKED else None
            for label, row in zip(self.labels, self.rows, strict=True)
        ]
        found: list[tuple[int, int, int]] = []
        for t, row in enumerate(self.rows):
            prints = window_names(row, min(GRAM, len(row)))
            width = min(WINNOW, len(prints))
            chosen = {i + int(prints[i : i + width].argmin()) for i in range(len(prints) - width + 1)}
            found += [(int(prints[i]), t, i) for i in sorted(chosen)]
        found.sort()
        self.prints = np.array([p for p, _, _ in found], U64)
        self.template = np.array([t for _, t, _ in found], np.int64)
        self.place = np.array([i for _, _, i in found], np.int64)

    def named(self, t: int, words: np.ndarray, pairs: list[tuple[int, int]]) -> bool:
        """Whether the words that tell the template's license from its neighbours all match, with no other one among them."""
        if self.marked[t] is None:
            return True
        matched = {j for _, j in pairs}
        between = np.array([j for j in range(pairs[0][1], pairs[-1][1]) if j not in matched], np.int64)
        return self.marked[t] <= {i for i, _ in pairs} and not np.isin(words[between], self.marks).any()

    def hits(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """For each template the (document place, template place) of shared windows, in order of place."""
        prints = window_names(words, GRAM)
        low, high = np.searchsorted(self.prints, prints), np.searchsorted(self.prints, prints, side="right")
        out: dict[int, list[tuple[int, int]]] = {}
        for at in np.flatnonzero(high > low).tolist():
            for k in range(low[at], high[at]):
                out.setdefault(int(self.template[k]), []).append((at, int(self.place[k])))
        return out


def aligned(template: np.ndarray, words: np.ndarray, diagonal: int) -> list[tuple[int, int]]:
    """(template place, document place) of the matching words in the best local alignment within the band."""
    m, width = len(template), 2 * BAND + 1
    score = np.zeros((m + 1, width + 2), np.int64)
    step = np.zeros((m + 1, width + 2), np.int8)
    band = np.arange(width)
    at = diagonal - BAND + np.arange(m)[:, None] + band
    inside = (at >= 0) & (at < len(words))
    gain = np.where(words[np.where(inside, at, 0)] == template[:, None], 2, -1)
    for i in range(1, m + 1):
        # A row at once: what comes from the left is a running maximum that falls by one with each place.
        straight, above = score[i - 1, 1:-1] + gain[i - 1], score[i - 1, 2:] - 1
        row = np.maximum.accumulate(np.where(inside[i - 1], np.maximum(np.maximum(straight, above), 0), 0) + band) - band
        row[~inside[i - 1]] = 0
        left = np.concatenate(([-1], row[:-1] - 1))
        kinds = np.where(row == straight, 1, np.where(row == above, 2, np.where(row == left, 3, 0)))
        score[i, 1:-1], step[i, 1:-1] = row, np.where(inside[i - 1], kinds, 0)
    i, k = np.unravel_index(int(score.argmax()), score.shape)
    out = []
    while step[i, k]:
        kind, j = step[i, k], diagonal + i - 1 + k - 1 - BAND
        if kind == 1 and template[i - 1] == words[j]:
            out.append((i - 1, j))
        i, k = (i - 1, k) if kind == 1 else (i - 1, k + 1) if kind == 2 else (i, k - 1)
    return out[::-1]


def pieces(template: np.ndarray, words: np.ndarray, hits: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Alignments that share no document word, until each hit has one of its words in some alignment."""
    left, free = words.copy(), np.ones(len(words), bool)
    out = []
    for at, place in hits:
        while free[at : at + GRAM].all() and (pairs := aligned(template, left, at - place)):
            out.append(pairs)
            taken = [j for _, j in pairs]
            free[taken] = False
            left[taken] = 0
    return out


def chained(template: np.ndarray, found: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """Pieces that cover enough as they are, and the others joined to the pieces before that they carry on."""
    whole = [x for x in found if len(x) >= LEAST_COVERAGE * len(template)]
    chains: list[list[tuple[int, int]]] = []
    for piece in sorted((x for x in found if len(x) < LEAST_COVERAGE * len(template)), key=lambda x: x[0][1]):
        best, rest = None, []
        for chain in chains:
            place, end = chain[-1]
            more = [(i, j) for i, j in piece if i > place and j > end]
            if len(more) > len(rest) and more[0][1] - end <= max(4 * BAND, len(template)):
                best, rest = chain, more
        if best is not None:
            best += rest
        else:
            chains.append(list(piece))
    return whole + chains


def found_licenses(text: bytes, index: Index, names: Names) -> list[dict]:
    """Matches in order of place: license, matched words, coverage, and the span in words and in bytes."""
    words = names.of(license_words(text))
    if len(words) < GRAM:
        return []
    matches = []
    for t, hits in index.hits(words).items():
        for pairs in chained(index.rows[t], pieces(index.rows[t], words, hits)):
            coverage = len(pairs) / len(index.rows[t])
            if coverage >= LEAST_COVERAGE and index.named(t, words, pairs):
                matches.append((-len(pairs), -coverage, index.labels[t], pairs[0][1], pairs[-1][1] + 1))
    taken: list[tuple[int, int]] = []
    out = []
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))] if matches else []
    for matched, coverage, label, start, end in sorted(matches):
        if all(end <= a or b <= start for a, b in taken):
            taken.append((start, end))
            span = {"start_word": start, "end_word": end, "start_byte": places[start][0], "end_byte": places[end - 1][1]}
            out.append({"license": label, "matched_words": -matched, "coverage": -coverage} | span)
    return sorted(out, key=lambda x: x["start_word"])


COLUMNS = [("license", pa.string(), "string"), ("matched_words", pa.int64(), "long"), ("coverage", pa.float64(), "double")] + [
    (c, pa.int64(), "long") for c in ("start_word", "end_word", "start_byte", "end_byte")
]


def scanned(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """A row for each license text found in each document."""
    index = Index(templates or TEMPLATES)
    schema = pa.schema([("doc_id", pa.int64())] + [(name, kind) for name, kind, _ in COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                rows += [{"doc_id": i} | match for match in found_licenses(text, index, names)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{name} {kind}" for name, _, kind in COLUMNS))
