"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much text goes whole.

Lines are split at \\n. A line without a word is neither judged nor counted. A line fails if

- navigation: it has at least 3 of the characters ``#*$%&|<>`` for 10 words (menus, tables, markup);
- shouting: it has at least 3 times ``!!`` for 10 words;
- punctuation: none of its words ends a sentence (a closing mark, quotes or brackets after it allowed), in a line of 3 words or more
  that is not the only line of its document;
- boilerplate: it has 20 words at most and one of ``PHRASES``, or it equals an earlier line of the document.

A document is kept if it passes the base rule (10 words or more, at most a fifth of them in 5-word windows that occur
twice in it) and at least 7 of 10 words are in lines that pass. One pass over the rows, no shuffle; a task holds one Arrow batch.

Defined results: a null or empty text has no words and is not kept. Rows are judged one by one, so repeated ids and null ids
are allowed; an empty table gives an empty table; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopbank.llm.words import Names, covered, released, window_names

SYMBOLS = b"#*$%&|<>"
#: Own list: what pages say around a text.
PHRASES = (
    "all rights reserved", "click here", "cookie policy", "log in", "lorem ipsum", "powered by", "privacy policy",
    "read more", "sign up", "subscribe", "terms of service", "terms of use",
)
SENTENCE_END = r"[.!?…。！？؟।][\"')\]»”’]*([\x20\x09-\x0D]|$)"
MIN_WORDS, LEAST_KEPT = 10, 7

SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_kept_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
)
DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_kept_words long, "
    "base_failed boolean, kept boolean"
)
_ENDS = re.compile(SENTENCE_END)
_PHRASES = re.compile("|".join(map(re.escape, PHRASES)))


def repeated_words(words: list[bytes], names: Names) -> int:
    """Words inside 5-word windows that occur twice or more."""
    if len(words) < 6:
        return 0
    windows = window_names(names.of(words), 5)
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if counts.max() == 1:
        return 0
    return int(covered(counts[inverse] > 1, 5).sum())


def line_passes(line: str, n_words: int, alone: bool) -> bool:
    raw = line.encode()
    if 10 * (len(raw) - len(raw.translate(None, SYMBOLS))) >= 3 * n_words or 10 * line.count("!!") >= 3 * n_words:
        return False
    if n_words >= 3 and not alone and not _ENDS.search(line):
        return False
    return n_words > 20 or not _PHRASES.search(line.lower())


def judged(text: str | None, names: Names) -> tuple[dict, list[str]]:
    """The figures of one text, and its lines that pass (those without words among them)."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n, kept, dup, lines, seen = len(words), 0, 0, [], set()
    split = text.split("\n")
    counts = [len(line.encode().split()) for line in split]
    alone = sum(map(bool, counts)) == 1
    for line, n_line in zip(split, counts, strict=True):
        if not n_line:
            lines.append(line)
        elif line in seen:
            dup += 1
        else:
            seen.add(line)
            if line_passes(line, n_line, alone):
                kept += n_line
                lines.append(line)
    repeats = repeated_words(words, names)
    failed = n < MIN_WORDS or 100 * repeats > 20 * n
    figures = {
        "n_words": n, "word_chars": len(text) - sum(map(text.count, " \t\n\v\f\r")),
        "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)), "n_dup_lines": dup, "n_repeat_words": repeats,
        "n_kept_words": kept, "base_failed": failed, "kept": not failed and 10 * kept >= LEAST_KEPT * n,
    }
    return figures, lines


def line_quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Figures and verdict of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for i, text in zip(ids, batch.column(1).to_pylist(), strict=True):
                rows.append({"doc_id": i} | judged(text, names)[0])
            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return docs.select(f"`{id_column}`", f"`{text_column}`").mapInArrow(run, DDL)


def cleaned(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """The documents kept, with their failing lines taken out. All columns stay; a column of text lengths is set anew."""
    names_of = docs.columns
    text_at, length_at = names_of.index(text_column), names_of.index(length_column) if length_column in names_of else None
    plain = docs.toDF(*[f"c{i}" for i in range(len(names_of))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in batches:
            keep, texts = [], []
            for i, text in enumerate(batch.column(text_at).to_pylist()):
                figures, lines = judged(text, names)
                if figures["kept"]:
                    keep.append(i)
                    texts.append("\n".join(lines))
            columns = list(batch.take(pa.array(keep, pa.int64())).columns)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            if length_at is not None:
                columns[length_at] = pa.array(list(map(len, texts)), columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return plain.mapInArrow(released(run), plain.schema).toDF(*names_of)
