"""Word n-gram scores against brute force, and what a fixed table of symbols can't tell apart."""

from collections import Counter

import numpy as np
import pytest

from shopbank.llm import word_scoring
from shopbank.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
ROWS = [
    (1, "the year 1984 was good"), (2, "the year 2001 was bad, bad"), (3, "Привет мир"), (4, "Ηλιος και"), (5, "你好世界"), (6, "你们世界"),
    (7, None), (8, ""), (9, " \n"), (1, "Again the YEAR"), (None, "the year 1984 was good"), (10, "the year 1984 was bad"), (11, "x"),
]


def brute(rows, wanted):
    counts, before, kept = [Counter(), Counter()], [Counter(), Counter()], []
    for i, text in rows:
        tokens = word_scoring.tokens_of(text)
        padded = [None, None, *tokens]
        kept.append((i, [tuple(padded[k : k + 3]) for k in range(len(tokens))]))
        for gram in kept[-1][1]:
            for model in (0, 1) if i in wanted and i is not None else (1,):
                for size in (1, 2, 3):
                    counts[model][gram[3 - size :]] += 1
                    before[model][size, gram[3 - size : 2]] += 1

    def p(model, gram):
        shorter = counts[1][gram[2:]] / before[1][1, ()]
        mean = (1 - sum(word_scoring.WEIGHTS)) * shorter
        for size, weight in zip((1, 2, 3), reversed(word_scoring.WEIGHTS), strict=True):
            n = before[model][size, gram[3 - size : 2]]
            shorter = counts[model][gram[3 - size :]] / n if n else shorter
            mean += weight * shorter
        return mean

    return [(i, len(g), np.mean([np.log(p(1, x)) - np.log(p(0, x)) for x in g]) if g else None) for i, g in kept]


def scores(spark, rows, wanted):
    ids = spark.createDataFrame([(i,) for i in wanted], "doc_id long")
    got = word_scoring.word_cross_entropy_difference(spark.createDataFrame(rows, SCHEMA).repartition(3), ids).collect()
    return sorted(map(tuple, got), key=lambda r: tuple((x is None, x or 0) for x in r))


def same(got, want):
    want = sorted(want, key=lambda r: tuple((x is None, x or 0) for x in r))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for a, b in zip(got, want, strict=True):
        assert (a[2] is None) == (b[2] is None) and (a[2] is None or a[2] == pytest.approx(b[2], abs=1e-5))


@pytest.mark.parametrize("tokens", [1 << 20, 8])
def test_equals_brute_force(spark, monkeypatch, tokens):
    monkeypatch.setattr(word_scoring, "BLOCK_TOKENS", tokens)
    wanted = [1, 3, 5, 3, None, 99]
    same(scores(spark, ROWS, wanted), brute(ROWS, wanted))
    same(scores(spark, ROWS, []), brute(ROWS, []))
    assert scores(spark, ROWS[:0], wanted) == []


def test_digits_capitals_and_other_scripts_count(spark):
    pairs = [("in 1984", "in 2001"), ("Rust", "rust"), ("мир", "лир"), ("你", "们")]
    rows = [(2 * k + j, text) for k, pair in enumerate(pairs) for j, text in enumerate(pair)]
    got = {r[0]: r[2] for r in scores(spark, rows, [0, 2, 4, 6])}
    assert all(got[2 * k] < got[2 * k + 1] - 0.1 for k in range(len(pairs)))


def test_query_counts_words(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r.n_tokens for r in QUERIES["op5_lm_scoring"](spark, folder).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert got == {i: len(word_scoring.tokens_of(t)) for i, t in texts.items()}
