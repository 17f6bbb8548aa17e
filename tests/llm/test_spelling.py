"""Spelling variants against brute force: words and checksums, near words, forms and roots."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopbank.llm import spelling
from shopbank.llm.spelling import even_entries, near_pairs, near_words, spelling_variants, suffix_order, vocabulary
from tests.conftest import rows

LOW = {c: c + 32 for c in range(65, 91)}


def brute_words(docs, slip=97):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(docs, slip=97):
    n = brute_words(docs, slip)
    close = {w: [x for x in n if near(w, x)] for w in n}
    best = {w: min(close[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b and n[b] >= 2 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(close[w]), n.get(form[w])) for w in n), key=repr)


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def corpus(seed, letters="abcdé", most=8):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, most))) for _ in range(150)]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=120)).replace("a", rng.choice("aA"))) for i in range(40)]


def test_equals_brute_force(spark):
    odd = [(None, "Étude étude Étude éTUDE naïve naïves naives"), (None, None), (7, ""), (7, "x × y÷z ÷÷÷÷÷ ÷÷÷÷÷ ÷÷÷÷÷ 12345")]
    odd += [(8, "łódź Straße Strasse Straße strasse straße łódźka 日本語abcde"), (8, "Straße strasse"), (8, "Straße strasse")]
    for slip in (97, 3, None):
        docs = corpus(slip or 0) + odd
        assert rows(spelling_variants(frame(spark, docs), slip)) == brute(docs, slip)


def test_chain_of_forms_ends_at_its_root(spark):
    text = " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["abbbb"] * 48)
    got = {r["word"]: (r["form"], r["root"]) for r in spelling_variants(frame(spark, [(1, text)]), None).collect()}
    assert got["aaaaa"] == ("aaaab", "abbbb") and got["abbbb"] == (None, "abbbb")


def test_ties_go_by_code_points(spark):
    text = " ".join(["woord"] * 3 + ["wooré"] * 9 + ["woore"] * 9 + ["wooro"] * 9)
    got = {r["word"]: r["form"] for r in spelling_variants(frame(spark, [(1, text)]), None).collect()}
    assert got["woord"] == "woore"


def test_index_finds_all_pairs_under_halves_and_quarters():
    rng = random.Random(3)
    for trial in range(12):
        letters = "abé" if trial % 2 else "abcdefgh"
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(rng.randint(1, 300))})
        asks = []
        for i, w in enumerate(words):
            edges = [0, len(w) // 4, len(w) // 2, 3 * len(w) // 4, len(w)] if trial % 3 == 0 else [0, len(w) // 2, len(w)]
            asks += [(i, a, b) for a, b in zip(edges, edges[1:])]
        a, b = near_words(words, *np.array(asks).T)
        want = {(i, j) for i, x in enumerate(words) for j, y in enumerate(words) if near(x, y)}
        assert set(zip(a.tolist(), b.tolist())) == want


def test_suffix_order():
    rng = np.random.default_rng(5)
    for n in (1, 2, 9, 100, 3000):
        text = np.append(rng.integers(1, 4, n), 0)
        raw = bytes(text.tolist())
        assert suffix_order(text).tolist() == sorted(range(n + 1), key=lambda i: raw[i:])


@pytest.mark.parametrize("most", [200, 2000])
def test_hot_halves_are_divided_and_lose_no_pair(spark, most, monkeypatch):
    rng = random.Random(1)
    words = {"gemeinsamerstamm" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) for _ in range(300)}
    words |= {"".join(rng.choice("abc") for _ in range(3)) + "ungemeinsam" for _ in range(27)}
    frame_of = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    monkeypatch.setattr(spelling, "SHARD_SYMBOLS", most)
    even = even_entries(frame_of, most)
    sizes = even.groupBy("key").agg(F.sum(F.char_length("word")).alias("letters"), F.max(F.col("high") - F.col("low")).alias("window"))
    assert sizes.where(f"letters > {most} and window > 1").isEmpty()
    got = {(r["word"], r["near"]) for r in near_pairs(frame_of).collect()}
    assert got == {(x, y) for x in words for y in words if near(x, y)}


def test_very_long_runs_and_texts(spark):
    long = "".join(random.Random(2).choice("abcdefgh") for _ in range(4000))
    docs = [(1, " ".join([long] * 6 + [long[:2000] + "z" + long[2000:]] * 3 + [long[:-1]] * 3)), (2, "words and words again " * 50_000)]
    assert rows(spelling_variants(frame(spark, docs), None)) == brute(docs, None)


def test_counts_are_handed_on_when_a_task_has_many(spark, monkeypatch):
    docs = corpus(9)
    monkeypatch.setattr(spelling, "MOST_WORDS", 10)
    tally = spelling.Tally(97)
    got = Counter()
    for i, text in docs:
        tally.add(f"{i}:".encode(), text.encode())
        if tally.full():
            got.update(dict(zip(*tally.rows())))
            tally.clear()
    for w, n in zip(*tally.rows()):
        got[w] += n
    assert {w: n for w, n in got.items() if n >= 3}.keys() <= brute_words(docs).keys()
    assert rows(vocabulary(frame(spark, docs))) == sorted(brute_words(docs).items(), key=repr)


def test_empty_table_and_clashing_columns(spark):
    assert spelling_variants(frame(spark, [])).collect() == []
    assert spelling_variants(frame(spark, [(1, "one two")])).collect() == []
    docs = corpus(4)
    odd = frame(spark, docs).selectExpr("*", "text as word", "doc_id as n", "text as `a.b`", "text as key", "doc_id as shard")
    assert rows(spelling_variants(odd)) == brute(docs)
