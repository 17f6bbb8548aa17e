"""Languages of pages against the posterior computed page by page in plain Python, with evidence that disagrees."""

import math
import random
from collections import Counter

import pytest

from shopbank.llm import language_id
from shopbank.llm.symbols import START, SYMBOLS, grams

VOCABULARY = {
    "da": "huset haven byen og den ikke som det til".split(),
    "no": "huset hagen byen og den ikke som det til".split(),
    "pt": "casa jardim cidade que para com uma não são".split(),
}
LANGUAGES = sorted(VOCABULARY)
HOSTS = [("https://www.one.dk/p{}", "one.dk", "da"), ("http://two.dk:80/p{}", "two.dk", "no"), ("https://m.three.no/{}?q=1", "three.no", "no"), ("HTTPS://Four.Com/{}", "four.com", "pt"), (None, "", "da")]


def pages():
    """Rows (page_id, url, html, host, declared, text); many texts are short, so hosts and declarations can outvote them."""
    rng = random.Random(4)
    out = []
    for i in range(240):
        url, host, usual = rng.choice(HOSTS[:1] * 4 + HOSTS)
        lang = usual if rng.random() < 0.7 else rng.choice(LANGUAGES)
        text = " ".join(rng.choice(VOCABULARY[lang]) for _ in range(rng.choice([0, 1, 1, 2, 3, 8, 30])))
        declared = rng.choice([lang, usual, rng.choice(LANGUAGES), "", "xx"])
        tag = f'<html class="x" lang="{declared.upper()}-Y">' if declared else "<html>"
        out.append((i, url and url.format(i), f"{tag}<head><title>casa</title></head><p>{text}</p>", host, declared, text))
    out += [(900, None, None, "", "", ""), (None, "", "", "", "", ""), (901, "https://one.dk/long", "com uma casa " * 20_000, "one.dk", "", " ".join(["com uma casa"] * 20_000))]
    return out + out[:3] + [out[5]] * 40


def labelled():
    rng = random.Random(5)
    rows = [(lang, " ".join(rng.choice(VOCABULARY[lang]) for _ in range(rng.randint(1, 40)))) for lang in LANGUAGES for _ in range(30)]
    return rows + [("da", None), ("no", ""), (None, "casa casa")]


def symbols(text):
    return [START, START, *grams(text.encode(), 1).tolist()]


def brute(pages, labelled):
    """Rows (page_id, text language, posterior of each language)."""
    triples = {lang: Counter() for lang in LANGUAGES}
    for lang, text in labelled:
        if lang is not None:
            s = symbols(text or "")
            triples[lang].update(zip(s, s[1:], s[2:]))
    pairs = {lang: Counter() for lang in LANGUAGES}
    for lang, counts in triples.items():
        for (a, b, _), n in counts.items():
            pairs[lang][a, b] += n

    def likelihood(lang, s):
        return sum(math.log((0.1 + triples[lang][t]) / (0.1 * SYMBOLS + pairs[lang][t[:2]])) for t in zip(s, s[1:], s[2:]))

    read = []
    for page, _, _, host, declared, text in pages:
        own = [likelihood(lang, symbols(text)) for lang in LANGUAGES]
        read.append((page, host, host.split(".")[-1], declared, own, own.index(max(own)) if text else None))
    by_host, by_suffix, by_declared, overall = Counter(), Counter(), Counter(), Counter()
    for _, host, suffix, declared, _, vote in read:
        if vote is not None:
            by_host[host, vote] += 1
            by_suffix[suffix, vote] += 1
            by_declared[declared, vote] += 1
            overall[vote] += 1
    kinds, n = len({r[3] for r in read}), len(LANGUAGES)

    def share(counts, key, i, vote, prior):
        others = [counts[key, k] - (k == vote) for k in range(n)]
        return (others[i] + language_id.STRENGTH * prior) / (sum(others) + language_id.STRENGTH)

    out = []
    for page, host, suffix, declared, own, vote in read:
        posterior = []
        for i in range(n):
            all_others = sum(overall.values()) - (vote is not None)
            prior = (overall[i] - (i == vote) + 1) / (all_others + n)
            prior = share(by_host, host, i, vote, share(by_suffix, suffix, i, vote, prior))
            declares = (by_declared[declared, i] - (i == vote) + 1 / kinds) / (overall[i] - (i == vote) + 1)
            posterior.append(language_id.TEXT_WEIGHT * own[i] + math.log(prior) + math.log(declares))
        out.append((page, host, suffix, declared, vote if vote is None else LANGUAGES[vote], posterior))
    return out


def test_posterior_equals_brute_force(spark):
    rows, train = pages(), labelled()
    given = spark.createDataFrame([(p, u, h, "own") for p, u, h, *_ in rows], "page_id long, url string, html string, host string").repartition(3)
    docs = spark.createDataFrame([(t, lang, 1) for lang, t in train], "text string, lang string, page_id int")
    got = language_id.identified(given, docs).collect()
    want = brute(rows, train)
    assert len(got) == len(rows)
    assert Counter((r.page_id, r.host, r.suffix, r.declared) for r in got) == Counter(w[:4] for w in want)
    by_page = {w[0]: w for w in want}
    for r in got:
        *_, text_language, posterior = by_page[r.page_id]
        most = max(posterior)
        assert r.text_language == text_language
        near = [LANGUAGES[i] for i, x in enumerate(posterior) if most - x < 0.01]
        assert r.language in near
        assert r.confidence == pytest.approx(1 / sum(math.exp(x - most) for x in posterior), rel=1e-2)
    # The fusion decides: many pages go against their text alone, and some against what they declare.
    assert sum(r.language != r.text_language and r.text_language is not None for r in got) > 10
    assert sum(r.declared in LANGUAGES and r.language != r.declared for r in got) > 10
