"""The whole pipeline against a brute-force chain of its five stages, row by row."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import corpus_pipeline
from tests.llm.test_operators import brute_components, sentence

PHRASES = ("all rights reserved", "click here", "read more", "privacy policy")
ENDS = re.compile(r"[.!?]([ \t]|$)")


def documents():
    """Rows (doc_id, text, source): near copies, repeated rows, benchmark passages, failing lines, null and empty texts."""
    rng = random.Random(21)
    base = [[sentence(rng, 30) for _ in range(4)] for _ in range(30)]
    rows = [(i, "\n".join(lines)) for i, lines in enumerate(base)]
    for k in range(12):  # edited copies, and copies in other case
        words = " ".join(base[k % 4]).split(" ")
        words[10 + k] = "edited"
        rows.append((100 + k, "\n".join(base[k % 4]).upper() if k % 3 == 0 else " ".join(words)))
    rows += [(200 + k, "\n".join([sentence(rng, 40), "Click here", "Home | News | Shop", sentence(rng, 30)])) for k in range(10)]
    rows += [(300 + k, "\n".join(["Read more now", "a menu of some words"] * 4 + [sentence(rng, 8)])) for k in range(4)]
    rows += [(400, None), (401, ""), (402, " \n "), (403, "too short."), (404, "word " * 60 + ".")]
    items = [(1, sentence(rng, 25)), (2, sentence(rng, 14)), (3, None)]
    rows += [(500, items[0][1] + " " + sentence(rng, 40)), (501, sentence(rng, 400) + " " + items[1][1])]
    rows += [rows[7]] * 3
    return [(i, t, [None, "a", "b", "c"][i % 4]) for i, t in rows], items


def brute_cleaned(text):
    words = (text or "").split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
        return None
    lines = text.split("\n")
    alone, kept, n_kept = sum(bool(x.split()) for x in lines) == 1, [], 0
    for at, line in enumerate(lines):
        n = len(line.split())
        bad = bool(n) and (
            line in lines[:at]
            or 10 * len(re.findall(r"[#*$%&|<>]", line)) >= 3 * n
            or 10 * line.count("!!") >= 3 * n
            or (n >= 3 and not alone and not ENDS.search(line))
            or (n <= 20 and any(p in line.lower() for p in PHRASES))
        )
        if not bad:
            kept.append(line)
            n_kept += n
    return "\n".join(kept) if 10 * n_kept >= 7 * len(words) else None


def brute_clean_of(items, text):
    def plain(t):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())

    words, hit = plain(text), set()
    for _, item in items:
        own = plain(item)
        for i in range(max(1, len(own) - 12) if own else 0):
            phrase = own[i : i + 13]
            hit |= {j + k for j in range(len(words) - len(phrase) + 1) if words[j : j + len(phrase)] == phrase for k in range(len(phrase))}
    return not hit or 20 * len(hit) < len(words)


def brute_mix(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_ones, rest = {}, set(names), Fraction(sum(sizes.values()))
    while open_ones:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_ones) for s in open_ones}
        over = {s for s in open_ones if share[s] > 3 * sizes[s]}
        target |= {s: Fraction(3 * sizes[s]) for s in over} if over else share
        rest -= sum(target[s] for s in over)
        open_ones = open_ones - over if over else set()
    out = Counter()
    for s in names:
        whole, budget = divmod(target[s], sizes[s])
        below, ended = 0, False
        for row in sorted((r for r in rows if r[2] == s), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()[:15]):
            n = len(row[1].split())
            more = not ended and budget >= below + Fraction(n, 2)
            ended = ended or below + n > budget
            below += n
            out[row] += int(whole) + more
    return +out


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, items = documents()
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    cleaned = [(i, c, s) for i, t, s in rows if (c := brute_cleaned(t)) is not None]
    assert 0 < len(cleaned) < len(rows)
    single = {r for r, x in zip(cleaned, brute_components([r[:2] for r in cleaned]), strict=True) if x[3]}
    assert len(single) < len(set(cleaned))
    clean = [r for r in single if brute_clean_of(items, r[1])]
    assert {r[0] for r in single} - {r[0] for r in clean} == {500}
    assert Counter((r.doc_id, r.text, r.source) for r in got) == brute_mix(clean)
    assert all(r.n_chars == len(r.text) and r.lang == "en" for r in got)

    place, loads = {}, Counter()
    for r in got:
        assert place.setdefault(r.text, r.shard) == r.shard and 0 <= r.shard < 40
        loads[r.shard] += len(r.text.encode()) + 16
    groups = Counter()
    for r in got:
        groups[r.text] += len(r.text.encode()) + 16
    assert max(loads.values()) <= sum(loads.values()) / 40 + max(groups.values())
