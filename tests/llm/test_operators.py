"""Operators of the training-data subpackage on small tables: brute force, odd rows, extra columns."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopbank.llm import (
    decontamination, language_id, license_scan, lm_scoring, mixing, near_dedup, quality, sharding, substring_dedup, token_counts,
)
from shopbank.llm.components import connected

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, hash string, node string"
WORDS = [f"{a}{b}" for a in ("ba", "co", "di", "fu", "ge", "ho") for b in ("lan", "mer", "nit", "por", "ras", "sul", "tev")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", str(rng.randrange(40))]) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, a shared passage, repeated rows, null and empty texts, null ids, a long text."""
    rng = random.Random(5)
    base, passage = [sentence(rng, 80) for _ in range(12)], sentence(rng, 60)
    out = [(i, t) for i, t in enumerate(base)]
    for k in range(40):
        words = base[k % 4].split()
        for _ in range(k % 5):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        out.append((100 + k, " ".join(words)))
    out += [(200 + k, sentence(rng, 30) + "\n" + passage) for k in range(8)]
    out += [(300, None), (301, ""), (302, " \n\t "), (303, "short text"), (304, "Short Text"), (None, base[0]), (None, None)]
    out += [(3, base[3])] * 3 + [(400, "a " * 50), (401, sentence(rng, 6000))]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", [None, "x", "y", "z"][k % 4], len(t or ""), "s", "h", "n") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().split()


def same_rows(a, b):
    assert Counter(map(repr, a)) == Counter(map(repr, b))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    got = {tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 1) for i in range(2, 41)} | {(i, 100) for i in range(101, 150)}


def shingle_set(text):
    words = tuple((text or "").encode().lower().split())
    return {words[i : i + 5] for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts):
    sets, root = [shingle_set(t) for _, t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(texts):
        groups.setdefault(find(i), []).append(doc_id)
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(texts)]


def test_near_duplicates(docs, texts, empty, monkeypatch):
    same_rows(map(tuple, near_dedup.near_duplicates(docs).collect()), brute_components(texts))
    assert near_dedup.near_duplicates(empty).count() == 0
    monkeypatch.setattr(near_dedup, "SMALL_KEY", 2)  # the way of hot keys
    monkeypatch.setattr(near_dedup, "RARE", 3)
    monkeypatch.setattr(near_dedup, "KEY_BLOCK", 4)
    same_rows(map(tuple, near_dedup.near_duplicates(docs).collect()), brute_components(texts))


def test_deduplicated_keeps_one_row_of_each_group(docs, texts):
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    want = {(d, t) for (d, t), x in zip(texts, brute_components(texts), strict=True) if x[3] and t and t.split()}
    assert {k for k in got if k[1] and k[1].split()} == want
    assert all(n == 1 for (_, t), n in got.items() if t and t.split())
    assert sum(n for (_, t), n in got.items() if not (t and t.split())) == 4


def test_signature_guarantee():
    """Any two signatures that differ in at most 39 codes share a key."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 256, near_dedup.CODES, dtype=np.uint8)
        b = a.copy()
        at = rng.choice(near_dedup.CODES, 2 * near_dedup.CHUNKS - 1, replace=False)
        b[at] += rng.integers(1, 256, len(at), dtype=np.uint8)
        x, y = near_dedup.index_keys(a.tobytes()), near_dedup.index_keys(b.tobytes())
        assert np.intersect1d(x, y).size


def test_language_id(spark, empty):
    train = [(i, t, lang) for i in range(30) for lang, t in (("en", "the house and the garden of this town"), ("de", "das haus und der garten dieser stadt"))]
    labelled = spark.createDataFrame([(i, t, lang, "", 0, "", "", "") for i, t, lang in train], SCHEMA)
    page = '<html lang="{}"><head><title>x</title></head><body><script>das und der</script><p>{}</p></body></html>'
    rows = [(i, f"https://www.a.de/{i}", page.format("de", "der garten und das haus in der stadt"), "x") for i in range(10)]
    rows += [(20 + i, f"https://b.com/{i}", page.format("en", "this town and the house"), "x") for i in range(10)]
    rows += [(40, "https://a.de/x", page.format("de", ""), "x"), (41, None, None, None), (None, "", "", "x"), (42, "https://a.de/y", page.format("en", "der garten"), "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in language_id.identified(pages, labelled).collect()}
    assert len(got) == 24 and all(got[i].language == "de" for i in range(10)) and all(got[20 + i].language == "en" for i in range(10))
    assert got[40].language == "de" and got[40].text_language is None  # declared and host alone
    assert got[42].language == "de" and got[42].host == "a.de" and got[41].host == ""
    assert all(0 < r.confidence <= 1 for r in got.values())
    assert language_id.identified(pages, empty).where("language is null").count() == 24
    assert language_id.identified(pages.limit(0), labelled).count() == 0


def brute_capacity(sizes, shards):
    def fits(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > capacity:
                return False
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used <= shards

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 7, 40])
def test_sharding(docs, texts, empty, shards):
    got = sharding.sharded(docs, shards).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts
    )
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) <= set(range(shards))
    assert all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by_shard.values())
    placed = sharding.sharded_documents(docs, shards).select("text", F.expr("shard")).distinct().collect()
    assert len(placed) == len({t for _, t in texts})  # equal texts stay together
    rows, plan = sharding.shard_plan(docs, shards)
    groups = rows.groupBy("key").agg(F.sum("size").alias("size")).collect()
    light = sorted((g.key % (1 << 64), g["size"]) for g in groups if g.key not in plan.heavy)
    if light:
        want = brute_capacity([s for _, s in light], shards - len(plan.heavy))
        assert plan.capacity == max([want, *(g["size"] for g in groups if g.key in plan.heavy)])
        sums = Counter()
        for r in got:
            sums[r.shard] += r["size"]
        assert max(sums.values()) == plan.capacity or len(light) < shards
    assert sharding.sharded(empty, shards).count() == 0


@pytest.mark.parametrize("run", [1, 7, 4096])
def test_sharding_numbers_repeated_rows(spark, monkeypatch, run):
    monkeypatch.setattr(sharding, "RUN", run)
    monkeypatch.setattr(sharding, "CELL_ROWS", 10)
    counted = {(7, "same"): 50, (None, None): 30, (7, None): 8, (None, "same"): 1, (1, "one"): 2, (2, "two"): 1}
    docs = spark.createDataFrame([k for k, n in counted.items() for _ in range(n)], "doc_id long, text string")
    got = sharding.sharded(docs, 3).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter(
        {(d, zlib.crc32((t or "").encode())): n for (d, t), n in counted.items()}
    )
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_license_scan(spark, docs, empty):
    mit = license_scan.TEMPLATES["MIT"][1]
    words = mit.split()
    edited = " ".join(words[:20] + ["really"] + words[20:30] + words[31:])
    cut = " ".join(words[: len(words) // 3])
    rows = [(1, f"intro words here\n{edited}\nmore"), (2, cut), (3, "released under THE mit license"), (4, None), (5, "free software"), (6, f"{mit} x {mit}")]
    got = license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_doc = Counter(r.doc_id for r in got)
    assert by_doc == {1: 1, 3: 1, 6: 2} and {r.license for r in got} == {"MIT"}
    first = next(r for r in got if r.doc_id == 1)
    assert first.coverage > 0.95 and rows[0][1].encode()[first.start_byte : first.end_byte].startswith(b"Permission is hereby")
    assert license_scan.scanned(docs).count() == 0 and license_scan.scanned(empty).count() == 0


def test_lm_scoring(spark, docs, texts, empty):
    good = spark.createDataFrame([(i,) for i in range(6)] + [(None,), (0,)], "doc_id long")
    got = lm_scoring.cross_entropy_difference(docs, good).collect()
    symbols = [0] * 256
    from shopbank.llm.symbols import grams

    symbols = [int(grams(bytes([b]), 1)[0]) for b in range(256)]
    counts = [Counter(), Counter()]
    for d, t in texts:
        s = [symbols[10]] * 3 + [symbols[b] for b in (t or "").encode()]
        for i in range(3, len(s)):
            for n in range(1, 5):
                counts[1][tuple(s[i - n + 1 : i + 1])] += 1
                counts[0][tuple(s[i - n + 1 : i + 1])] += d is not None and d < 6

    def p(model, gram):
        shorter, mean = 1 / 64, (1 - sum(lm_scoring.WEIGHTS)) / 64
        for n, weight in zip(range(1, 5), reversed(lm_scoring.WEIGHTS), strict=True):
            before = totals[model][gram[-n:-1]]
            shorter = counts[model][gram[-n:]] / before if before else shorter
            mean += weight * shorter
        return mean

    totals = [Counter(), Counter()]
    for model in (0, 1):
        for gram, n in counts[model].items():
            totals[model][gram[:-1]] += n
    by_text = {t: r.score for (d, t) in texts for r in got if r.doc_id == d and d is not None and d >= 100}
    for text in [t for d, t in texts if d in (100, 200, 303)]:
        s = [symbols[10]] * 3 + [symbols[b] for b in text.encode()]
        each = [np.log(p(1, tuple(s[i - 3 : i + 1]))) - np.log(p(0, tuple(s[i - 3 : i + 1]))) for i in range(3, len(s))]
        assert by_text[text] == pytest.approx(np.mean(each), abs=1e-5)
    assert all((r.score is None) == (r.n_tokens == 0) for r in got) and len(got) == len(texts)
    assert lm_scoring.cross_entropy_difference(empty, good).count() == 0


def test_token_counts(docs, texts, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = token_counts.token_counts(docs, path, 60).collect()
    want = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in texts]
    same_rows([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], want)
    assert token_counts.token_counts(empty, path, 60).count() == 0 and token_counts.token_prefixes(empty, path).count() == 0


def test_every_prefix():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        counter = token_counts.PrefixCounter(json.load(file))
    for text in (
        "", "it's they're we'll I've o'clock", "a<|endoftext|>b <|startoftext|>!!", "!!<|endoftext|> x", "你好世界 123 4567", "$$$%%% |a|b|",
        "naïve—“quoted”…", "x" * 60, " \x1c\x1fq \n", "antidisestablishmentarianism unbelievable", "🎉🎉 emoji",
        "  two  spaces \n\tand lines\nof words ", "<|endoftext|>", "a <|endoftext|> b", "run" * 40 + "\n" + "on" * 40 + " end",
    ):
        got = counter.prefixes(text)
        assert got.tolist() == [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.total(text) == got[-1]
        ends, tokens = counter.run_ends(text)
        assert ends[-1] == len(text) and tokens.tolist() == got[ends].tolist()
        for budget in (0, 1, 4, 9):
            assert counter.fitting(text, *counter.run_ends(text), budget) == max(i for i, n in enumerate(got) if n <= budget)


def test_mixing(docs, texts, empty):
    got = mixing.mixed(docs).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, len(words_of(t))) for d, t in texts)
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        taken[r.source] += r.n_copies * r["size"]
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.n_copies <= 3 and r.target <= 3 * r.source_size
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in got))
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    same_rows(map(tuple, got), map(tuple, mixing.mixed(docs.repartition(5)).collect()))
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    assert Counter(r.doc_id for r in copies.collect()) == +Counter({d: n for d, n in sum_copies(got).items()})
    assert mixing.mixed(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def sum_copies(rows):
    out = Counter()
    for r in rows:
        out[r.doc_id] += r.n_copies
    return out


def test_mixing_counts_off_rows_of_one_hash(spark):
    rows = [(7, "one two three four", "a")] * 10 + [(8, "five six", "b")]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 5), most_repeats=3)
    taken = {r.source: (r.taken, r.target) for r in got.groupBy("source").agg(F.sum(F.col("n_copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect()}
    assert taken["b"] == (6, 6.0) and abs(taken["a"][0] - taken["a"][1]) <= 4


def test_line_quality(docs, texts, empty):
    nav = "Home | News | Sport | Shop |\nClick here\nRead more now\n" * 3
    assert not quality.judged(nav, quality.Names())[0]["kept"]
    good, lines = quality.judged("A first line of some words ends here.\nAll rights reserved.\nAnother line of words ends here too.\nA first line of some words ends here.", quality.Names())
    assert good["n_dup_lines"] == 1 and len(lines) == 2
    cleaned = quality.cleaned(docs)
    kept = {(r.doc_id, len(r.text)) for r in cleaned.collect()}
    verdicts = quality.line_quality(docs).collect()
    assert cleaned.columns == docs.columns and len(verdicts) == len(texts)
    assert cleaned.count() == sum(r.kept for r in verdicts) and all(n > 0 for _, n in kept)
    assert quality.line_quality(empty).count() == 0 and quality.cleaned(empty).count() == 0


def brute_repeats(texts):
    seen = Counter()
    for _, t in texts:
        w = words_of(t)
        seen.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    out = []
    for d, t in texts:
        w = words_of(t)
        gone = {i + k for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for k in range(35)}
        left = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(left)).hexdigest()))
    return out


def test_substring_dedup(docs, texts, empty):
    got = substring_dedup.without_repeats(docs).collect()
    digest = [(r.doc_id, r.n_words, sum(b - a for a, b in r.spans), hashlib.sha256(r.text.encode()).hexdigest()) for r in got]
    same_rows(digest, brute_repeats(texts))
    assert substring_dedup.without_repeats(empty).count() == 0


def test_substring_dedup_finds_periodic_and_shifted_repeats(spark):
    rng = random.Random(2)
    for seed in range(3):
        core = [rng.choice("ab") for _ in range(200)] + ["c"] * 80 + [rng.choice(WORDS) for _ in range(60)]
        texts = []
        for i in range(30):
            a = rng.randrange(len(core) - 40)
            texts.append((i, " ".join([rng.choice(WORDS) for _ in range(rng.randrange(30))] + core[a : a + rng.randrange(30, 60)] + ["x"] * rng.randrange(4))))
        got = substring_dedup.without_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()
        digest = [(r.doc_id, r.n_words, sum(b - a for a, b in r.spans), hashlib.sha256(r.text.encode()).hexdigest()) for r in got]
        same_rows(digest, brute_repeats(texts))


def test_decontamination(spark, docs, texts, empty):
    rng = random.Random(9)
    passage = next(t for d, t in texts if d == 200).split("\n")[1].split()
    items = [(1, " ".join(passage[10:40])), (2, "short Text"), (2, "gelan"), (None, texts[2][1]), (5, None), (6, "!!"), (7, "a a a a a a a a a a a a a a")]
    items += [(10 + k, sentence(rng, 20)) for k in range(20)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    phrases = {}
    for item, t in items:
        w = tuple(decontamination.item_words((t or "").encode()))
        for i in range(max(1, len(w) - 12) if w else 0):
            phrases.setdefault(w[i : i + 13], set()).add("" if item is None else str(item))
    want = []
    for d, t in texts:
        w, hit, found = decontamination.item_words((t or "").encode()), set(), set()
        for phrase, names in phrases.items():
            for i in range(len(w) - len(phrase) + 1):
                if tuple(w[i : i + len(phrase)]) == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    found |= names
        want.append((d, len(w), len(hit), len(hit) > 0 and 20 * len(hit) >= len(w), sorted(found)))
    got = decontamination.benchmark_hits(docs, benchmark).collect()
    same_rows([(r.doc_id, r.n_words, r.n_hit, r.contaminated, r["items"]) for r in got], want)
    assert all(r.n_hit == sum(b - a for a, b in r.spans) for r in got)
    clean = decontamination.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == sum(not x[3] for x in want)
    nothing = benchmark.limit(0)
    assert decontamination.benchmark_hits(docs, nothing).agg(F.sum("n_hit")).first()[0] == 0
    assert decontamination.benchmark_hits(empty, benchmark).count() == 0


def test_decontamination_in_pieces(docs, spark, monkeypatch):
    items = [(k, sentence(random.Random(k), 20)) for k in range(30)] + [(99, docs.where("doc_id = 5").first().text)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontamination.benchmark_hits(docs, benchmark).collect()
    monkeypatch.setattr(decontamination, "PIECE_BYTES", 300)
    files = decontamination.stored_phrases(benchmark)
    assert len(files) > 5 and len(list(decontamination.Pieces(files))) == len(files)
    same_rows(map(tuple, decontamination.benchmark_hits(docs, benchmark).collect()), map(tuple, whole))


def test_benchmark_of_one_piece_over_many_partitions(docs, spark):
    """A benchmark whose one piece falls into one of many shuffle partitions; the others write no phrases."""
    benchmark = spark.createDataFrame([(k, docs.where("doc_id = 5").first().text) for k in range(3)], "item_id long, text string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        files = decontamination.stored_phrases(benchmark)
        assert len(files) == 1 and [p.items for p in decontamination.Pieces(files)][0][0] == ["0", "1", "2"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_long_items_keep_all_windows(spark, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    items = spark.createDataFrame([(n, " ".join(words[:n])) for n in (0, 1, 12, 13, 14, 19, 20, 21, 200)], "item_id long, text string")
    want = {(str(n), tuple(words[i : i + 13])) for n in (1, 12, 13, 14, 19, 20, 21, 200) for i in range(max(1, n - 12)) if i + 13 <= n or i == 0}
    want = {(item, window[: int(item)]) for item, window in want}
    monkeypatch.setattr(decontamination, "PART_WINDOWS", 7)
    got = set()
    for r in decontamination.item_parts(items).collect():
        part = bytes(r["words"]).decode().split(" ")
        got |= {(r["item"], tuple(part[i : i + 13])) for i in range(max(1, len(part) - 12))}
    assert got == want


def test_spectra_bound_what_sets_share():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 400_000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, n)) for n in (1, 40, 5_000, 300_000)]
    sizes = np.array([len(x) for x in sets])
    packed = near_dedup.spectra(np.concatenate(sets), sizes)
    assert [len(x) for x in packed] == [near_dedup.PARTS] * 3 + [4 * near_dedup.PARTS]
    rows = near_dedup.spectrum_rows(packed)
    assert rows.sum(axis=1).tolist() == sizes.tolist()
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert np.minimum(rows[i], rows[j]).sum() >= len(np.intersect1d(x, y))
