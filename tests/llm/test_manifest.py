"""The Merkle manifest against a brute-force version, and its bitmaps."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from shopbank.llm.manifest import BUCKET, COLUMNS, Ids, forest, id_bitmaps, leaf_rows, manifest, placed, proofs, source_paths

DDL = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def lowered(text):
    return text and text.translate({c: c + 32 for c in range(65, 91)})


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, place):
    for level in tree[:-1]:
        begin = place // 16 * 16
        yield level[begin:place], level[place + 1 : begin + 16]
        place //= 16


def brute(docs):
    by_source = defaultdict(list)
    for row in docs:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    root, out = top[-1][0] if docs else None, Counter()
    for at, s in enumerate(sources):
        for place, (_, _, own, row) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            steps = [*path(trees[s], place), *path(top, at)]
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf((*row[:4], lowered(row[4]))) if bad else own
            for left, right in steps:
                node = digest(*left, node, *right)
            proof = digest(*(x for left, right in steps for x in left + right))
            out[(row[0], own, trees[s][-1][0], root, proof, node, node == root, s, place)] += 1
    return out


def got(spark, docs):
    frame = docs if not isinstance(docs, list) else spark.createDataFrame(docs, DDL)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return Counter(tuple(r) for r in manifest(frame, tampered).collect())


def text(i):
    return random.Random(i).choice(["Some Words", "no capitals here", "ÄÖ only beyond ASCII", "", "A"]) + str(i % 7)


def test_equals_brute_force_with_ties_nulls_and_repeats(spark):
    docs = [(i * 37 - 3000, f"s{i % 3}", "en", len(text(i)), text(i)) for i in range(400)]
    docs += [(7, "s0", "en", i, f"Tied {i}") for i in range(60)] + [(8, "s1", None, None, "Repeated")] * 50
    docs += [(None, "s2", "de", i % 4, "Without an id") for i in range(40)] + [(None, None, None, None, None)] * 3
    docs += [(2**62 + i, None, "fr", 1, text(i)) for i in range(20)] + [(-(2**63), "s2", "x", 0, None), (2**63 - 1, "s2", "x", 0, "LAST")]
    assert got(spark, docs) == brute(docs)


def test_blocks_of_several_layers(spark):
    docs = [(i, "hot" if i % 10 else f"s{i % 300}", "en", i, text(i)) for i in range(9000)]
    random.Random(1).shuffle(docs)
    assert got(spark, docs) == brute(docs)


def test_single_rows_and_empty_table(spark):
    assert got(spark, []) == Counter()
    for docs in ([(5, "a", "en", 3, "One")], [(5, "a", "en", 3, "One"), (5, "b", "en", 3, "Two")], [(1, None, None, None, None)]):
        assert got(spark, docs) == brute(docs)


def test_many_sources(spark):
    docs = [(i, f"host{i}é" if i % 2 else f"Host{i}", "en", 1, text(i)) for i in range(700)]
    assert got(spark, docs) == brute(docs)


def test_very_long_text_and_clashing_columns(spark):
    docs = [(i, "a", "en", 9, "Long words " * 200_000 if i == 3 else "short") for i in range(20)]
    plain = spark.createDataFrame(docs, DDL)
    odd = plain.selectExpr("*", "lang as tree", "lang as leaf", "n_chars as p", "n_chars as n", "doc_id as `a.b`", "lang as bucket", "lang as slots")
    assert got(spark, odd) == brute(docs)


def test_bitmaps_keep_counts():
    rng = np.random.default_rng(0)
    for some in (0, 1, 5, 255, 256, 3000):
        counts = np.zeros(BUCKET, np.int64)
        np.add.at(counts, rng.integers(0, BUCKET, some), 1)
        ids = Ids.counted(counts)
        assert (ids.counts() == counts).all() and len(ids.bits) <= BUCKET // 8


def test_bitmaps_of_tasks_are_merged(spark):
    docs = spark.createDataFrame([(i % 5000, "a", None, None, None) for i in range(7000)], DDL).repartition(7)
    rows = {r["bucket"]: r for r in id_bitmaps(leaf_rows(docs, None)).collect()}
    assert {b: r["n"] for b, r in rows.items()} == {0: 4096 + 2000, 1: 904}
    assert Ids(bytes(rows[0]["bits"]), bytes(rows[0]["ties"])).counts().tolist() == [2] * 2000 + [1] * 2096


def test_untampered_rows_are_folded_too(spark):
    """Against a root that is not theirs no row is verified, and each folds to the root of the rows given."""
    docs = [(i, "a", "en", 1, "no capitals") for i in range(40)]
    nodes = placed(leaf_rows(spark.createDataFrame(docs, DDL), None)).withColumnsRenamed({"source": "tree", "leaf": "digest"})
    layers, roots = forest(nodes, "doc_id", "changed")
    other = source_paths(roots).withColumn("top", F.lit(digest("another root")))
    got = proofs(layers[0].withColumn("subroot", F.lit(None).cast("string")), other).collect()
    root = next(iter(brute(docs)))[3]
    assert [(r["folded_root"], r["verified"]) for r in got] == [(root, False)] * 40


def test_columns():
    assert COLUMNS == ("doc_id", "source", "lang", "n_chars", "text")
