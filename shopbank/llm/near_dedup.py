"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A document's set is its distinct 5-word shingles (lower-cased A-Z; words are runs without ASCII white space); with fewer words, the
whole sequence as one. Documents of equal sets are one class. A class has a signature of 140 MinHash codes of 8 bits. The codes are
split into 20 chunks of 7. By the pigeonhole principle, signatures that differ in at most 39 codes agree in some chunk up to one
code. So each chunk is entered under its 7 ways to leave one code out: all pairs within that distance meet under some key. Two sets of similarity 0.75
differ in 35 codes on average; about 7 in a million such pairs share no key.

How the pairs are handled, so that a group of any size stays cheap:

- Keys are exchanged in packed blocks (``exchange``); only keys that two classes share become rows (key, class).
- Stars: under each key all classes meet one pivot only, the most central class. Each class tests the pivot it shares most keys
  with, on full sets. Linked classes become one component; keys within one component are done.
- Of the classes left under keys with several components, the shingles are counted that another such class has. Common shingles
  are among these, which bounds the similarity of a pair from above and rules out, without testing them, classes that only
  share a passage and copies edited too much (``last_pairs``). While keys of many classes stay, further stars take other pivots.
- All pairs left that share a key, lie in different components and pass the bound are tested, those of hopelessly distant
  signatures aside. A link within a component can't change it.

The exact test on full sets decides every link used. Lost are links of pairs that share no key, or whose signatures differ beyond ``FAR``.

Defined results: a document without words (null or empty text) has an empty set, is its own component and kept. Null ids are allowed; a
component's id is its smallest id that is not null. Repeated rows are a class. An empty table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopbank.llm.components import connected
from shopbank.llm.exchange import answer, ask, attach, parts_of, replies_in_order, seen_twice, times_seen
from shopbank.llm.scratch import stored
from shopbank.llm.words import U64, Names, factor, mixed, released, texts_of, window_names

SHINGLE = 5
CHUNKS, CHUNK = 20, 7
CODES = CHUNKS * CHUNK
#: Signatures at similarity 0.75 differ in 35 codes, with a deviation of 5.1.
FAR = 70
PERCENT = 75
BLOCK_CLASSES = 4096
#: Words whose names a task keeps.
NAMES = 1 << 16
#: Most bytes of sets that one block of ``shingle_counts`` has, besides its last set.
BLOCK_SETS = 8 << 20
STAR_ROUNDS, SMALL_KEY = 6, 32
#: Classes with this share of shared shingles (in percent) take part in further stars; all others wait for the last step.
HOPEFUL = 85
#: A further star is made only if this part of the last one's tests were links.
WORTH = 0.1
#: Classes of one key that are compared at a time.
KEY_BLOCK = 2048
#: A shingle of more classes than this is a frequent one.
RARE = 16
#: Parts of the space of shingles; a set's numbers in each part bound from above what it can have in common with another set.
PARTS = 256

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_A = np.array([int(factor(1000 + i)) & 0xFFFFFFFF | 1 for i in range(CODES)], np.uint32)
_B = np.array([int(factor(5000 + i)) >> 32 for i in range(CODES)], np.uint32)


def shingles(text: bytes, names: Names) -> np.ndarray:
    """Sorted 64-bit names of the set of a text."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, U64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], U64)
    return np.unique(window_names(names.of(words), SHINGLE))


def signature(found: np.ndarray) -> np.ndarray:
    """8-bit codes of the least values of the set under each of the hash functions."""
    low, least = (found >> U64(32)).astype(np.uint32), np.full(CODES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 4096):
        least = np.minimum(least, (low[i : i + 4096, None] * _A + _B).min(axis=0))
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set", pa.binary()), ("signature", pa.binary())]
)


def sketches(docs: DataFrame) -> DataFrame:
    """One row for each document; ``set`` is a 128-bit digest, null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(NAMES)
        for batch in batches:
            sizes, sets, signatures = [], [], []
            for text in texts_of(batch.column(2)):
                found = shingles(text, names)
                sizes.append(len(found))
                sets.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(signatures, pa.binary())],
                schema=SKETCH,
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text")
    return rows.mapInArrow(released(run), "doc_id long, text_key long, n_shingles long, set binary, signature binary")


def class_blocks(classes: DataFrame, n: int) -> DataFrame:
    """Rows (block, nodes, signatures) of packed classes, ``n`` in all; small partitions share a block."""
    schema = pa.schema([("block", pa.int64()), ("nodes", pa.binary()), ("signatures", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_CLASSES):
                part = batch.slice(at, BLOCK_CLASSES)
                nodes = part.column(0).to_numpy(zero_copy_only=False)
                row = {"block": int(nodes[0]), "nodes": nodes.tobytes(), "signatures": b"".join(part.column(1).to_pylist())}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    packed = classes.select("node", "signature").coalesce(-(-n // BLOCK_CLASSES) or 1)
    return packed.mapInArrow(released(run), "block long, nodes binary, signatures binary")


def index_keys(signatures: bytes) -> np.ndarray:
    """Keys of each signature, a row each: every chunk with one of its codes left out."""
    codes = np.frombuffer(signatures, np.uint8).reshape(-1, CHUNKS, CHUNK).astype(U64) + U64(1)
    weighted = codes * np.array([factor(i) for i in range(CHUNK)], U64)
    whole = weighted.sum(axis=2, dtype=U64)
    seeds = np.array([factor(100 + i) for i in range(CODES)], U64).reshape(CHUNKS, CHUNK)
    return mixed(whole[:, :, None] - weighted + seeds).reshape(-1, CODES)


def shared_keys(classes: DataFrame) -> DataFrame:
    """Rows (key, node) of the keys that two classes or more have."""
    n = classes.count()
    blocks = stored(class_blocks(classes, n), "class-blocks")
    parts = parts_of(8 * CODES * n)

    def keys_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(index_keys(row["signatures"]), return_counts=True)
        return keys, counts > 1

    replies = answer(ask(blocks, keys_of, parts), seen_twice)
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own = index_keys(row["signatures"])
                keys, inverse = np.unique(own, return_inverse=True)
                shared = replies_in_order(row, keys, parts, bool)[inverse.reshape(own.shape)]
                nodes = np.broadcast_to(np.frombuffer(row["nodes"], np.int64)[:, None], own.shape)
                yield pa.RecordBatch.from_arrays([pa.array(own[shared].view(np.int64)), pa.array(nodes[shared])], schema=schema)

    return stored(attach(blocks, replies).mapInArrow(released(members), "key long, node long"), "shared-keys")


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the column ``linked``: whether the full sets of the two classes are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(NAMES)
        found = lru_cache(64)(lambda text: shingles(text, names))
        for batch in batches:
            linked = []
            for x, y in zip(texts_of(batch.column(2)), texts_of(batch.column(3)), strict=True):
                a, b = found(x), found(y)
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return stored(rows.mapInArrow(released(run), "a long, b long, linked boolean"), "tested-pairs")


def not_far(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures differ in at most ``FAR`` codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, CODES) for i in (2, 3))
            near = pa.array((x != y).sum(axis=1) <= FAR)
            yield batch.select([0, 1]).filter(near)

    first = classes.select(F.col("node").alias("a"), F.col("signature").alias("signature_a"))
    second = classes.select(F.col("node").alias("b"), F.col("signature").alias("signature_b"))
    rows = pairs.join(first, "a").join(second, "b").select("a", "b", "signature_a", "signature_b")
    return rows.mapInArrow(run, "a long, b long")


SETS = pa.schema([("block", pa.int64()), ("nodes", pa.binary()), ("sizes", pa.binary()), ("sets", pa.binary())])
COUNTED = pa.schema([*[(c, pa.int64()) for c in ("node", "size", "shared", "frequent", "shingle")], ("spectrum", pa.binary())])


def spectra(sets: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each of the sets in a row, how many of its shingles fall into each part: bytes, or 32-bit numbers if one is larger."""
    place = np.repeat(np.arange(len(sizes)), sizes) * PARTS + (mixed(sets) >> U64(56)).astype(np.int64)
    counts = np.bincount(place, minlength=len(sizes) * PARTS).reshape(-1, PARTS)
    return [x.astype(np.uint8 if x.max() < 256 else np.uint32).tobytes() for x in counts]


def spectrum_rows(packed: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.uint8 if len(x) == PARTS else np.uint32).astype(np.uint32) for x in packed])


def shingle_counts(texts: DataFrame, with_rare: bool = False) -> DataFrame:
    """Rows (node, size, shared, frequent, shingle, spectrum): shingles of each class, those of them that another of these classes has, and
    those that more than ``RARE`` of them have. With ``with_rare``, also its spectrum, and a row with null counts for each other shared
    shingle of a class."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(NAMES)
        for batch in batches:
            nodes, held, size, begin = batch.column(0).to_numpy(zero_copy_only=False), [], 0, 0
            for at, text in enumerate(texts_of(batch.column(1)), 1):
                held.append(shingles(text, names))
                size += held[-1].nbytes
                if at == len(nodes) or len(held) == 1024 or size >= BLOCK_SETS:
                    sizes = np.array([len(x) for x in held], np.int64)
                    row = {"block": int(nodes[begin]), "nodes": nodes[begin:at].tobytes(), "sizes": sizes.tobytes()}
                    yield pa.RecordBatch.from_pylist([row | {"sets": np.concatenate(held).tobytes()}], schema=SETS)
                    held, size, begin = [], 0, at

    texts = stored(texts, "bounded-texts")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Words have about six bytes and are the starts of shingles of eight; several blocks of sets for each task.
    packed = texts.coalesce(-(-size // BLOCK_SETS) or 1)
    blocks = stored(packed.mapInArrow(released(pack), "block long, nodes binary, sizes binary, sets binary"), "class-sets")
    parts = parts_of(blocks.agg(F.sum(F.octet_length("sets"))).first()[0] or 0, 4 << 20)

    def keys_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(np.frombuffer(row["sets"], U64), return_counts=True)
        return keys, counts.astype(np.uint32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own = np.frombuffer(row["sets"], U64)
                keys, inverse = np.unique(own, return_inverse=True)
                times = replies_in_order(row, keys, parts, np.uint8)[inverse]
                nodes, sizes = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["sizes"], np.int64)
                begins = np.cumsum(sizes) - sizes
                sums = [np.add.reduceat(mask, begins, dtype=np.int64) for mask in (times > 1, times > RARE)]
                none = pa.nulls(len(nodes), pa.int64())
                parted = pa.array(spectra(own, sizes), pa.binary()) if with_rare else pa.nulls(len(nodes), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(sizes), *map(pa.array, sums), none, parted], schema=COUNTED)
                if with_rare:
                    rare = (times > 1) & (times <= RARE)
                    none = pa.nulls(int(rare.sum()), pa.int64())
                    rows = [pa.array(np.repeat(nodes, sizes)[rare]), none, none, none, pa.array(own[rare].view(np.int64))]
                    rows.append(pa.nulls(len(none), pa.binary()))
                    yield pa.RecordBatch.from_arrays(rows, schema=COUNTED)

    counted = attach(blocks, answer(ask(blocks, keys_of, parts), times_seen))
    return counted.mapInArrow(released(count), "node long, size long, shared long, frequent long, shingle long, spectrum binary")


def bounded_pairs(left: DataFrame, right: DataFrame, on: str, most_common) -> DataFrame:
    """Pairs a > b of rows (``on``, node, root, size, ...) in different components that can be similar enough with so many common shingles."""
    x, y = left.alias("x"), right.alias("y")
    common = most_common("x", "y")
    possible = 100 * common >= PERCENT * (F.col("x.size") + F.col("y.size") - common)
    apart = (F.col(f"x.{on}") == F.col(f"y.{on}")) & (F.col("x.node") > F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    return x.join(y, apart & possible)


def pairs_of_large_keys(members: DataFrame) -> DataFrame:
    """Pairs (a, b) within a key in different components that their frequent shingles and spectra allow, each pair under one key only.

    That is the first key, in chunk order, that the two signatures share. Members of a key are compared in pairs of blocks of about
    ``KEY_BLOCK`` classes, so a task holds two blocks; only pairs that pass leave it.
    """
    blocks = F.ceil(F.col("n") / KEY_BLOCK).cast("int")
    rows = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("blocks", "other", "n")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        codes = np.frombuffer(b"".join(group["signature"]), np.uint8).reshape(-1, CODES)
        place = int(np.flatnonzero(index_keys(group["signature"].iloc[0])[0] == U64(int(group["key"].iloc[0]) % (1 << 64)))[0])
        chunk, left_out = divmod(place, CHUNK)
        node, root, size, frequent, own = (group[c].to_numpy(np.int64) for c in ("node", "root", "size", "frequent", "own"))
        parted = spectrum_rows(list(group["spectrum"]))
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        out = []
        for at in range(0, len(left), 256):
            i = left[at : at + 256, None]
            common = np.minimum(frequent[i], frequent[right])
            possible = (100 * common >= PERCENT * (size[i] + size[right] - common)) & (root[i] != root[right])
            if low == high:
                possible &= node[i] > node[right]
            x, y = np.nonzero(possible)
            x, y = left[at + x], right[y]
            for k in range(0, len(x), 8192):
                a, b = x[k : k + 8192], y[k : k + 8192]
                differ = (codes[a] != codes[b]).reshape(-1, CHUNKS, CHUNK)
                shared = differ.sum(axis=2) <= 1
                first = shared.argmax(axis=1) == chunk
                first &= differ[:, chunk].argmax(axis=1) == left_out
                a, b = a[first], b[first]
                common = np.minimum(parted[a], parted[b]).sum(axis=1, dtype=np.int64)
                able = 100 * common >= PERCENT * (size[a] + size[b] - common)
                out.append(np.stack((np.maximum(node[a], node[b])[able], np.minimum(node[a], node[b])[able]), axis=1))
        return pd.DataFrame(np.concatenate(out) if out else np.zeros((0, 2), np.int64), columns=["a", "b"])

    return rows.groupBy("key", "low", "high").applyInPandas(run, "a long, b long")


def last_pairs(members: DataFrame, texts: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs (a, b) that share a key, lie in different components and may be linked; a superset of the links there are.

    Common shingles of two classes are at most the lesser of their shared counts. Under keys of many classes that is not sharp enough: edited
    copies of one text all share its shingles and, here and there, an edit. There the shingles are told apart by how many classes have
    them: a pair has at most the lesser of its frequent counts in common, and the rare ones that both have, found by a join on these.
    Pairs without rare ones are also held against their spectra: no two sets share more than the lesser number in each part.
    """
    columns = ["node", "root", "size", "shared"]
    small = members.where(F.col("n") <= SMALL_KEY).select("key", *columns)
    pairs = bounded_pairs(small, small, "key", lambda x, y: F.least(f"{x}.shared", f"{y}.shared")).select("x.node", "y.node").toDF("a", "b")
    large = members.where(F.col("n") > SMALL_KEY).select("key", "node", "root", "n")
    if large.isEmpty():
        return pairs.distinct()
    nodes = large.select("node", "root").distinct()
    counted = stored(shingle_counts(texts.join(nodes, "node", "left_semi"), with_rare=True), "shingle-counts")
    sizes = nodes.join(counted.where("size is not null").select("node", "size", "frequent", "spectrum"), "node")
    frequent = pairs_of_large_keys(large.join(sizes.drop("root"), "node").join(signatures, "node"))
    rare = counted.where("shingle is not null").select("shingle", "node").join(sizes.drop("spectrum"), "node")
    met = bounded_pairs(rare, rare, "shingle", lambda x, y: F.least(f"{x}.size", f"{y}.size"))
    met = met.groupBy("x.node", "y.node", "x.size", "y.size", "x.frequent", "y.frequent").agg(F.count("*").alias("c"))
    met = met.toDF("a", "b", "m", "n", "f", "g", "c").withColumn("common", F.least("f", "g") + F.col("c"))
    met = met.where(100 * F.col("common") >= PERCENT * (F.col("m") + F.col("n") - F.col("common"))).select("a", "b")
    return pairs.unionByName(frequent).unionByName(met).distinct()


def live_members(members: DataFrame, star: DataFrame, turn: int) -> DataFrame:
    """``members`` of the keys whose classes lie in several components, with the columns root, pivot, pivot_root, n.

    The pivot of a key is its most central class, the one that meets most classes under all its keys: of a text and its many
    edited copies that is the text itself. Ties go by numbers in which some bits are turned, other ones each round.
    """
    own = [c for c in members.columns if c not in ("root", "pivot", "pivot_root", "n")]
    roots = star.select(F.col("a").alias("node"), F.col("b").alias("root"))
    rooted = members.select(own).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    keys = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    live = stored(rooted.join(keys.where("low < high").select("key", "n"), "key"), "live-members")
    weights = live.groupBy("node").agg(F.sum("n").alias("weight"))
    turned = F.col("node").bitwiseXOR(F.lit(int(factor(turn)) >> 1))
    pivots = live.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", turned, "node", "root")).alias("pivot"))
    pivots = pivots.select("key", F.col("pivot.node").alias("pivot"), F.col("pivot.root").alias("pivot_root"))
    return stored(live.join(pivots, "key"), "live-keys")


def star_round(members: DataFrame, star: DataFrame, tested: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """Each class tests the pivot it shares most keys with, if that is in another component.

    The new stars and tested pairs, and which part of this round's tests were links.
    """
    met = members.where("root <> pivot_root").groupBy("node", "pivot").agg(F.count("*").alias("n"))
    met = met.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b"), "node", "n")
    best = met.join(tested, ["a", "b"], "left_anti").groupBy("node").agg(F.max(F.struct("n", "a", "b")).alias("best"))
    result = similar(best.select("best.a", "best.b").distinct(), texts)
    part = result.agg(F.avg(F.col("linked").cast("int"))).first()[0] or 0.0
    star = connected(star.unionByName(result.where("linked").select("a", "b")))
    return star, tested.unionByName(result.select("a", "b")), part


def components(classes: DataFrame, texts_of_nodes) -> DataFrame:
    """Rows (a, b): class and the least class of its component, for all classes but the least ones.

    ``texts_of_nodes`` gives rows (node, text) for a frame of nodes.
    """
    members = shared_keys(classes)
    texts = stored(texts_of_nodes(members.select("node").distinct()), "class-texts")
    nothing = members.sparkSession.createDataFrame([], "a long, b long")
    members = live_members(members, nothing, 0)
    star, tested, part = star_round(members, nothing, nothing, texts)
    members = live_members(members, star, 1)
    bounds = shingle_counts(texts.join(members.select("node").distinct(), "node", "left_semi")).select("node", "size", "shared")
    # A link's common shingles are three quarters of either set, and shared.
    members = stored(members.join(bounds, "node").where(f"100 * shared >= {PERCENT} * size"), "live-bounds")
    for turn in range(1, STAR_ROUNDS):
        if part < WORTH:
            break
        hopeful = live_members(members.where(f"100 * shared >= {HOPEFUL} * size"), star, turn)
        if (hopeful.agg(F.max("n")).first()[0] or 0) <= SMALL_KEY:
            break
        star, tested, part = star_round(hopeful, star, tested, texts)
    pairs = last_pairs(live_members(members, star, STAR_ROUNDS), texts, classes.select("node", "signature"))
    pairs = not_far(pairs.join(tested, ["a", "b"], "left_anti"), classes)
    return connected(star.unionByName(similar(pairs, texts).where("linked").select("a", "b")))


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketches, and rows (set, root, component_id, doc, doc_key): the class of each set and the document that stands for its component."""
    rows = stored(sketches(docs), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    classes = rows.where("n_shingles > 0").groupBy("set").agg(first, F.first("signature").alias("signature"))
    classes = classes.select("set", F.col("first.doc_id").alias("doc"), F.col("first.text_key").alias("doc_key"), "signature")
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    def texts_of_nodes(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, "node", "left_semi").select("node", "doc", "doc_key")
        texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64("text").alias("text_key"))
        found = texts.join(wanted, (F.col("text_key") == F.col("doc_key")) & F.col("id").eqNullSafe(F.col("doc")))
        return found.select("node", "text").groupBy("node").agg(F.first("text").alias("text"))

    star = components(classes, texts_of_nodes)
    roots = star.select(F.col("a").alias("node"), F.col("b").alias("root"))
    rooted = classes.join(roots, "node", "left").select("set", "doc", "doc_key", F.coalesce("root", "node").alias("root"))
    stands = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "doc_key")).alias("stands"))
    named = rooted.select("set", "root").join(stands, "root")
    return rows, named.select("set", "root", F.col("stands.doc").alias("component_id"), F.col("stands.doc_key").alias("component_key"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) for all documents."""
    rows, named = grouped(docs)
    joined = rows.drop("signature").join(named.select("set", "component_id"), "set", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_words(text: Column) -> Column:
    return text.isNull() | ~text.rlike(r"[^\x20\x09-\x0D]")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, of which one stays for each component; those without words all stay.

    The one with the smallest id stays, of several such rows the first by text hash; of rows that agree in both, any.
    """
    rows, named = grouped(docs)
    stays = named.select("component_id", "component_key").distinct()
    counts = rows.where("n_shingles > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("component_key"))
    kept = counts.join(stays, same).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "n")
    # The documents travel as one column, so that no name of theirs can clash.
    packed, text = docs.select(F.struct("*").alias("document")), F.col("document").getField("text")
    own_id = F.col("document").getField("doc_id").cast("long")
    found = packed.where(~without_words(text)).join(kept, own_id.eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("key")))
    once = found.where("n = 1").select("document")
    several = found.where("n > 1").dropDuplicates(["id", "key"]).select("document")
    all_kept = once.unionByName(several).unionByName(packed.where(without_words(text)))
    return all_kept.select(*[F.col("document").getField(c).alias(c) for c in docs.columns])
