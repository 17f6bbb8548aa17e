"""Merkle manifest of a dataset: a leaf for each row, a tree for each source, a root over the sources, and an inclusion proof for each row.

A leaf's place among its source's leaves, in order of id, is found by rank queries on bitmaps; the leaves are never sorted. Tasks set a bit for
each id they see, in compressed bitmaps of 4,096 ids (``Ids``), which are merged for each (source, bucket). A directory of population
counts, three levels of 2^17 entries, gives the ids before each bucket. A row's place is its bucket's count and the bits below its own. Rows
of one id in one source are ordered by leaf, counted in cells of the leaf's first 16 bits, so even a third of all rows under one id
spreads over tasks; rows that are equal altogether are one row with a count until their places are dealt.

The tree is reduced 4,096 places at a time: the digests of a block travel to one task, each with its slot, and make up to three levels of 16.
Blocks are stored; on the way back each block hands its slots their siblings, so the last pass has a whole proof for each leaf.

Defined results: null values are hashed as ``-``; a null id comes first in its source, a null source first of all. Rows equal in all five
columns have equal leaves and places next to each other. A document without an id is never tampered with. Very long texts are only
hashed. An empty table gives no rows. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BUCKET_BITS = 12
BUCKET = 1 << BUCKET_BITS
#: Up to so many ids of a bucket are listed; of more, a bit for each id of the bucket takes less.
LISTED = BUCKET // 16 - 1
#: The bucket of null ids, before all others.
NO_ID = -(1 << 52)
#: Directory entries below one entry of the next level, as bits.
DIRECTORY_BITS = 17
RUN_BITS, BLOCK_LEVELS = 4, 3
RUN = 1 << RUN_BITS
BLOCK_BITS = RUN_BITS * BLOCK_LEVELS
#: Hexadecimal characters of a digest.
HEX = 64
#: Equal rows are dealt their places so many at a time.
AT_ONCE = 1 << 16

TIE = np.dtype([("low", "<u2"), ("more", "<i8")])


# Leaves


def measured(value: Column) -> Column:
    """A value as it enters a digest: byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    values = [F.col(c) for c in COLUMNS[:-1]] + [text]
    return F.sha2(F.concat(*map(measured, values)).cast("binary"), 256)


def leaf_rows(docs: DataFrame, tampered: Column | None) -> DataFrame:
    """Rows (source, doc_id, leaf, changed): ``changed`` is the leaf of the text in small letters where the row is tampered with, else null."""
    rows = docs.select(*[F.col(f"`{c}`").alias(c) for c in COLUMNS]).withColumn("source", F.col("source").cast("string"))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.when(tampered, leaf_of(lowered)) if tampered is not None else F.lit(None).cast("string")
    return rows.select("source", "doc_id", leaf_of(F.col("text")).alias("leaf"), changed.alias("changed"))


def bucket_of(doc_id: Column) -> Column:
    return F.coalesce(F.shiftright(doc_id, BUCKET_BITS), F.lit(NO_ID)).alias("bucket")


# Bitmaps of ids


class Ids(NamedTuple):
    """The ids of a bucket: their low bits, listed or as a bitmap, and how many more rows each repeated id has."""

    bits: bytes
    ties: bytes

    @classmethod
    def counted(cls, counts: np.ndarray) -> Ids:
        present, again = np.flatnonzero(counts), np.flatnonzero(counts > 1)
        ties = np.zeros(len(again), TIE)
        ties["low"], ties["more"] = again, counts[again] - 1
        bits = present.astype("<u2") if len(present) <= LISTED else np.packbits(counts > 0)
        return cls(bits.tobytes(), ties.tobytes())

    def counts(self) -> np.ndarray:
        out = np.zeros(BUCKET, np.int64)
        if len(self.bits) == BUCKET // 8:
            out += np.unpackbits(np.frombuffer(self.bits, np.uint8))
        else:
            out[np.frombuffer(self.bits, "<u2")] = 1
        ties = np.frombuffer(self.ties, TIE)
        out[ties["low"]] += ties["more"]
        return out


def id_bitmaps(rows: DataFrame) -> DataFrame:
    """Rows (source, bucket, n, bits, ties), one for each bucket of 4,096 ids that a source has."""
    partial = pa.schema([("source", pa.string()), ("bucket", pa.int64()), ("bits", pa.binary()), ("ties", pa.binary())])
    merged = pa.schema([("source", pa.string()), ("bucket", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("ties", pa.binary())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            out = []
            for (source, bucket), low in frame.groupby(["source", "bucket"], dropna=False, sort=False)["low"]:
                ids = Ids.counted(np.bincount(low.to_numpy(), minlength=BUCKET))
                out.append({"source": source if isinstance(source, str) else None, "bucket": bucket, "bits": ids.bits, "ties": ids.ties})
            yield pa.RecordBatch.from_pylist(out, schema=partial)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                counts = sum((Ids(x["bits"], x["ties"]).counts() for x in row["parts"]), np.zeros(BUCKET, np.int64))
                ids = Ids.counted(counts)
                out.append({"source": row["source"], "bucket": row["bucket"], "n": int(counts.sum()), "bits": ids.bits, "ties": ids.ties})
            yield pa.RecordBatch.from_pylist(out, schema=merged)

    low = F.coalesce(F.col("doc_id").bitwiseAND(BUCKET - 1), F.lit(0)).alias("low")
    marked = rows.select("source", bucket_of(F.col("doc_id")), low).mapInArrow(mark, "source string, bucket long, bits binary, ties binary")
    parts = marked.groupBy("source", "bucket").agg(F.collect_list(F.struct("bits", "ties")).alias("parts"))
    return parts.mapInArrow(merge, "source string, bucket long, n long, bits binary, ties binary")


def directory(bitmaps: DataFrame) -> DataFrame:
    """``bitmaps`` with ``before``, the rows of the source in lower buckets, and ``n``, all its rows; no window has over 2^17 rows of buckets."""

    def running(*keys: str, by: str) -> Column:
        lower = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(lower), F.lit(0))

    low = bitmaps.withColumn("high", F.shiftright("bucket", DIRECTORY_BITS))
    middle = low.groupBy("source", "high").agg(F.sum("n").alias("n")).withColumn("top", F.shiftright("high", DIRECTORY_BITS))
    top = middle.groupBy("source", "top").agg(F.sum("n").alias("n"))
    everything = F.sum("n").over(Window.partitionBy("source"))
    top = top.select(F.col("source").alias("s2"), F.col("top").alias("t2"), running("source", by="top").alias("b2"), everything.alias("total"))
    middle = middle.select("source", "high", "top", running("source", "top", by="high").alias("b1"))
    middle = middle.join(top, F.col("source").eqNullSafe(F.col("s2")) & (F.col("top") == F.col("t2")))
    middle = middle.select(F.col("source").alias("s1"), F.col("high").alias("h1"), (F.col("b1") + F.col("b2")).alias("b1"), "total")
    low = low.withColumn("b0", running("source", "high", by="bucket"))
    low = low.join(middle, F.col("source").eqNullSafe(F.col("s1")) & (F.col("high") == F.col("h1")))
    return low.select("source", "bucket", (F.col("b0") + F.col("b1")).alias("before"), F.col("total").alias("n"), "bits", "ties")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their place ``p`` among the ``n`` of their source; ``tied`` if other rows have the id, whose first place ``p`` then is."""
    index = stored(directory(stored(id_bitmaps(rows), "id-bitmaps")), "id-index")
    index = index.withColumnsRenamed({"source": "own", "bucket": "in"})
    met = rows.join(index, F.col("source").eqNullSafe(F.col("own")) & (bucket_of(F.col("doc_id")) == F.col("in")))
    columns = ["source", "doc_id", "leaf", "changed", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(256)
        def ranks(ids: Ids) -> tuple[np.ndarray, np.ndarray]:
            counts = ids.counts()
            return np.cumsum(counts) - counts, counts > 1

        for batch in batches:
            places, tied = [], []
            of = (batch.column(i).to_pylist() for i in range(5, 9))
            for low, before, bits, ties in zip(*of, strict=True):
                below, again = ranks(Ids(bits, ties))
                places.append(before + int(below[low]))
                tied.append(bool(again[low]))
            out = [*(batch.column(i) for i in range(5)), pa.array(places, pa.int64()), pa.array(tied, pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, names=[*columns, "p", "tied"])

    low = F.coalesce(F.col("doc_id").bitwiseAND(BUCKET - 1), F.lit(0)).alias("low")
    return met.select(*columns, low, "before", "bits", "ties").mapInArrow(
        run, "source string, doc_id long, leaf string, changed string, n long, p long, tied boolean"
    )


def placed(rows: DataFrame) -> DataFrame:
    """Rows (source, n, p, doc_id, leaf, changed) with a place of its own for each."""
    found = stored(ranked(rows), "ranked-leaves")
    own = found.where(~F.col("tied")).drop("tied")
    tied = found.where("tied").drop("tied")
    if tied.isEmpty():
        return own
    equal = tied.groupBy(*tied.columns).agg(F.count("*").alias("c")).withColumn("cell", F.substring("leaf", 1, 4))
    cells = equal.groupBy("source", "doc_id", "cell").agg(F.sum("c").alias("in_cell"))
    lower = Window.partitionBy("source", "doc_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("source").alias("s"), F.col("doc_id").alias("i"), F.col("cell").alias("k"),
        F.coalesce(F.sum("in_cell").over(lower), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("source", "doc_id", "cell").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    equal = equal.withColumn("within", F.coalesce(F.sum("c").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("s")) & F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("cell") == F.col("k"))
    begun = equal.join(cells, same).withColumn("first", F.col("p") + F.col("before") + F.col("within"))
    chunks = begun.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("c") - 1, F.lit(AT_ONCE)))).repartition("first", "from")
    last = F.least(F.col("from") + AT_ONCE, F.col("c")) - 1
    dealt = chunks.withColumn("p", F.explode(F.sequence(F.col("first") + F.col("from"), F.col("first") + last)))
    return own.unionByName(dealt.select(own.columns))


# Trees


def levels(digests: list[bytes], n: int) -> list[list[bytes]]:
    """The digests of a block and those of up to three levels above, for a tree that has ``n`` nodes where the block lies."""
    out = [digests]
    while n > 1 and len(out) <= BLOCK_LEVELS:
        out.append([sha256(b"".join(out[-1][i : i + RUN])).hexdigest().encode() for i in range(0, len(out[-1]), RUN)])
        n = -(-n // RUN)
    return out


def count_above(n: Column) -> Column:
    """Nodes that a tree of ``n`` nodes has three levels up."""
    return F.ceil(n / (1 << BLOCK_BITS)).cast("long")


def blocks(nodes: DataFrame, *payload: str) -> DataFrame:
    """Rows (tree, n, g, slots): the nodes (tree, n, p, digest, payload) of 4,096 places, in any order, each with its slot."""
    slot = F.col("p").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("slot")
    return nodes.groupBy("tree", "n", F.shiftright("p", BLOCK_BITS).alias("g")).agg(
        F.collect_list(F.struct(slot, "digest", *payload)).alias("slots")
    )


def slot_array(slots: list[dict]) -> list[dict]:
    out = [None] * len(slots)
    for x in slots:
        out[x["slot"]] = x
    return out


def tops(packed: DataFrame) -> DataFrame:
    """The nodes (tree, n, p, digest) above the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, n, g, slots = (batch.column(i).to_pylist() for i in range(4))
            digests = [levels([x["digest"].encode() for x in slot_array(s)], k)[-1][0].decode() for s, k in zip(slots, n, strict=True)]
            out = [batch.column(0), batch.column(1), batch.column(2), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["tree", "n", "p", "digest"])

    above = packed.select("tree", "n", "g", "slots").mapInArrow(run, "tree string, n long, p long, digest string")
    return above.withColumn("n", count_above(F.col("n")))


class Siblings:
    """What lies left and right of a node in its run, level by level up through the block."""

    def __init__(self, digests: list[bytes], n: int):
        self.rows = [b"".join(x) for x in levels(digests, n)[:-1]]

    def of(self, slot: int) -> tuple[list[bytes], list[bytes]]:
        left, right = [], []
        for row in self.rows:
            begin = slot // RUN * RUN
            left.append(row[HEX * begin : HEX * slot])
            right.append(row[HEX * (slot + 1) : HEX * (begin + RUN)])
            slot //= RUN
        return left, right


def folded(digest: bytes, left: list[bytes], right: list[bytes]) -> bytes:
    """The root that a node and its siblings give."""
    for a, b in zip(left, right, strict=True):
        digest = sha256(a + digest + b).hexdigest().encode()
    return digest


PATH = "lefts array<binary>, rights array<binary>, top string"


def with_paths(packed: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with the columns (lefts, rights, top) of the node above them."""
    above = above.select(F.col("tree").alias("own"), F.col("p").alias("node"), "lefts", "rights", "top")
    met = packed.join(above, F.col("tree").eqNullSafe(F.col("own")) & (F.col("g") == F.col("node")))
    return met.drop("own", "node")


def paths_below(packed: DataFrame, above: DataFrame) -> DataFrame:
    """Rows (tree, p, lefts, rights, top) for the nodes in the blocks, from those of the nodes above."""
    schema = pa.schema(
        [("tree", pa.string()), ("p", pa.int64()), ("lefts", pa.list_(pa.binary())), ("rights", pa.list_(pa.binary())), ("top", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, out = batch.slice(i, 1).to_pylist()[0], []
                siblings = Siblings([x["digest"].encode() for x in slot_array(row["slots"])], row["n"])
                for slot in range(len(row["slots"])):
                    left, right = siblings.of(slot)
                    place = (row["g"] << BLOCK_BITS) + slot
                    out.append({"tree": row["tree"], "p": place, "lefts": left + row["lefts"], "rights": right + row["rights"], "top": row["top"]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    columns = ["tree", "n", "g", "slots", "lefts", "rights", "top"]
    return with_paths(packed, above).select(columns).mapInArrow(run, f"tree string, p long, {PATH}")


def height(nodes: DataFrame) -> int:
    """Layers of blocks until each tree is one node; at least one."""
    most, layers = nodes.agg(F.max("n")).first()[0] or 0, 1
    while most > 1 << BLOCK_BITS:
        most, layers = -(-most >> BLOCK_BITS), layers + 1
    return layers


def forest(nodes: DataFrame, *payload: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored layers of blocks over the nodes (tree, n, p, digest), and the roots of the trees (tree, digest)."""
    layers = []
    for layer in range(height(nodes)):
        layers.append(stored(blocks(nodes, *(payload if layer == 0 else ())), "manifest-blocks"))
        nodes = tops(layers[-1])
    return layers, stored(nodes.select("tree", "digest"), "manifest-roots")


def in_order(roots: DataFrame) -> DataFrame:
    """Nodes (tree, n, p, digest, source) of one tree over the roots, in order of the source's bytes, null first.

    Sources are sorted by ranges; what the ranges before hold is added to the place in the range.
    """
    ordered = roots.orderBy(F.col("tree").asc_nulls_first()).withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    ordered = stored(ordered, "sources")
    sizes = ordered.groupBy("part").agg(F.count("*").alias("c"))
    lower = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "part", F.coalesce(F.sum("c").over(lower), F.lit(0)).alias("before"), F.sum("c").over(Window.partitionBy(F.lit(0))).alias("n")
    )
    place = F.col("before") + F.col("row").bitwiseAND((1 << 33) - 1)
    joined = ordered.join(sizes, "part")
    return joined.select(F.lit("sources").alias("tree"), "n", place.alias("p"), "digest", F.col("tree").alias("source"))


def source_paths(roots: DataFrame) -> DataFrame:
    """Rows (tree, p, lefts, rights, top) that lead from the root of each source's tree to the root of all."""
    nodes = stored(in_order(roots), "ordered-sources")
    layers, root = forest(nodes)
    none = F.array().cast("array<binary>")
    paths = root.select("tree", F.lit(0).cast("long").alias("p"), none.alias("lefts"), none.alias("rights"), F.col("digest").alias("top"))
    for packed in reversed(layers):
        paths = paths_below(packed, paths)
    named = nodes.select("source", F.col("p").alias("at"))
    met = paths.join(named, F.col("p") == F.col("at"))
    return met.select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("p"), "lefts", "rights", "top")


PROVED = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    + [("verified", pa.bool_()), ("source", pa.string()), ("place", pa.int64())]
)


def proofs(packed: DataFrame, above: DataFrame) -> DataFrame:
    """The result rows of the leaves in the lowest blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, out = batch.slice(i, 1).to_pylist()[0], []
                slots = slot_array(row["slots"])
                siblings = Siblings([x["digest"].encode() for x in slots], row["n"])
                upper = b"".join(a + b for a, b in zip(row["lefts"], row["rights"], strict=True))
                for slot, x in enumerate(slots):
                    left, right = siblings.of(slot)
                    proof = sha256(b"".join(a + b for a, b in zip(left, right, strict=True)) + upper).hexdigest()
                    leaf = x["digest"] if x["changed"] is None else x["changed"]
                    root = folded(leaf.encode(), left + row["lefts"], right + row["rights"]).decode()
                    out.append(
                        {"doc_id": x["doc_id"], "leaf": x["digest"], "subroot": row["subroot"], "root": row["top"], "proof_sha256": proof,
                         "folded_root": root, "verified": root == row["top"], "source": row["tree"], "place": (row["g"] << BLOCK_BITS) + slot}
                    )
                yield pa.RecordBatch.from_pylist(out, schema=PROVED)

    ddl = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
        "source string, place long"
    )
    columns = ["tree", "n", "g", "slots", "lefts", "rights", "top", "subroot"]
    return with_paths(packed, above).select(columns).mapInArrow(run, ddl)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source, place) for all documents.

    ``tampered`` says of which documents the copy that is verified has A-Z of its text in small letters. Their roots are folded from
    the changed leaf and the original siblings, those of all others from their own; a row is verified if it leads to the root.
    """
    leaves = stored(leaf_rows(docs, tampered), "leaves")
    nodes = placed(leaves).withColumnsRenamed({"source": "tree", "leaf": "digest"})
    layers, roots = forest(stored(nodes, "placed-leaves"), "doc_id", "changed")
    paths = source_paths(roots)
    for packed in reversed(layers[1:]):
        paths = paths_below(packed, paths)
    subroots = roots.select(F.col("tree").alias("of"), F.col("digest").alias("subroot"))
    lowest = layers[0].join(subroots, F.col("tree").eqNullSafe(F.col("of"))).drop("of")
    return proofs(lowest, paths)
