"""Sharding by a minimax contiguous partition of ordered groups.

A group is all rows of equal text; it is atomic and has the place of its text's 64-bit hash in the order. The smallest shard
capacity that suffices for the number of shards is found by binary search, a capacity being checked greedily, and the order
is cut there. The groups themselves stay distributed. The driver holds sums over ranges of hashes: it first sees 16,384
ranges, tells from them between which bounds the capacity lies and which ranges a cut can fall into, and has only these
ranges (some 1,600 for 40 shards, whatever the input) summed again in 32 parts each, until each cut falls between single
groups. So the capacity is exact.

A group larger than an even share gets a shard of its own, and the others are dealt over the remaining shards: otherwise one
large group would set the capacity for all.

Defined results: a null text has size 16 like an empty one, its checksum is 0, and null texts are a group of their own. Null and
repeated ids are allowed. With fewer groups than shards some shards stay empty; an empty table gives no rows. Equal texts, and rows repeated whole, are
in one shard, each row with a slot of its own. A column ``shard`` that the documents have is replaced; others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopbank.llm.scratch import stored

FIRST_BITS, MORE_BITS = 14, 5
#: Rows that one task numbers, about.
CELL_ROWS = 200_000
#: Equal rows that are written out together.
RUN = 4096


class Ranges:
    """Ranges of hashes in order: first hash, bits of their common prefix, number of groups, and the groups' sizes summed.

    ``ends`` are the running sums of the sizes. A range of one group cannot be divided.
    """

    def __init__(self, start: np.ndarray, bits: np.ndarray, groups: np.ndarray, size: np.ndarray):
        order = np.argsort(start)
        self.start, self.bits, self.groups, self.size = start[order], bits[order], groups[order], size[order]
        self.ends = np.cumsum(self.size)
        self.atomic = (self.groups == 1) | (self.bits >= 64)
        self.total = int(self.ends[-1]) if len(start) else 0

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.start, self.bits, self.groups, self.size


def prefix_of(key: Column, bits: int) -> Column:
    """The first bits of a hash, read as an unsigned number."""
    return F.shiftrightunsigned(key, 64 - bits) if bits < 64 else key


def measured(groups: DataFrame, parent_bits: int | None = None, parents: np.ndarray | None = None) -> Ranges:
    """Sums over the first ranges, or over the parts of the ranges that start at ``parents``."""
    bits = FIRST_BITS if parents is None else min(64, parent_bits + MORE_BITS)
    if parents is not None:
        inside = prefix_of(F.col("key"), parent_bits)
        groups = groups.where(inside.isin([int(x) >> (64 - parent_bits) for x in parents]))
    prefix = prefix_of(F.col("key"), bits).alias("prefix")
    sums = groups.groupBy(prefix).agg(F.count("*").alias("n"), F.sum("size").alias("size")).toPandas()
    start = sums["prefix"].to_numpy(np.int64).astype(np.uint64) << np.uint64(64 - bits)
    return Ranges(start, np.full(len(start), bits), sums["n"].to_numpy(np.int64), sums["size"].to_numpy(np.int64))


def greedy_cuts(ranges: Ranges, capacity: int, most: int) -> list[int] | None:
    """Indexes at which the shards begin if each takes as many undivided ranges as fit; None if ``most`` do not suffice."""
    starts, at, filled = [0], 0, 0
    for _ in range(most):
        at = int(np.searchsorted(ranges.ends, filled + capacity, side="right"))
        if at == len(ranges.ends):
            return starts
        if at == starts[-1]:
            return None
        starts.append(at)
        filled = int(ranges.ends[at - 1])
    return None


def least_capacity(ranges: Ranges, shards: int) -> int:
    """The smallest capacity that suffices if no range is divided, by binary search."""
    low, high = max(-(-ranges.total // shards), int(ranges.size.max())), ranges.total
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(ranges, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def in_doubt(ranges: Ranges, shards: int) -> np.ndarray:
    """Mask of the ranges of several groups that a greedy cut may fall into, for any capacity that may be the smallest.

    That capacity is at least an even share and the largest single group, and at most what suffices with no range divided.
    The k-th cut is not before the place that the low capacity reaches if a range that does not fit is put off whole, and not after
    the place that the high capacity reaches if ranges are divided at will. Where the low capacity does not get past a
    range, that range is settled first and the later cuts wait for the next call.
    """
    single = ranges.size[ranges.atomic]
    low = max(-(-ranges.total // shards), int(single.max()) if len(single) else 0)
    high = least_capacity(ranges, shards)
    wanted, early, late = np.zeros(len(ranges.size), bool), 0, 0
    for _ in range(shards - 1):
        first = int(np.searchsorted(ranges.ends, early + low, side="right"))
        reached = int(ranges.ends[first - 1]) if first else 0
        late = min(ranges.total, late + high)
        wanted[first : int(np.searchsorted(ranges.ends, late, side="right")) + 1] = True
        if reached <= early:
            break
        early = reached
    return wanted & ~ranges.atomic


def refined(groups: DataFrame, shards: int) -> Ranges:
    """Ranges of one group each wherever a cut may fall, longer ones elsewhere."""
    ranges = measured(groups)
    while ranges.total and (wanted := in_doubt(ranges, shards)).any():
        parts = [tuple(c[~wanted] for c in ranges.columns())]
        for bits in np.unique(ranges.bits[wanted]):
            parents = ranges.start[wanted & (ranges.bits == bits)]
            parts.append(measured(groups, int(bits), parents).columns())
        ranges = Ranges(*(np.concatenate(c) for c in zip(*parts, strict=True)))
    return ranges


def heavy_groups(groups: DataFrame, shards: int) -> list[tuple[int, int]]:
    """(key, size) of the groups above an even share of what the larger ones leave: fewer than there are shards."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    top = groups.orderBy(F.col("size").desc(), "key").limit(shards - 1).collect() if total else []
    heavy = []
    for r in top:
        if r.size * (shards - len(heavy)) <= total:
            break
        heavy.append((r.key, r.size))
        total -= r.size
    return heavy


@dataclass
class Plan:
    """Where each hash goes: the heavy groups to shards of their own from 0, the others by the first hash of each shard."""

    heavy: list[int]
    starts: list[int]
    capacity: int

    def shard(self, key: Column) -> Column:
        """Unsigned order of hashes is the order of signed ones with the sign bit turned."""
        turned = key.bitwiseXOR(F.lit(-(1 << 63)))
        bounds = [s - (1 << 63) for s in self.starts]
        light = F.lit(len(self.heavy))
        for bound in bounds[1:]:
            light = light + (turned >= F.lit(bound)).cast("int")
        out = light
        for i, k in enumerate(self.heavy):
            out = F.when(key == F.lit(k), F.lit(i)).otherwise(out)
        return out.cast("int")


def planned(groups: DataFrame, shards: int) -> Plan:
    """The smallest capacity and its cuts. ``groups`` has (key, size) and is read a few times."""
    heavy = heavy_groups(groups, shards)
    keys = [k for k, _ in heavy]
    rest = groups.where(~F.col("key").isin(keys)) if keys else groups
    ranges = refined(rest, shards - len(heavy))
    if not ranges.total:
        return Plan(keys, [0], max([0, *(s for _, s in heavy)]))
    capacity = least_capacity(ranges, shards - len(heavy))
    starts = [int(ranges.start[i]) for i in greedy_cuts(ranges, capacity, shards - len(heavy))]
    return Plan(keys, starts, max([capacity, *(s for _, s in heavy)]))


def text_key(text: Column) -> Column:
    """64-bit hash of a text; equal texts are equal. Null has a hash of its own."""
    return F.xxhash64(text.isNull(), text)


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def shard_plan(docs: DataFrame, shards: int, text_column: str = "text") -> tuple[DataFrame, Plan]:
    """Rows (doc_id, key, size, text_crc32) as stored, and the plan for them."""
    text = F.col(f"`{text_column}`")
    rows = docs.select(
        F.col("doc_id"), text_key(text).alias("key"), row_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    rows = stored(rows, "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    return rows, planned(groups, shards)


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot): slots count from 0 in each shard without gaps.

    Rows are numbered in cells of a shard, dealt by hash of id and text; a cell begins where those before it end. The number
    of cells follows the number of rows, so a shard is numbered by many tasks. Rows equal in id and text, null ones too, are counted
    before they are numbered and take one number after the other; ``RUN`` numbers or fewer are written out by one task.
    """
    rows, plan = shard_plan(docs, shards)
    kinds = rows.groupBy("doc_id", "key", "size", "text_crc32").agg(F.count("*").alias("n"))
    cells = 1 + rows.count() // CELL_ROWS
    placed = kinds.select(
        "*", plan.shard(F.col("key")).alias("shard"),
        F.pmod(F.xxhash64("doc_id", "key"), F.lit(cells)).cast("int").alias("cell"),
    )
    counts = placed.groupBy("shard", "cell").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "cell", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin"))
    earlier = Window.partitionBy("shard", "cell").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("number", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(begins, ["shard", "cell"])
    numbered = stored(numbered.withColumn("first", F.col("begin") + F.col("number")), "shard-slots")
    few = numbered.where(F.col("n") <= RUN).select("*", F.lit(0).cast("long").alias("run"))
    # A hot row is a few numbers until its runs have been dealt to the tasks.
    runs = numbered.where(F.col("n") > RUN).withColumn("runs", F.expr(f"(n - 1) div {RUN}"))
    many = runs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "runs")).alias("run")).drop("runs").repartition("first", "run")
    last = F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1
    slots = few.unionByName(many).select("*", F.explode(F.sequence(F.col("run") * RUN, last)).alias("place"))
    return slots.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"))


def sharded_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """The documents with the column ``shard``. The texts are not shuffled: the shard follows from the text's hash."""
    _, plan = shard_plan(docs, shards)
    return docs.withColumn("shard", plan.shard(text_key(F.col("text"))))


def write_shards(docs: DataFrame, folder: str, shards: int = 40) -> None:
    """Parquet files below ``folder/shard=N``."""
    sharded_documents(docs, shards).write.partitionBy("shard").parquet(folder)
