"""Questions of many blocks of documents about all others, with one row for each block and part of the key space.

A block names its keys once each, so a key that a third of all rows holds arrives at most once from a block. A part
(keys equal modulo the number of parts) meets in one task, which sends an answer for each key back to each block in the
order it was asked. Keys travel as packed arrays, not as rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASKED = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("notes", pa.binary())])
#: Bytes of keys that a part holds, about.
PART_BYTES = 16 << 20


def part_count(spark, key_bytes: int) -> int:
    """Parts for so many bytes of keys: each small, and several for each shuffle partition so that these come out even."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-key_bytes // PART_BYTES))


def parts_of(key_bytes: int, part_bytes: int = 2 << 20) -> int:
    """Parts for so many bytes of keys, whatever the session's partitions. A block sends a row to each part it has keys for, so parts and
    blocks of a fixed size make rows that grow with the square of the input, until a row holds a single key; from there on in proportion."""
    return max(8, -(-key_bytes // part_bytes))


def deal(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts keys (the first column, if they have several) part by part, and where each part begins."""
    part = (keys if keys.ndim == 1 else keys[:, 0]) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))


def ask(blocks: DataFrame, keys_of: Callable[[dict], tuple[np.ndarray, np.ndarray]], parts: int) -> DataFrame:
    """Rows (part, block, keys, notes). ``keys_of`` gives a block's distinct keys (n, or n x 2) and a note of fixed size for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys, notes = keys_of(row)
                order, begins = deal(keys, parts)
                keys, notes = keys[order], notes[order]
                full = np.flatnonzero(np.diff(begins))
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(full, pa.int32()),
                        "block": pa.array([row["block"]] * len(full), pa.int64()),
                        "keys": pa.array([keys[begins[p] : begins[p + 1]].tobytes() for p in full], pa.binary()),
                        "notes": pa.array([notes[begins[p] : begins[p + 1]].tobytes() for p in full], pa.binary()),
                    },
                    schema=ASKED,
                )

    return blocks.mapInArrow(run, "part int, block long, keys binary, notes binary")


def answer(asked: DataFrame, reply_of: Callable[[bytes, bytes], tuple[np.ndarray, int]]) -> DataFrame:
    """Rows (block, part, reply). ``reply_of`` gets all keys and notes of a part and gives an answer for each key.

    It returns the answers (the first axis follows the keys) and the bytes of a key; boolean answers travel as bits.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        replies, width = reply_of(b"".join(group["keys"]), b"".join(group["notes"]))
        out, at = [], 0
        for keys in group["keys"]:
            n = len(keys) // width
            mine = replies[at : at + n]
            out.append((np.packbits(mine) if mine.dtype == bool else mine).tobytes())
            at += n
        return pd.DataFrame({"block": group["block"], "part": group["part"], "reply": out})

    return asked.groupBy("part").applyInPandas(run, "block long, part int, reply binary")


def attach(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """The blocks with the column ``replies``: what came back, a struct for each part. Null if a block asked nothing."""
    gathered = replies.groupBy("block").agg(F.collect_list(F.struct("part", "reply")).alias("replies"))
    return blocks.join(gathered, "block", "left")


def replies_in_order(row: dict, keys: np.ndarray, parts: int, kind: type) -> np.ndarray:
    """The answers in the order of the keys as ``keys_of`` gave them."""
    order, begins = deal(keys, parts)
    out = np.zeros(len(keys), kind)
    for x in row["replies"] or ():
        own = order[begins[x["part"]] : begins[x["part"] + 1]]
        raw = np.frombuffer(x["reply"], np.uint8 if kind is bool else kind)
        out[own] = np.unpackbits(raw, count=len(own)).astype(bool) if kind is bool else raw
    return out


def seen_twice(keys: bytes, notes: bytes) -> tuple[np.ndarray, int]:
    """For 64-bit keys: whether another block has the key too, or a block noted that it has it more than once."""
    all_keys = np.frombuffer(keys, np.uint64)
    order = np.argsort(all_keys)
    return _repeated(order, all_keys[order][1:] == all_keys[order][:-1], notes), 8


def times_seen(keys: bytes, notes: bytes) -> tuple[np.ndarray, int]:
    """For 64-bit keys with 32-bit counts as notes: the sum over all blocks, 255 at most."""
    _, which = np.unique(np.frombuffer(keys, np.uint64), return_inverse=True)
    sums = np.bincount(which, weights=np.frombuffer(notes, np.uint32))
    return np.minimum(sums, 255).astype(np.uint8)[which], 8


def seen_twice_wide(keys: bytes, notes: bytes) -> tuple[np.ndarray, int]:
    """As ``seen_twice``, for 128-bit keys."""
    all_keys = np.frombuffer(keys, np.uint64).reshape(-1, 2)
    order = np.lexsort((all_keys[:, 1], all_keys[:, 0]))
    ordered = all_keys[order]
    return _repeated(order, (ordered[1:] == ordered[:-1]).all(axis=1), notes), 16


def _repeated(order: np.ndarray, same: np.ndarray, notes: bytes) -> np.ndarray:
    repeated = np.zeros(len(order), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    out = np.empty(len(order), bool)
    out[order] = repeated
    return out | np.frombuffer(notes, bool)
