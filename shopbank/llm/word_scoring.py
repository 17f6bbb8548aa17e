"""Cross-entropy difference over words: documents scored by two word n-gram models, of a target text and of all text.

Tokens are words as they stand (runs of letters, digits and underscores, case kept; a letter of a script written without blanks, and any
other visible character, is a token of its own) and the end of the text. A model's entries are all 1-, 2- and 3-grams of all documents, so
they grow with the corpus; nothing is left out. A token's probability mixes its relative frequencies after two, one and no tokens with
fixed ``WEIGHTS``; where a model has not seen what stands before, the next shorter frequency takes that weight. The rest, and a model
without text, falls to the token's frequency in all text. A document's score is the mean over its tokens of the loss under the target
model less that under the background model, in nats: the lower, the more it reads like the target.

Documents are tokenized once and packed as blocks of token numbers. A block names each of its n-grams once with its own counts, so a hot
n-gram arrives once from each block; a part of the key space sums them in one task and answers with both counts (``exchange``).
Names travel sorted, as packed differences, and 3-grams apart from shorter ones, so that fewer are on disk at a time. No table of n-grams
reaches the driver and none is broadcast: the driver sees four sums. What stands before a token is itself a counted n-gram, as every
word is followed by a word or by the end of the text, so no other counts are asked for.

N-grams go by 64-bit names. Counts are exact up to 2^24 and rounded to 24 bits beyond, when they are answered.

Defined results: a text without tokens (null, empty, blanks) has a null score. A document is target if any row of ``target_ids`` has its
id; a null id is never. Without any target text the target model is the frequency of each token alone. Repeated and null ids are scored
row by row. An empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopbank.llm.exchange import PART_BYTES, deal, replies_in_order
from shopbank.llm.scratch import stored
from shopbank.llm.words import U64, factor, mixed, release, released

ORDER = 3
#: Weight of the frequencies after two, one and no tokens; the rest goes to the frequency in all text.
WEIGHTS = (0.5, 0.3, 0.15)
BLOCK_TOKENS = 3 << 19
#: Sizes of n-grams that are counted together.
PASSES = ((3,), (1, 2))

#: Thai to Lao, Myanmar, Khmer, kana and Han: no blanks between words.
_UNSPACED = r"฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
_TOKEN = re.compile(r"\w+|[^\w\s]")
_TOKEN_UNSPACED = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+|[^\w\s]")
_ANY_UNSPACED = re.compile(rf"[{_UNSPACED}]")
#: The end of a text; no token is empty. What stands before a text has a name that is no word's.
END, START = "", U64(0x5BD1E995A3C59AC3)

COUNTS = np.dtype([("target", np.uint32), ("all", np.uint32)])
SUMS = np.dtype([("target", np.float32), ("all", np.float32)])
BLOCK = pa.schema(
    [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("targets", pa.list_(pa.bool_()))]
    + [("codes", pa.binary()), ("names", pa.binary())]
    + [(c, pa.int64()) for c in ("n_tokens", "n_texts", "target_tokens", "target_texts")]
)


def tokens_of(text: str | None) -> list[str]:
    """Words and the end; nothing for a text without words."""
    if not text:
        return []
    unspaced = not text.isascii() and _ANY_UNSPACED.search(text)
    out = (_TOKEN_UNSPACED if unspaced else _TOKEN).findall(text)
    return [*out, END] if out else []


class _Codes(dict):
    """Numbers of tokens, in order of appearance."""

    def __missing__(self, token: str) -> int:
        code = self[token] = len(self)
        return code


def token_blocks(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, is_target) packed to blocks of about ``BLOCK_TOKENS`` tokens: numbers of tokens, and the names of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, targets, parts, codes, held = [], [], [], _Codes(), 0

        def block() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in parts], np.int64)
            wanted = np.array(targets, bool)
            row = {
                "block": number, "ids": ids, "sizes": sizes.tolist(), "targets": targets,
                "codes": zstandard.compress(np.concatenate(parts).tobytes()),
                "names": np.array([xxhash.xxh3_64_intdigest(token) for token in codes], U64).tobytes(),
                "n_tokens": int(sizes.sum()), "n_texts": int((sizes > 0).sum()),
                "target_tokens": int(sizes[wanted].sum()), "target_texts": int((sizes[wanted] > 0).sum()),
            }
            return pa.RecordBatch.from_pylist([row], schema=BLOCK)

        for batch in batches:
            for i, text, target in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                tokens = tokens_of(text)
                ids.append(i)
                targets.append(target)
                parts.append(np.fromiter(map(codes.__getitem__, tokens), np.uint32, len(tokens)))
                held += len(tokens) + 4
                if held >= BLOCK_TOKENS:
                    yield block()
                    number += 1
                    ids, targets, parts, codes, held = [], [], [], _Codes(), 0
        if ids:
            yield block()

    kinds = "block long, ids array<long>, sizes array<long>, targets array<boolean>, codes binary, names binary"
    return docs.mapInArrow(released(run), kinds + ", n_tokens long, n_texts long, target_tokens long, target_texts long")


def gram_names(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    """Names of the 1-, 2- and 3-grams that end at each token of a block, and where its texts begin."""
    codes = np.frombuffer(zstandard.decompress(row["codes"]), np.uint32)
    word = np.frombuffer(row["names"], U64)[codes]
    sizes = np.array(row["sizes"], np.int64)
    begins = (np.cumsum(sizes) - sizes)[sizes > 0]
    out, total = [], np.zeros(len(word), U64)
    for size in range(1, ORDER + 1):
        total = total + word * factor(size)
        out.append(mixed(total + factor(100 + size)))
        word = np.concatenate(([START], word[:-1])) if len(word) else word
        word[begins] = START
    return out, begins


def distinct_grams(grams: list[np.ndarray], sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names of n-grams of these sizes, and which of them each (size, token) has."""
    keys, which = np.unique(np.concatenate([grams[size - 1] for size in sizes]), return_inverse=True)
    return keys, which.reshape(len(sizes), -1)


def gram_counts(row: dict, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct names and how often each stands in target texts and in all."""
    keys, which = distinct_grams(gram_names(row)[0], sizes)
    wanted = np.repeat(np.array(row["targets"], bool), np.array(row["sizes"], np.int64))
    counts = np.zeros(len(keys), COUNTS)
    counts["all"] = np.bincount(which.ravel(), minlength=len(keys))
    counts["target"] = np.bincount(which[:, wanted].ravel(), minlength=len(keys))
    return keys, counts


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _from_planes(raw: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def packed(keys: np.ndarray, counts: np.ndarray, parts: int) -> bytes:
    """Ascending keys of one part and their counts: differences and counts, compressed byte by byte of equal weight."""
    steps = np.diff(keys // U64(parts), prepend=U64(0))
    return zstandard.compress(_planes(steps) + b"".join(_planes(np.ascontiguousarray(counts[c])) for c in COUNTS.names), 1)


def unpacked(raw: bytes, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(raw)
    n = len(raw) // (8 + COUNTS.itemsize)
    counts = np.empty(n, COUNTS)
    for k, name in enumerate(COUNTS.names):
        counts[name] = _from_planes(raw[(8 + 4 * k) * n : (12 + 4 * k) * n], np.uint32)
    return np.cumsum(_from_planes(raw[: 8 * n], U64), dtype=U64) * U64(parts) + U64(part), counts


def summed(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each key the counts of all blocks together."""
    _, which = np.unique(keys, return_inverse=True)
    out = np.empty(len(counts), SUMS)
    for name in SUMS.names:
        out[name] = np.bincount(which, weights=counts[name])[which]
    return out


ASKED = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("grams", pa.binary())])


def replies(blocks: DataFrame, sizes: tuple[int, ...], parts: int) -> DataFrame:
    """Rows (block, replies): the counts over all documents of each block's n-grams of these sizes."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys, counts = gram_counts(row, sizes)
                order, begins = deal(keys, parts)
                keys, counts = keys[order], counts[order]
                full = np.flatnonzero(np.diff(begins))
                grams = [packed(keys[begins[p] : begins[p + 1]], counts[begins[p] : begins[p + 1]], parts) for p in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([row["block"]] * len(full), pa.int64()), pa.array(grams, pa.binary())], schema=ASKED
                )

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        found = [unpacked(raw, part, parts) for raw, part in zip(group["grams"], group["part"], strict=True)]
        sums = summed(np.concatenate([keys for keys, _ in found]), np.concatenate([counts for _, counts in found]))
        ends = np.cumsum([len(keys) for keys, _ in found])
        sent = [zstandard.compress(_planes(x), 1) for x in np.split(sums, ends[:-1])]
        del found, sums
        release()
        return pd.DataFrame({"block": group["block"], "part": group["part"], "reply": sent})

    asked = blocks.mapInArrow(released(ask), "part int, block long, grams binary")
    answers = asked.groupBy("part").applyInPandas(answer, "block long, part int, reply binary")
    return answers.groupBy("block").agg(F.collect_list(F.struct("part", "reply")).alias("replies"))


def stored_alone(df: DataFrame, label: str) -> DataFrame:
    """``stored``, and what was shuffled for it goes as soon as it is written."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return stored(df, label)
    finally:
        conf.set(name, before)


def probabilities(seen: np.ndarray, begins: np.ndarray, n_tokens: float, n_texts: float, base: np.ndarray) -> np.ndarray:
    """The mixed probability of each token; ``seen`` has the counts of the n-grams that end there, a row for each size."""
    shorter, mean = base, (1.0 - sum(WEIGHTS)) * base
    for size, weight in zip(range(ORDER), reversed(WEIGHTS), strict=True):
        if size:
            before = np.concatenate(([0.0], seen[size - 1][:-1]))
            before[begins] = n_texts
        else:
            before = np.full(len(base), n_tokens)
        shorter = np.where(before > 0, seen[size] / np.maximum(before, 1.0), shorter)
        mean = mean + weight * shorter
    return mean


OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])


def word_cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Rows (doc_id, n_tokens, score) of all documents against the target, the documents whose id is in ``target_ids``."""
    spark = docs.sparkSession
    wanted = target_ids.select(F.col("doc_id").alias("target_id")).where("target_id is not null").distinct()
    # Target ids grow with the corpus: the join is a merge at every size, and skewed ids can be split.
    flagged = docs.select("doc_id", "text").join(wanted.hint("merge"), F.col("doc_id") == F.col("target_id"), "left")
    flagged = flagged.select(F.col("doc_id").cast("long"), "text", F.col("target_id").isNotNull())
    blocks = stored_alone(token_blocks(flagged), "token-blocks")
    totals = blocks.agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_texts", "target_tokens", "target_texts")]).first()
    n_tokens, n_texts, target_tokens, target_texts = (float(x or 0) for x in totals)
    # Names spread evenly, so one part for each shuffle partition will do; a block sends a row to each.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-16 * int(n_tokens) // PART_BYTES))
    rows = blocks.select("block", "ids", "sizes", "targets", "codes", "names")
    for k, sizes in enumerate(PASSES):
        found = stored_alone(replies(blocks.select("block", "sizes", "targets", "codes", "names"), sizes, parts), "gram-replies")
        rows = rows.join(found.withColumnRenamed("replies", f"replies{k}"), "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams, begins = gram_names(row)
                # Names, answers and sums go as soon as they are used, and counts are kept as they were answered: a block is large.
                seen, wanted = np.empty((2, ORDER, len(grams[0])), np.float32)
                for k, group in enumerate(PASSES):
                    keys, which = distinct_grams(grams, group)
                    for size in group:
                        grams[size - 1] = None
                    answers = (x | {"reply": _from_planes(zstandard.decompress(x["reply"]), SUMS)} for x in row.pop(f"replies{k}") or ())
                    sums = replies_in_order({"replies": answers}, keys, parts, SUMS)
                    for size, at in zip(group, which, strict=True):
                        seen[size - 1], wanted[size - 1] = sums["all"][at], sums["target"][at]
                    del keys, which, sums, answers
                base = seen[0].astype(np.float64) / max(n_tokens, 1.0)
                losses = np.log(probabilities(seen, begins, n_tokens, n_texts, base))
                del seen
                losses -= np.log(probabilities(wanted, begins, target_tokens, target_texts, base))
                del wanted, base
                sizes = np.array(row["sizes"], np.int64)
                scores = np.full(len(sizes), np.nan)
                if len(begins):
                    scores[sizes > 0] = np.add.reduceat(losses, begins) / sizes[sizes > 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(sizes), pa.Array.from_pandas(pd.Series(scores))], schema=OUT
                )

    return rows.mapInArrow(released(run), "doc_id long, n_tokens long, score double")
