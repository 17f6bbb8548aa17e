"""Words, 64-bit names and windows of texts, as numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
#: Odd factors for the positions of a window; any odd numbers with well mixed bits would do.
_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def factor(i: int) -> np.uint64:
    """The i-th odd 64-bit factor."""
    x = (i + 1) * _GOLDEN & _MASK
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _MASK
    return U64((x ^ (x >> 31)) | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number with its bits mixed: near numbers come out far apart. One to one."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def release() -> None:
    """Hands free memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, which hands free memory back to the system when it ends; a worker that waits for its next task would hold it otherwise."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return whole


class Names(dict):
    """64-bit names of words, kept for words seen before; forgets all when it holds ``limit`` words. Long words are named anew each time."""

    def __init__(self, limit: int = 1 << 18):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        name = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = name
        return name

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def window_names(names: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit name for each run of ``width`` names, by its first position; equal runs have equal names."""
    n = len(names) - width + 1
    if n <= 0:
        return names[:0]
    out = np.zeros(n, U64)
    for i in range(width):
        out += names[i : i + n] * factor(i)
    return mixed(out)


def covered(starts: np.ndarray, width: int) -> np.ndarray:
    """From a mask of the starts of windows, the mask of the positions they cover, up to the end of the last window."""
    edges = np.zeros(len(starts) + width, np.int32)
    edges[: len(starts)] += starts
    edges[width:] -= starts
    return np.cumsum(edges)[:-1] > 0


def spans(mask: np.ndarray) -> np.ndarray:
    """Half-open (start, end) rows of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edges.reshape(-1, 2)
