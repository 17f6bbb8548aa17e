"""A fixed vocabulary of 64 symbols for bytes of text, and n-grams of them as numbers."""

from __future__ import annotations

import numpy as np

BITS = 6
SYMBOLS = 1 << BITS
#: a-z, a digit, blank, line end, punctuation, marks, any other ASCII, and bytes beyond ASCII by their low bits.
_GROUPS = [*"abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n\r", *".,!?'\"-(;:/", *"#*$%&|<>"]


def _table() -> np.ndarray:
    table = np.full(256, len(_GROUPS), np.uint32)
    for symbol, group in enumerate(_GROUPS):
        for c in group + group.upper():
            table[ord(c)] = symbol
    beyond = len(_GROUPS) + 1
    table[128:] = beyond + np.arange(128) % (SYMBOLS - beyond)
    return table


_TABLE = _table()
#: What stands before a text.
START = int(_TABLE[ord("\n")])


def grams(text: bytes, order: int) -> np.ndarray:
    """For each byte, the number made of its symbol and the ``order - 1`` symbols before it."""
    symbols = np.concatenate((np.full(order - 1, START, np.uint32), _TABLE[np.frombuffer(text, np.uint8)]))
    n = len(text)
    out = np.zeros(n, np.uint32)
    for i in range(order):
        out = (out << np.uint32(BITS)) | symbols[i : i + n]
    return out
