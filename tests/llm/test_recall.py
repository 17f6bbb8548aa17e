"""Which of all linked pairs, found by brute force, meet in the near-duplicate operator: they share a key and are not set aside as far."""

import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from shopbank.llm import near_dedup


def edited_copies():
    """Texts of 120 words and copies with one to three words replaced: similarities from 0.75 to 0.92."""
    rng = random.Random(11)
    out = []
    for k in range(2500):
        words = [f"w{rng.randrange(50_000)}" for _ in range(120)]
        out.append(" ".join(words))
        for at in rng.sample(range(120), 3 if k % 5 else 1 + k % 2):
            words[at] = "edited"
        out.append(" ".join(words))
    return out


def given_documents():
    return pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()


def linked_pairs(sets):
    """All pairs of different sets with a similarity of 0.75 or more, by counting what each two have in common."""
    holders, common = {}, Counter()
    for i, names in enumerate(sets):
        for name in names.tolist():
            common.update((j, i) for j in holders.get(name, ()))
            holders.setdefault(name, []).append(i)
    return [(i, j) for (i, j), c in common.items() if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c)]


@pytest.mark.parametrize(("texts", "least"), [(edited_copies, 2400), (given_documents, 1)])
def test_every_link_shares_a_key(texts, least):
    names = near_dedup.Names()
    sets = {s.tobytes(): s for t in texts() if len(s := near_dedup.shingles((t or "").encode(), names))}
    sets = list(sets.values())
    links = linked_pairs(sets)
    codes = [near_dedup.signature(s) for s in sets]
    keys = [near_dedup.index_keys(c.tobytes())[0] for c in codes]
    missed = [p for p in links if not (keys[p[0]] == keys[p[1]]).any() or (codes[p[0]] != codes[p[1]]).sum() > near_dedup.FAR]
    print(f"{len(sets)} sets, {len(links)} links, {len(missed)} missed; codes differ in {np.max([(codes[i] != codes[j]).sum() for i, j in links])} at most")
    assert len(links) >= least and not missed
