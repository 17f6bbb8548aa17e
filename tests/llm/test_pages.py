"""Visible text of pages: elements left out, odd markup, and time linear in the page."""

import random
import re
import time

import pytest

from shopbank.llm.language_id import visible

SKIPPED = re.compile(rb"<(script|style|nav|head)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
PIECES = [b"<nav ", b"<NAV>", b"</nav>", b"</nav >", b"<script>", b"</script\n>", b"<!--", b"-->", b"<", b">", b"a b", b"<p>", b"<head>", b"</HEAD>", b"<navy>"]


def test_equals_plain_patterns():
    rng = random.Random(0)
    for _ in range(3000):
        page = b"".join(rng.choices(PIECES, k=rng.randint(0, 14)))
        assert visible(page) == b" ".join(re.sub(rb"<[^>]*>", b" ", SKIPPED.sub(b" ", page)).split())


@pytest.mark.parametrize("piece", [b"<nav ", b"<", b"<!--", b"<nav></nav", b"<script><", b"<p>"])
def test_long_odd_pages_take_linear_time(piece):
    begun = time.perf_counter()
    visible(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - begun < 5
