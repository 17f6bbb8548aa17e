"""License texts that are repeated, interrupted, or near to one another."""

import numpy as np

from shopbank.llm import license_scan

INDEX = license_scan.Index(license_scan.TEMPLATES)


def found(text):
    return license_scan.found_licenses(text.encode(), INDEX, license_scan.Names())


def test_each_of_close_repeats():
    got = found("All rights reserved.\n" * 10)
    assert [(r["license"], r["start_word"], r["end_word"]) for r in got] == [("all-rights-reserved", 3 * k, 3 * k + 3) for k in range(10)]


def test_long_insertions():
    words = license_scan.TEMPLATES["MIT"][1].split()
    text = " ".join(words[:55] + [f"in{k}" for k in range(30)] + words[55:])
    got = found(text)
    assert [r["license"] for r in got] == ["MIT"] and got[0]["coverage"] == 1.0 and got[0]["end_byte"] >= len(text) - 1


def test_neighbours_are_told_apart():
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    cases = [
        (gnu.format("", 2), "GPL-2.0"), (gnu.format("", 3), "GPL-3.0"), (gnu.format("Library ", 2), "LGPL-2.0"), (gnu.format("Affero ", 3), "AGPL-3.0"), (gnu.format("Lesser ", 3), "LGPL-3.0"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
    ]
    for text, name in cases:
        assert [r["license"] for r in found(text)] == [name]
    assert found(gnu.format("", 1)) == [] and found("Licensed under CC BY-SA 3.0.") == []


def test_texts_end_with_their_warranty():
    for name, end in (
        ("MIT", "DEALINGS IN THE SOFTWARE."), ("ISC", "PERFORMANCE OF THIS SOFTWARE."), ("BSD-2-Clause", "SUCH DAMAGE."), ("BSD-3-Clause", "SUCH DAMAGE."),
    ):
        text = license_scan.TEMPLATES[name][-1]
        assert text.endswith(end) and [(r["license"], r["end_byte"]) for r in found(text)] == [(name, len(text) - 1)]


def plain_alignment(template, words, diagonal):
    """The best local alignment in the band, cell by cell."""
    m, width = len(template), 2 * license_scan.BAND + 1
    score, step, best = {}, {}, (0, 0, 0)
    for i in range(1, m + 1):
        for k in range(1, width + 1):
            j = diagonal + i + k - 2 - license_scan.BAND
            if 0 <= j < len(words):
                gain = 2 if template[i - 1] == words[j] else -1
                ways = [(score.get((i - 1, k), 0) + gain, 1), (score.get((i - 1, k + 1), 0) - 1, 2), (score.get((i, k - 1), 0) - 1, 3), (0, 0)]
                score[i, k], step[i, k] = max(ways, key=lambda x: x[0])
                if score[i, k] > best[0]:
                    best = score[i, k], i, k
    _, i, k = best
    out = []
    while step.get((i, k)):
        kind, j = step[i, k], diagonal + i + k - 2 - license_scan.BAND
        if kind == 1 and template[i - 1] == words[j]:
            out.append((i - 1, j))
        i, k = (i - 1, k) if kind == 1 else (i - 1, k + 1) if kind == 2 else (i, k - 1)
    return out[::-1]


def test_rows_of_the_alignment_equal_its_cells():
    rng = np.random.default_rng(0)
    for _ in range(60):
        template, words = rng.integers(1, 6, rng.integers(1, 30)).astype(np.uint64), rng.integers(0, 6, rng.integers(1, 60)).astype(np.uint64)
        diagonal = int(rng.integers(-40, 60))
        assert license_scan.aligned(template, words, diagonal) == plain_alignment(template, words, diagonal)
