"""Line deduplication against a brute-force version on literal rows."""

from collections import defaultdict

from shopbank.llm.line_dedup import WHITE, without_common_lines
from tests.conftest import rows

LOW = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(WHITE).translate(LOW)


def brute(docs, min_chars, min_docs):
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            held = holders.get(key(line), ())
            last = max((x for x in held if x is not None), default=None)
            if len(held) < min_docs or i == last:
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


COMMON = "A line that very many documents share"
DOCS = [
    (1, f"{COMMON}\nfirst of its own, long enough to count\n\n{COMMON.upper()}  "),
    (2, f"\t{COMMON.lower()}\x0b\nsecond"),
    (3, COMMON),
    (4, f"x\n{COMMON}\r\n{COMMON}"),
    (5, None),
    (6, ""),
    (7, "\n\n"),
    (8, "Élan vital, zwölf Zeichen\nélan vital, zwölf zeichen"),
    (9, "Élan vital, zwölf Zeichen\na pair of documents has this"),
    (10, "Élan vital, zwölf zeichen\na pair of documents has this"),
    (11, "nineteen characters"),
    (12, "nineteen characters"),
    (13, "nineteen characters"),
    (14, " no-break spaces stay here"),
    (15, "no-break spaces stay here"),
    (16, "no-break spaces stay here"),
    (None, f"{COMMON}\nwithout an id"),
    (None, "without an id\nbut another text of some length"),
    (3, COMMON),
    (3, "the same id with another text\nthe same id with another text"),
    (2, f"\t{COMMON.lower()}\x0b\nsecond"),
]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_equals_brute_force(spark):
    for chars, least in ((20, 3), (5, 2), (0, 2), (20, 1)):
        assert rows(without_common_lines(frame(spark, DOCS), chars, least)) == brute(DOCS, chars, least)


def test_keeps_lines_of_the_largest_id_alone(spark):
    got = {r[0]: r for r in without_common_lines(frame(spark, DOCS[:4])).collect()}
    assert got[4][2] == 0 and got[3][2:] == (1, "") and got[1][2] == 2


def test_very_long_text_and_hot_line(spark):
    hot = [(i, f"{COMMON}\nown line of document number {i}") for i in range(300)]
    long = [(1000, "\n".join(f"line {i % 5000} of a very long text" for i in range(60_000))), (1001, "\n".join([COMMON] * 30_000))]
    docs = hot + long
    assert rows(without_common_lines(frame(spark, docs))) == brute(docs, 20, 3)


def test_empty_table_and_clashing_columns(spark):
    assert without_common_lines(frame(spark, [])).collect() == []
    odd = spark.createDataFrame(
        [(1, COMMON, "a", 1), (2, COMMON, "b", 2), (3, COMMON, "c", 3)], "doc_id long, text string, `h1` string, `a.b` int"
    )
    odd = odd.selectExpr("*", "`a.b` as last", "h1 as lines", "h1 as gone", "h1 as place", "h1 as key", "h1 as text_key")
    assert [r[2] for r in sorted(without_common_lines(odd).collect())] == [1, 1, 0]


def test_no_python_in_the_plan(spark):
    plan = without_common_lines(frame(spark, DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
