"""Extra columns whose names could clash with those of a stage."""

from shopbank.llm import decontamination, near_dedup, quality


def test_near_duplicates_take_any_column_names(spark):
    text = "one two three four five six seven eight nine ten"
    docs = [(1, text, 1), (2, text, 2), (2, text, 2), (3, None, 3), (4, "another text of some words that stands alone here", 4), (1, text, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n int")
    odd = frame.selectExpr("*", "n as __rows", "n as id", "text as key", "n as `a.b`", "n as document", "n as __text", "n as component_id")
    got = near_dedup.deduplicated(odd)
    assert got.columns == odd.columns
    assert sorted((r["doc_id"], r["a.b"], r["document"]) for r in got.collect()) == [(1, 1, 1), (3, 3, 3), (4, 4, 4)]


def test_quality_and_decontamination_take_any_column_names(spark):
    text = "One plain sentence of more than ten words stands here alone for once."
    frame = spark.createDataFrame([(1, text, 5), (2, "short", 5)], "doc_id long, text string, n_chars long")
    odd = frame.selectExpr("*", "doc_id as `a.b`", "text as c1", "n_chars as `c 2`")
    kept = quality.cleaned(odd)
    assert kept.columns == odd.columns and [tuple(r) for r in kept.collect()] == [(1, text, len(text), 1, text, 5)]
    benchmark = spark.createDataFrame([("i", "short")], "item_id string, text string")
    clean = decontamination.decontaminated(odd, benchmark)
    assert clean.columns == odd.columns and [r["a.b"] for r in clean.collect()] == [1]
