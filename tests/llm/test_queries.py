"""Registered queries of the subpackage against their SQL, and the pipeline, on the smallest tables."""

import pytest

import corpus_pipeline
from checks.compare import connect, difference
from shopbank.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, name):
    text, count = difference(spark, connect(FOLDER), FOLDER, name)
    assert text == "" and count > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = corpus_pipeline.run(spark, FOLDER).cache()
    assert set(docs.columns) | {"shard"} == set(got.columns) and got.count() > 0
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "benchmark decontamination", "source mix", "shards"]
    rejected = QUERIES["op8_line_quality"](spark, FOLDER).where("not kept").select("doc_id")
    assert got.join(rejected, "doc_id").count() == 0


def test_stages_take_empty_tables_and_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20)
    odd = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, None, None, None, None)], docs.schema))
    for frame in (odd, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, FOLDER).cache()
            frame.count()
