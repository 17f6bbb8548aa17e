"""From raw documents to the shards of a training run: five stages, each an operator of ``shopbank.llm``.

Each stage works on all rows that the one before kept, written as Parquet and read again. Rows are kept or dropped as the
operators' docstrings define for nulls, empty texts and repeated rows; extra columns pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopbank.llm import decontamination, mixing, near_dedup, quality, sharding
from shopbank.llm.scratch import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that fail the base rule or lose too much text go."""
    return quality.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are benchmark phrases go."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share asks for."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the column ``shard``."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("shards", shards),
]

#: Shards of minimax capacity can't be said in one SQL statement. tests/llm/test_pipeline_rows.py holds run() against a brute-force chain.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
