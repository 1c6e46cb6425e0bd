"""The corpus pipeline: documents through five stages, each one of the numbered operators.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of documents. A stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotwise.llm import decontamination, mixing, neardup, quality, sharding
from slotwise.llm.common import DOCUMENT_COLUMNS, prepare, read
from slotwise.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the rules or the trees reject."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, model).where("kept").select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of exact and near copies."""
    return neardup.unique_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, one row for each piece of a document that a slot takes."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal all rows out to forty shards of near equal bytes."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# Trees, fingerprints and draws have no SQL form; tests/llm checks every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
