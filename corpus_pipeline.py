"""From raw documents to shards of training text, one Spark job a stage.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result is written and read again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import decontamination, mixing, neardup, quality, sharding
from vitrine.llm.storage import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the rules go, and documents that lose too much with them."""
    return quality.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near-duplicates stays, that of the least id."""
    return neardup.distinct_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shards),
]

#: SQL cannot express the near-duplicate stage; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
