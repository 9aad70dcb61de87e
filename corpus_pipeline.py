"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

All stages keep every column of docs as it is, whatever its name, and take nulls in any of them. Null
and empty texts are clean, have no copies and leak nothing, but the mix takes them 0 times. Null ids
stand for rows without copies. Rows that repeat are each judged; the mix decides them one by one. An
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import decontam, minhash, mixing, sharding, toxicity
from spanloom.llm.storage import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go; null and empty texts and null ids stay."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays,
    with all its rows if it repeats; null ids and wordless texts stay."""
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go, substitutions tolerated; null and empty texts stay."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; texts without words not at all, null sources
    are one source."""
    return mixing.mixed_copies(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard; columns named like the three that are added are replaced."""
    return sharding.assign_shards(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL cannot express the fitted scores and the seeded draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
