"""Documents to training shards: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from pulseframe.llm import decontam, langid, minhash, mixing, sharding
from pulseframe.sources.staging import stage

SHARDS = 40


def _stored(docs: DataFrame) -> bool:
    """Whether rows have places in Parquet files, as the tables between stages do."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language."""
    return langid.keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: shingles of five words, similarity 0.8."""
    return minhash.keep_first(docs, stored=_stored(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share asks for."""
    return mixing.mixed_documents(docs, stored=_stored(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row whole with size, text_crc32, shard and slot, so that shards can be written by these two."""
    return sharding.sharded_documents(docs, SHARDS, stored=_stored(docs))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", deduplicate),
    ("benchmark_passages", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: No SQL: a trained model and edit distances decide. Tests hold near duplicates and benchmark
#: passages against brute force, and the other stages by what they must keep and how often.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
