"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.llm import decontaminate, mixing, quality, sharding, simhash_dedup
from barstream.llm.common import id_bucket, table
from barstream.session import staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects; learnt from labels of documents that are left."""
    allowed = id_bucket(F.col("doc_id"), 4) != 2
    ranking = quality.fit_quality(docs, table(spark, sf_dir, "labels"), allowed)
    return quality.keep_quality(docs, ranking)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of near copies."""
    return simhash_dedup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents up to its target, repeated where it is larger."""
    return mixing.mix_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the mixed documents out to 24 shards of near equal bytes."""
    return sharding.shard_documents(docs, shards=24)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mix", mixing_stage),
    ("sharding", sharding_stage),
]

#: Learnt scores and hashes have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
