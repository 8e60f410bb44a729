"""A corpus pipeline: language, copies, near copies, benchmark leaks, mix.

Each stage works on all documents that its predecessor kept; all but the last return the columns of
documents. Between stages the documents lie as Parquet in the folder that all executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duelmetrics.llm import decontaminate, exact_dedup, language_id, mixing, near_dedup, warc
from duelmetrics.llm.common import table
from duelmetrics.sources.scratch import scratch_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, keep="largest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_mix(docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_leaks),
    ("mixing", mixed),
]

#: Near copies, leaks and language models can't be put into SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the documents in sf_dir.

    Its rows lie in a shared scratch folder until the session ends; what led to them is removed as soon as
    the next stage is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            warc.remove(spark, before)
        before = path
    return docs
