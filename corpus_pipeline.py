"""A training corpus from raw documents: toxic texts go, near copies go, personal data is
masked, sources are mixed to their weights, texts become token ids.

Every stage gets the rows its predecessor kept, as Parquet, and works on all of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.llm import bpe, mixing, near_dup, pii, toxicity
from cartlake.session import workspace

#: rows that go to Python at a time: batches of thousands of whole texts, twice each, take an executor hundreds of MB
ARROW_ROWS = 256
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: None: the toxicity model and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(_ARROW, ARROW_ROWS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.train(toxicity.labelled_rows(docs, labels)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(_ARROW, ARROW_ROWS)
    return near_dup.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.repeat(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(_ARROW, ARROW_ROWS)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                      tables=bpe.SMALL_TABLES)


STAGES = [("toxicity", drop_toxic), ("near_dup", drop_near_copies), ("pii", mask_personal_data),
          ("mixing", mix_sources), ("bpe", encode)]


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(_ARROW)
    try:
        for name, stage in STAGES:
            path = workspace(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        spark.conf.set(_ARROW, before)
    return docs
