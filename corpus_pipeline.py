"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm.common import stored
from spanloom.llm.decontaminate import drop_leaks
from spanloom.llm.mixing import mix
from spanloom.llm.quality import keep_good
from spanloom.llm.secrets import redact_secrets
from spanloom.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of exact and near copies."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark, n_chars counted again."""
    return redact_secrets(docs, count_col="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of each document."""
    return mix(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("mixing", mixing)]

#: SQL can't express the classifier; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the last stage returns for the ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
