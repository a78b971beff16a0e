"""A training-data pipeline out of the operators in quern.llm: each stage is written as Parquet and read by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.llm import bpe, decontam, quality, secrets, simhash
from quern.llm.common import remove_at_exit, shared_dir, table
from quern.llm.queries import tokenizer_path

#: Near-duplicates: words of a shingle and least similarity. Decontamination: one item with an occurring window is enough here.
SHINGLE, SIMILARITY = 5, 0.8
MIN_ITEMS = 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, SIMILARITY, shingle=SHINGLE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), min_items=MIN_ITEMS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.with_ids(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("bpe", bpe_stage),
]

#: Training and SimHash are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, and returns the last one's rows. What the stages wrote goes when the driver ends."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
