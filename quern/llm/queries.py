"""Queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, html, quality, quality_rules, secrets, simhash, substr, toxicity, warc
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substr.digest(table(spark, sf_dir, "documents"))


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_substring_dedup, op3_html_main_text, op4_simhash, op5_warc, op6_decontamination, op7_quality_rules, op8_quality_classifier, op9_bpe, op10_toxicity)}


def oracle_sql() -> dict[str, str]:
    return {"op6_decontamination": decontam.ORACLE_SQL, "op7_quality_rules": quality_rules.ORACLE_SQL}
