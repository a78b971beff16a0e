"""Sources: registries of YAML records, CSV registries, JSON dumps, text documents."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "id string, entity_id string, track string, title string, issuer string, issuer_type string, geo_scope string, language string, doc_type string, authority string, source_url string, source_format string, sensitivity string, topics array<string>, published date, updated date, effective date, path string"


def registry(spark: SparkSession, root: str, pattern: str = "meta.yaml") -> DataFrame:
    """Records of all files of that name below root; one file a record."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content")
    plain = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"], strict=True):
                r = yaml.safe_load(content) or {}
                dates = r.get("dates") or {}
                rows.append({c: r.get(c) for c in plain} | {k: dates.get(k) for k in ("published", "updated", "effective")} | {"path": path})
            yield pd.DataFrame(rows, columns=plain)

    return files.mapInPandas(run, RECORD)


def layout_errors(records: DataFrame) -> DataFrame:
    """id, error: folders that differ from the record's fields, and ids that occur twice."""
    parts = F.split("path", "/")
    differs = (F.element_at(parts, -2) != F.col("id")) | (F.element_at(parts, -3) != F.col("entity_id")) | (F.element_at(parts, -4) != F.col("track"))
    twice = records.groupBy("id").count().where("count > 1").select("id", F.lit("duplicate id").alias("error"))
    return records.where(differs).select("id", F.lit("path differs").alias("error")).unionByName(twice)


def csv_registry(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def json_dump(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def text_documents(spark: SparkSession, root: str, pattern: str = "*.md") -> DataFrame:
    """path, text: whole files."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
