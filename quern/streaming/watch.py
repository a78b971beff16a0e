"""A watched folder: files as they arrive, and which one is the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.acquire import LEAST, PDF

SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arrivals(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """A stream of path, modificationTime, length and content; files that are still written have other names."""
    return spark.readStream.format("binaryFile").schema(SCHEMA).option("pathGlobFilter", pattern).load(folder)


def valid(files: DataFrame, matches: Column | None = None) -> DataFrame:
    """The files that begin like a PDF, are large enough, and fulfil the condition."""
    own = files.where((F.substring("content", 1, 4) == F.lit(PDF).cast("binary")) & (F.col("length") >= LEAST["pdf"]))
    return own if matches is None else own.where(matches)


def choose(files: DataFrame, matches: Column | None = None) -> tuple[str, str | None]:
    """accepted and its path, conflict, or waiting: exactly one valid file is taken, of several none is guessed."""
    found = [r["path"] for r in valid(files, matches).select("path").limit(2).collect()]
    return ("waiting", None) if not found else ("accepted", found[0]) if len(found) == 1 else ("conflict", None)
