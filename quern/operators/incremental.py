"""Fingerprints, diffs and the folds of operational state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def diff(old: DataFrame, new: DataFrame, id_col: str = "doc_id", print_col: str = "fingerprint") -> DataFrame:
    """id, change (added, changed, vanished): a full outer compare."""
    a, b = old.select(id_col, F.col(print_col).alias("_a")), new.select(id_col, F.col(print_col).alias("_b"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "vanished").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, id_col, "full_outer").select(id_col, change.alias("change")).where("change is not null")


def merge(old: DataFrame, new: DataFrame, changes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """old without changed and vanished rows, with the changed and added rows of new."""
    return old.join(changes, id_col, "left_anti").unionByName(new.join(changes.where("change <> 'vanished'"), id_col, "left_semi"))


def corpus_fingerprint(docs: DataFrame, id_col: str, print_col: str) -> DataFrame:
    """One row: combined without regard to order or to one task. The sum of 64-bit prints is exact in decimal."""
    h = F.xxhash64(id_col, print_col).cast("decimal(38,0)")
    return docs.agg(F.count("*").alias("n"), F.sum(h).alias("fingerprint"))


def validator_fold(log: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """key, confirms: how many times in a row the last value was seen again; a fold of a state machine as gaps and islands."""
    w = Window.partitionBy(key).orderBy(order)
    changed = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1)
    island = log.withColumn("_c", changed).withColumn("_i", F.sum("_c").over(w))
    return island.groupBy(key, "_i").agg(F.count("*").alias("n"), F.max(F.struct(order, value)).alias("x")).groupBy(key).agg(F.max_by(F.struct("n", "x"), "_i").alias("y")).select(key, (F.col("y.n") - 1).alias("confirms"), F.col(f"y.x.{value}").alias("last_value"))


def due(state: DataFrame, checked: str, id_col: str, limit: int) -> DataFrame:
    """The rows checked longest ago, never checked ones first."""
    return state.orderBy(F.col(checked).asc_nulls_first(), id_col).limit(limit)


def backing_off(failed_at: Column, now: Column, days: int = 7) -> Column:
    return F.coalesce(F.datediff(now, failed_at) < days, F.lit(False))


def must_hash(size: Column, mtime: Column, known_size: Column, known_mtime: Column) -> Column:
    """Whether a file has to be read to know if it changed: unless its size and time are those of the last look."""
    return ~(size.eqNullSafe(known_size) & mtime.eqNullSafe(known_mtime))


def file_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def store_by_batches(stream: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """Drains a stream of rows (vectors, say) into folder, a batch at a time. A batch that is run again replaces its own files, and of a key that
    came twice the last batch's row counts."""
    from ..streaming.events import run_once

    w = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return run_once(stream, folder, "append").withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k", "part", "batch")


def fallback_counts(states: DataFrame, fmt: str = "format") -> DataFrame:
    """scans, by_local_ocr: how many PDFs are scans, and how many of those no cloud model has read."""
    scan = (F.col(fmt) == "pdf") & F.coalesce(F.col("is_scan"), F.lit(False))
    return states.agg(F.count_if(scan).alias("scans"), F.count_if(scan & F.col("ocr_model").isNull()).alias("by_local_ocr"))
