"""Candidates: scoring terms, validation, triage, response classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_count(text: Column, terms: list[str]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return sum((F.contains(low, F.lit(t)).cast("int") for t in terms), F.lit(0))


def slices(rows: DataFrame, home: Column, score: str, order: list[str], n: int) -> DataFrame:
    """All rows outside home, and the n best inside: UNION ALL of two slices."""
    best = rows.where(home).orderBy(F.desc(score), *order).limit(n).withColumn("slice", F.lit("probe"))
    return rows.where(~F.coalesce(home, F.lit(False))).withColumn("slice", F.lit("all")).unionByName(best)


def violations(rows: DataFrame, id_col: str, rules: dict[str, Column]) -> DataFrame:
    """id, rule: a row for each rule that holds."""
    found = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return rows.select(id_col, F.explode(found).alias("rule"))


def triage(candidates: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """The candidates' status after decisions: pending may be admitted or rejected, rejected may be revived; else it stays and is an error."""
    joined = candidates.join(decisions, key, "left")
    legal = ((F.col("status") == "pending") & F.col("action").isin("admit", "reject")) | ((F.col("status") == "rejected") & (F.col("action") == "revive"))
    to = F.when(F.col("action") == "admit", "admitted").when(F.col("action") == "reject", "rejected").when(F.col("action") == "revive", "pending")
    return joined.withColumn("new_status", F.when(F.coalesce(legal, F.lit(False)), to).otherwise(F.col("status"))).withColumn("illegal", F.col("action").isNotNull() & ~F.coalesce(legal, F.lit(False)))


def response_class(status: Column, body: Column) -> Column:
    """ok, empty, gone, blocked, retry or failed, from an HTTP status and body."""
    return (
        F.when(status.between(200, 299), F.when(F.length(F.coalesce(body, F.lit(""))) == 0, "empty").otherwise("ok"))
        .when(status.isin(404, 410), "gone").when(status.isin(401, 403, 451), "blocked").when((status == 429) | (status >= 500), "retry").otherwise("failed")
    )
