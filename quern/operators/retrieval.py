"""Rank fusion and facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RRF_K, POOL = 60, 50


def ranked(channel: DataFrame, id_col: str, pool: int = POOL) -> DataFrame:
    """id, rank of the best rows of a channel. The pool is cut before it is ranked: the window sees pool rows."""
    best = channel.orderBy(F.desc("score"), id_col).limit(pool)
    return best.select(id_col, F.row_number().over(Window.orderBy(F.desc("score"), id_col)).alias("rank"))


def rrf(channels: list[DataFrame], id_col: str, k: int = 20, rrf_k: int = RRF_K, pool: int = POOL) -> DataFrame:
    """id, rrf: sums of 1 / (rrf_k + rank) over channels; a row may miss from some."""
    parts = [ranked(c, id_col, pool).select(id_col, (1.0 / (rrf_k + F.col("rank"))).alias("part")) for c in channels]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy(id_col).agg(F.round(F.sum("part"), 9).alias("rrf")).orderBy(F.desc("rrf"), id_col).limit(k)


def facet_filter(docs: DataFrame, equal: dict[str, list], topics: DataFrame | None = None, topic: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """Rows whose facets are in the given lists, and that have a topic."""
    for col, values in equal.items():
        docs = docs.where(F.col(col).isin(values))
    return docs if topics is None else docs.join(topics.where(F.col("topic") == topic).select(id_col).distinct(), id_col, "left_semi")


def superseded_gate(docs: DataFrame, superseded: Column, include: bool = False) -> DataFrame:
    """Without superseded rows, unless they are asked for; unknown counts as not superseded."""
    return docs if include else docs.where(~F.coalesce(superseded, F.lit(False)))
