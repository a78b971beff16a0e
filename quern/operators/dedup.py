"""First-seen-wins deduplication, by one key or by several strategies in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import cut


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """The earliest row of each key; rows without a key stay. A grouped minimum and a join, so a key may hold any share of the rows."""
    least = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(order).alias("_o"))
    return df.join(least, (df[key] == F.col("_k")) & (df[order] == F.col("_o")), "left_semi").unionByName(df.where(F.col(key).isNull()))


def rank_duplicates(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.withColumn("dup_rank", F.row_number().over(Window.partitionBy(key).orderBy(order)))


def multi_strategy(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """ordinal, kept_ordinal by the sequential rule: a row is absorbed by the earliest kept row that shares its first matching key, and an
    absorbed row absorbs nothing; order tells rows apart. In rounds: a row that is the first undecided one under all its keys is kept,
    and those after it under any of them are absorbed. Only minima are gathered by key, so a key may hold any share of the rows."""
    present = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.struct(F.lit(i).alias("rank"), F.col(k).cast("string").alias("value"))) for i, k in enumerate(keys)]))
    each = cut(df.select(F.col(order).alias("ordinal"), F.explode(present).alias("k")))
    left, owned = each, []
    while not left.isEmpty():
        least = left.groupBy("k").agg(F.min("ordinal").alias("first"))
        kept = left.join(least, "k").groupBy("ordinal").agg(F.min(F.col("first") == F.col("ordinal")).alias("all")).where("all").select("ordinal")
        owners = cut(left.join(kept, "ordinal", "left_semi").select("k", F.col("ordinal").alias("owner")))
        owned.append(owners)
        decided = left.join(owners.select("k"), "k", "left_semi").select("ordinal").distinct()
        left = cut(left.join(decided, "ordinal", "left_anti"))
    rows = df.select(F.col(order).cast("long").alias("ordinal"))
    if not owned:
        return rows.withColumn("kept_ordinal", F.col("ordinal"))
    union = owned[0]
    for x in owned[1:]:
        union = union.unionByName(x)
    absorbed = each.join(union, "k").where("owner < ordinal").groupBy("ordinal").agg(F.min(F.struct("k.rank", "owner"))["owner"].alias("owner"))
    return rows.join(absorbed, "ordinal", "left").select("ordinal", F.coalesce("owner", "ordinal").cast("long").alias("kept_ordinal"))


def ambiguous_owner(df: DataFrame, key: str, owner: str) -> DataFrame:
    """Keys with more than one distinct owner."""
    return df.groupBy(key).agg(F.countDistinct(owner).alias("n_owners")).where("n_owners > 1")


def unique_owner(df: DataFrame, key: str, owner: str) -> DataFrame:
    """Keys with exactly one owner, and the owner."""
    return df.groupBy(key).agg(F.min(owner).alias("owner"), F.max(owner).alias("_m")).where("owner = _m").drop("_m")


def group_first(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first non-null value of each column in order."""
    rank = F.struct(*order)
    return df.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns])
