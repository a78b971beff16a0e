"""Documents as lines: fences, headings, breadcrumbs, runs, forward fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, pos, line."""
    return docs.select(id_col, F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("pos", "line"))


def _before(id_col: str):
    return Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)


def fenced(ls: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds in_fence, by the parity of fence lines so far."""
    mark = F.when(F.col("line").startswith("```"), 1).otherwise(0)
    return ls.withColumn("in_fence", (F.sum(mark).over(_before(id_col)) % 2 == 1) | (mark == 1))


def headings(ls: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds level and title; null where a line is no heading."""
    level = F.length(F.regexp_extract("line", r"^(#{1,6})[ \t]+[^ \t]", 1))
    own = ls if "in_fence" in ls.columns else fenced(ls, id_col)
    is_heading = (level > 0) & ~F.col("in_fence")
    title = F.btrim(F.regexp_replace("line", r"^#{1,6}[ \t]+", ""), F.lit(" \t#"))
    return own.withColumn("level", F.when(is_heading, level)).withColumn("title", F.when(is_heading, title))


def breadcrumbs(ls: DataFrame, id_col: str = "doc_id", sep: str = " › ") -> DataFrame:
    """Adds the path of headings above each line: of each level the last one, kept if no higher level came after it."""
    w = _before(id_col)
    own = headings(ls, id_col)
    for n in range(1, 7):
        own = own.withColumn(f"_h{n}", F.last(F.when(F.col("level") == n, F.struct("pos", "title")), ignorenulls=True).over(w))
    parts = []
    for n in range(1, 7):
        higher = [F.coalesce(F.col(f"_h{m}.pos"), F.lit(-1)) for m in range(1, n)]
        live = F.lit(True) if not higher else F.col(f"_h{n}.pos") > (F.greatest(*higher) if len(higher) > 1 else higher[0])
        parts.append(F.when(F.coalesce(live, F.lit(False)) & F.col(f"_h{n}").isNotNull(), F.col(f"_h{n}.title")))
    return own.withColumn("breadcrumb", F.concat_ws(sep, *parts)).drop(*[f"_h{n}" for n in range(1, 7)])


def runs(df: DataFrame, key: str, order: str, match: Column, least: int) -> DataFrame:
    """key, start, stop, n: runs of at least so many consecutive matching rows."""
    w = Window.partitionBy(key).orderBy(order)
    island = F.sum(F.when(match, 0).otherwise(1)).over(w)
    marked = df.select(key, order, match.alias("_m"), island.alias("_i")).where("_m")
    return marked.groupBy(key, "_i").agg(F.min(order).alias("start"), F.max(order).alias("stop"), F.count("*").alias("n")).where(F.col("n") >= least).drop("_i")


def forward_fill(df: DataFrame, key: str, order: str, value: Column) -> DataFrame:
    return df.withColumn("filled", F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def next_nonblank(ls: DataFrame, id_col: str = "doc_id") -> DataFrame:
    w = Window.partitionBy(id_col).orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    return ls.withColumn("next_line", F.first(F.when(F.btrim("line") != "", F.col("line")), ignorenulls=True).over(w))


def sessions(df: DataFrame, key: str, order: str, gap: Column) -> DataFrame:
    """Adds session, a counter that grows where gap holds between a row and the one before it."""
    return df.withColumn("session", F.sum(F.when(gap, 1).otherwise(0)).over(Window.partitionBy(key).orderBy(order)))
