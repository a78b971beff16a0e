"""Markers in a document's text, written and recognised in one place, and the figures they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunking import CLOSES, OPENS

REGION = r"^> \[Figure, p\. (\d+), region ([0-9a-f]{12})"


def opened(head: Column, model: Column) -> Column:
    return F.concat(F.lit("> ["), head, F.lit(" — VLM interpretation ("), model, F.lit("); reconstruction, verify against original]"))


def closed(address: Column) -> Column:
    return F.concat(F.lit("> [/VLM interpretation "), address, F.lit("]"))


def opens(line: Column) -> Column:
    return F.btrim(line).rlike(OPENS)


def closes(line: Column) -> Column:
    return F.btrim(line).rlike(CLOSES)


def region_block(page: Column, region: Column, labels: Column) -> Column:
    """The marker of a region, and the labels in it."""
    head = F.concat(F.lit("> [Figure, p. "), page.cast("string"), F.lit(", region "), region, F.lit("]"))
    return F.when(F.size(labels) > 0, F.concat(head, F.lit("\n> Labels: "), F.array_join(labels, "; "))).otherwise(head)


def marked_regions(lines: DataFrame, regions: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The lines that name a region, with it: by document, page and id."""
    named = lines.select("*", F.regexp_extract("line", REGION, 1).alias("_p"), F.regexp_extract("line", REGION, 2).alias("region")).where("region <> ''")
    return named.withColumn("page", F.col("_p").cast("int")).drop("_p").join(regions, [doc, "page", "region"], "left")


def split_citations(sections: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links and leads of cached citations, and the sections that have none yet: sections (doc_id, body), cache (digest, citations
    array<struct<title,url>>). A citation counts only if its title is in the section word for word."""
    from .gates import verbatim

    own = sections.withColumn("digest", F.sha2("body", 256)).join(cache, "digest", "left")
    each = own.select("doc_id", "body", F.explode("citations").alias("c")).where(verbatim(F.col("c.title"), F.col("body"))).select("doc_id", "c.title", "c.url")
    return each.where("url is not null"), each.where("url is null").select("doc_id", "title"), own.where("citations is null").select("doc_id", "body", "digest")


def batched(rows: DataFrame, key: str, order: str, size: str, count: int = 20, most: int = 8 << 20) -> DataFrame:
    """key, order, batch: rows in order in batches of up to count rows and most bytes; a row over that is a batch of its own. A key is a
    document, whose pages are few."""
    state = lambda out, n, total, b: F.struct(out.alias("out"), n.alias("n"), total.alias("total"), b.alias("b"))
    items = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(size).cast("long").alias("s"))))

    def step(a: Column, x: Column) -> Column:
        new = (a["n"] > 0) & ((a["n"] >= count) | (a["total"] + x["s"] > most))
        b = a["b"] + F.when(new, 1).otherwise(0)
        return state(F.concat(a["out"], F.array(F.struct(x["o"].alias("o"), b.alias("b")))), F.when(new, 1).otherwise(a["n"] + 1), F.when(new, x["s"]).otherwise(a["total"] + x["s"]), b)

    kind = dict(rows.dtypes)[order]
    empty = state(F.array().cast(f"array<struct<o:{kind},b:int>>"), F.lit(0), F.lit(0).cast("long"), F.lit(0))
    grouped = rows.groupBy(key).agg(items.alias("_i")).select(key, F.explode(F.aggregate("_i", empty, step, lambda a: a["out"])).alias("x"))
    return grouped.select(key, F.col("x.o").alias(order), F.col("x.b").alias("batch"))
