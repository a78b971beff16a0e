"""Sinks: partitioned overwrite, GraphML, review sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces the partitions that df has; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _escaped(c: Column) -> Column:
    c = c.cast("string")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """A folder of text parts that make a GraphML document one after another: head, nodes, edges, tail."""
    n = nodes.select(F.lit(1).alias("part"), F.concat(F.lit('<node id="'), _escaped(F.col("id")), F.lit('"><data key="ntype">'), _escaped(F.col("ntype")), F.lit("</data></node>")).alias("value"))
    e = edges.select(F.lit(2).alias("part"), F.concat(F.lit('<edge source="'), _escaped(F.col("src")), F.lit('" target="'), _escaped(F.col("dst")), F.lit('"><data key="etype">'), _escaped(F.col("etype")), F.lit("</data></edge>")).alias("value"))
    spark = nodes.sparkSession
    head = '<?xml version="1.0" encoding="UTF-8"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns"><key id="ntype" for="node" attr.name="ntype" attr.type="string"/><key id="etype" for="edge" attr.name="etype" attr.type="string"/><graph edgedefault="directed">'
    ends = spark.createDataFrame([(0, head), (3, "</graph></graphml>")], "part int, value string")
    ends.unionByName(n).unionByName(e).repartitionByRange("part", "value").sortWithinPartitions("part", "value").select("value").write.mode("overwrite").text(path)


def write_once(df: DataFrame, path: str) -> None:
    """Writes a table that must not be there yet."""
    df.write.mode("errorifexists").parquet(path)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new, and those of old that new has no key of."""
    return old.join(new, keys, "left_anti").unionByName(new.dropDuplicates(keys))


def without_nulls(df: DataFrame, key: str) -> DataFrame:
    """key, state: the other columns as JSON, null ones left out, as a state file has them."""
    return df.select(key, F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("state"))


def shard_name(connector: Column) -> Column:
    return F.regexp_replace(connector, "[^A-Za-z0-9_-]", "__")


def save_shards(candidates: DataFrame, path: str, connector: str = "connector_id") -> None:
    """Candidates by shard; shards that are empty now go. An error if two connectors have one shard's name."""
    named = candidates.withColumn("shard", shard_name(F.col(connector)))
    twice = named.groupBy("shard").agg(F.min(connector).alias("a"), F.max(connector).alias("b")).where("a <> b").first()
    if twice is not None:
        raise ValueError(f"{twice['a']} and {twice['b']} share the shard {twice['shard']}")
    named.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("shard").parquet(path)


def front_matter(fields: dict[str, Column]) -> Column:
    """A block of fields between rules, empty ones left out."""
    lines = [F.when(F.coalesce(c.cast("string"), F.lit("")) != "", F.concat(F.lit(f"{name}: "), c.cast("string"))) for name, c in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"))


def markdown_cell(c: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"[ \t\r\n]+", " ")


def worksheet(pending: DataFrame, unacquirable: DataFrame, order: list[str], limit: int) -> DataFrame:
    """section, total, rows: the first rows of each section as JSON in order, and how many there are before the limit."""
    def part(name: str, df: DataFrame) -> DataFrame:
        top = df.orderBy(*order).limit(limit)
        rows = F.transform(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], F.to_json(F.struct(*df.columns)).alias("_json")))), lambda x: x["_json"])
        return top.agg(rows.alias("rows")).withColumn("_one", F.lit(1)).join(df.agg(F.count("*").alias("total")).withColumn("_one", F.lit(1)), "_one").select(F.lit(name).alias("section"), "total", "rows")

    return part("pending", pending).unionByName(part("unacquirable", unacquirable))


def joined_parts(parts: DataFrame, header: str, key: str) -> DataFrame:
    """key, text: the pages of OCR batches (key, header, first_page, text) whose header is the run's, in order of pages."""
    own = parts.where(F.col("header") == header)
    return own.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first_page", "text"))), lambda x: x["text"]), "\n\n").alias("text"))
