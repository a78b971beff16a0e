"""Jobs of several operators: discovery, indexing, search, rechecks, validation, reports. Each takes and gives tables; a part that fails is told as
a row and doesn't stop the others."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cluster import cut
from .functions import text as T
from .operators import acquire, chunking, discovery, evaluation, graph, incremental, index, lexical, mapping, retrieval, vector
from .sinks import files as sinks


class Connector(Protocol):
    """A source of candidates (source_url, title and more); it gives its whole view, what is new is for discover() to say."""

    id: str
    enabled: bool

    def discover(self, spark: SparkSession) -> DataFrame: ...


class Registry:
    """Connectors by id; two of one id are an error."""

    def __init__(self) -> None:
        self.connectors: dict[str, Connector] = {}

    def register(self, connector: Connector) -> None:
        if connector.id in self.connectors:
            raise ValueError(f"{connector.id} is there already")
        self.connectors[connector.id] = connector

    def enabled(self, only: Sequence[str] = ()) -> list[Connector]:
        return [c for c in self.connectors.values() if c.enabled and (not only or c.id in only)]


@dataclass
class Discovery:
    """All candidates with fresh, what each connector found, and the errors of those that failed."""

    candidates: DataFrame
    diagnostics: DataFrame
    errors: dict[str, str]


def discover(spark: SparkSession, existing: DataFrame, connectors: Sequence[Connector], columns: Sequence[str], order: str = "ordinal") -> Discovery:
    """Runs connectors one after another against what there is; of candidates with one URL, once normalized, the first is kept as fresh."""
    parts, errors = [existing.select(*columns, order).withColumn("connector_id", F.lit("existing"))], {}
    for c in connectors:
        try:
            parts.append(cut(c.discover(spark).select(*columns, order).withColumn("connector_id", F.lit(c.id))))
        except Exception as e:  # noqa: BLE001  a connector's failure is its own
            errors[c.id] = f"{type(e).__name__}: {e}".split("\n")[0][:300]
    all_ = cut(mapping.fresh(mapping.ordered_union(parts, order), T.normalize_url(F.col("source_url"))))
    return Discovery(all_, mapping.diagnostics(all_.where("connector_id <> 'existing'"), "connector_id"), errors)


def build_index(docs: DataFrame, folder: str, embedder: index.Embedder, facets: Sequence[str] = (), budget: int = 512, count: Callable[[str], int] = chunking.count_words) -> None:
    """Writes chunks, facets, vectors and meta of documents (doc_id, text, facet columns) below folder; nothing if the texts are those it was
    built of."""
    spark = docs.sparkSession
    index.check_budget(budget, embedder.max_tokens)
    now = incremental.corpus_fingerprint(docs, "doc_id", "text").first()["fingerprint"]
    if not index.needs_rebuild(stored_fingerprint(spark, folder), str(now))[0]:
        return
    made = chunking.chunks(docs, budget, count)
    made = made.withColumn("content_hash", T.content_hash(F.col("text"), F.col("breadcrumb"))).withColumn("markup_heavy", chunking.markup_heavy(F.col("text")))
    made.write.mode("overwrite").parquet(f"{folder}/chunks")
    docs.select("doc_id", *facets).write.mode("overwrite").parquet(f"{folder}/facets")
    index.embedded(spark.read.parquet(f"{folder}/chunks"), embedder).write.mode("overwrite").parquet(f"{folder}/vectors")
    spark.createDataFrame([("fingerprint", str(now)), ("chunk_max_tokens", str(budget)), ("model", embedder.name)], "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/meta")


def stored_fingerprint(spark: SparkSession, folder: str) -> str | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/meta/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    row = spark.read.parquet(f"{folder}/meta").where("key = 'fingerprint'").first()
    return row["value"] if row else None


def search(spark: SparkSession, folder: str, query: str, embedder: index.Embedder | None = None, k: int = 20, equal: dict[str, list] | None = None) -> DataFrame:
    """doc_id, chunk_index, rrf, breadcrumb, snippet: the k best chunks by words and, with an embedder, by vectors, of documents with the facets."""
    chunks = spark.read.parquet(f"{folder}/chunks")
    if equal:
        chunks = chunks.join(retrieval.facet_filter(spark.read.parquet(f"{folder}/facets"), equal).select("doc_id"), "doc_id", "left_semi")
    keyed = chunks.withColumn("key", F.struct("doc_id", "chunk_index"))
    channels = [lexical.search(keyed, query, "key")]
    if embedder is not None:
        q = [float(x) for x in embedder.embed([query], "query")[0]]
        vectors = spark.read.parquet(f"{folder}/vectors").where(F.col("model") == embedder.name)
        best = vector.cosine_topk(vectors.join(chunks.select("content_hash").distinct(), "content_hash", "left_semi"), q, retrieval.POOL, "content_hash", "vec")
        channels.append(best.join(keyed.select("content_hash", "key"), "content_hash").select("key", "score"))
    hits = retrieval.rrf(channels, "key", k).select("key.doc_id", "key.chunk_index", "rrf")
    found = index.hydrated(hits, chunks, ["doc_id", "chunk_index"], ["breadcrumb", "text"])
    return found.select("doc_id", "chunk_index", "rrf", "breadcrumb", index.marked_snippet(F.col("text"), query).alias("snippet")).orderBy(F.desc("rrf"), "doc_id", "chunk_index")


def recheck(state: DataFrame, probes: DataFrame, fmt: str = "format", today: date | None = None) -> DataFrame:
    """The state table after probes of some of its documents: verdicts applied, the day of the check set; others stay. A probe without an
    outcome (error told) changes the day alone."""
    s, p = state.alias("s"), probes.alias("p")
    own = {c: F.col(f"s.{c}") for c in ("finding", "etag", "last_modified", "confirms", "fidelity")}
    seen = {c: F.col(f"p.{c}") for c in ("not_modified", "outcome", "reason", "etag", "last_modified")}
    day = F.current_date() if today is None else F.lit(today)
    v = acquire.recheck(own, seen, F.col(f"s.{fmt}"))
    judged = s.join(p, F.col("s.doc_id") == F.col("p.doc_id")).select(F.col("s.doc_id").alias("doc_id"), F.col(f"s.{fmt}").alias(fmt), F.col("s.fidelity").alias("fidelity"), (seen["outcome"].isNotNull() | seen["not_modified"]).alias("_ok"), v.alias("v"), *[own[c].alias(f"_{c}") for c in ("finding", "etag", "last_modified", "confirms")])
    fields = [F.when(F.col("_ok"), F.col(f"v.{c}")).otherwise(F.col(f"_{c}")).alias(c) for c in ("finding", "etag", "last_modified", "confirms")]
    new = judged.select("doc_id", fmt, "fidelity", *fields, day.alias("checked"))
    return sinks.upserted(state, new.select(*state.columns), ["doc_id"])


def validate(records: DataFrame, vocabulary: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """id, rule: all violations of the records (id, doc_type, relations): the rules', unknown document types, repeated ids, relations to nothing."""
    known = vocabulary.select(F.col("term").alias("doc_type")).distinct()
    each = records.select("id", F.explode("relations").alias("r"))
    parts = [
        discovery.violations(records, "id", rules), records.join(known, "doc_type", "left_anti").select("id", F.lit("unknown document type").alias("rule")),
        records.groupBy("id").count().where("count > 1").select("id", F.lit("duplicate id").alias("rule")),
        each.join(records.select(F.col("id").alias("target")).distinct(), F.col("r.target") == F.col("target"), "left_anti").select("id", F.lit("relation to nothing").alias("rule")),
    ]
    union = parts[0]
    for x in parts[1:]:
        union = union.unionByName(x)
    return union


def graph_report(nodes: DataFrame, edges: DataFrame, intervals: DataFrame, day: date) -> tuple[DataFrame, DataFrame]:
    """Counts by kind, and the documents in force on a day."""
    return graph.summary(nodes, edges), graph.as_of(intervals, day).select("doc_id").orderBy("doc_id")


def evaluate(docs: DataFrame, queries: DataFrame, relevant: DataFrame, k: int = 10) -> DataFrame:
    """lang, hit, rr, precision, n: means over queries (query_id, text, lang) of a search by words against relevant (query_id, doc_id), by
    language and, with a null language, over all; a query without hits counts as missed."""
    from pyspark.sql import Window

    hits = index.bm25_each(docs, queries, k).withColumn("k", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")))
    marked = hits.join(relevant.withColumn("m", F.lit(True)), ["query_id", "doc_id"], "left").withColumn("m", F.coalesce("m", F.lit(False)))
    each = queries.select("query_id", "lang").join(evaluation.metrics(marked, "query_id", "k", "m", k), "query_id", "left")
    score = lambda c: F.round(F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))), 6).alias(c)
    return each.rollup("lang").agg(score("hit"), score("rr"), score("precision"), F.count("*").alias("n"))
