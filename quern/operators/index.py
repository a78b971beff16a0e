"""The stored index: building it, keeping it up to date, searching it with many queries, and what must hold before a search."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import cut, ship
from ..functions import text as T
from . import incremental
from .lexical import B, IDF_FLOOR, K1, query_phrases

#: Terms that a query set may have in all to be broadcast; more are joined by a shuffle.
TERMS = 50_000
#: Tokens of a snippet.
SNIPPET = 12


class Embedder(Protocol):
    """What makes vectors of texts; kind is query or passage."""

    name: str
    dim: int
    max_tokens: int

    def embed(self, texts: Sequence[str], kind: str) -> np.ndarray: ...


class HashEmbedder:
    """Counts of hashed words, of unit length: needs no model and gives the same vector everywhere."""

    name, max_tokens = "hash", 1 << 20

    def __init__(self, dim: int = 64) -> None:
        self.dim = dim

    def embed(self, texts: Sequence[str], kind: str) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = zlib.crc32(w.encode())
                out[i, h % self.dim] += 1.0 if h & (1 << 31) else -1.0
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norms == 0, 1, norms)


def embedded(chunks: DataFrame, embedder: Embedder, hash_col: str = "content_hash", text_col: str = "text") -> DataFrame:
    """content_hash, model, vec: a vector for each distinct hash."""
    ship(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = embedder.embed([t or "" for t in b[text_col].to_pylist()], "passage")
            yield pa.RecordBatch.from_arrays([b[hash_col], pa.array([embedder.name] * len(v)), pa.array(v.tolist(), pa.list_(pa.float32()))], ["content_hash", "model", "vec"])

    one = chunks.groupBy(hash_col).agg(F.min(text_col).alias(text_col))
    return one.mapInArrow(run, "content_hash string, model string, vec array<float>")


def check_budget(chunk_tokens: int | None, embedder_tokens: int | None) -> None:
    """An error if chunks may be longer than the embedder reads; what isn't known passes."""
    if chunk_tokens is not None and embedder_tokens is not None and chunk_tokens > embedder_tokens:
        raise ValueError(f"chunks of {chunk_tokens} tokens are too long for an embedder of {embedder_tokens}")


def check_dimensions(vectors: DataFrame, vec_col: str = "vec") -> int:
    """The dimension of all vectors; an error if they differ."""
    n = vectors.agg(F.min(F.size(vec_col)).alias("a"), F.max(F.size(vec_col)).alias("b")).first()
    if n["a"] != n["b"]:
        raise ValueError(f"vectors of {n['a']} and {n['b']} dimensions")
    return n["a"] or 0


def stale(stored: str | None, current: str) -> bool:
    """Whether the index was built of other texts, or it isn't known of which."""
    return stored != current


def needs_rebuild(stored: str | None, current: str, force: bool = False) -> tuple[bool, str]:
    return (True, "forced") if force else (True, "no index") if stored is None else (True, "texts changed") if stored != current else (False, "up to date")


def facets(records: DataFrame, columns: Sequence[str], topics: str, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The facets of every record, and (doc_id, topic); both are always written anew."""
    return records.select(id_col, *columns), records.select(id_col, F.explode(topics).alias("topic")).distinct()


def superseded(records: DataFrame, id_col: str = "id") -> DataFrame:
    """id of records that another one supersedes, by a relation of either side: relations array<struct<type,target>>."""
    each = records.select(id_col, F.explode("relations").alias("r"))
    return each.where("r.type = 'supersedes'").select(F.col("r.target").alias(id_col)).unionByName(each.where("r.type = 'superseded_by'").select(id_col)).distinct()


def reindexed(chunks: DataFrame, fingerprints: DataFrame, docs: DataFrame, chunked, id_col: str = "doc_id") -> DataFrame:
    """The chunks with those of changed and vanished documents replaced: docs has fingerprint and text, chunked() makes chunks of documents, and is
    given only those that changed or came."""
    changes = cut(incremental.diff(fingerprints, docs.select(id_col, "fingerprint"), id_col))
    fresh = docs.join(changes.where("change <> 'vanished'"), id_col, "left_semi")
    return chunks.join(changes, id_col, "left_anti").unionByName(chunked(fresh))


def upsert_vectors(old: DataFrame, new: DataFrame) -> DataFrame:
    """Vectors by (content_hash, model), new ones in place of old ones."""
    keys = ["content_hash", "model"]
    return old.join(new, keys, "left_anti").unionByName(new.dropDuplicates(keys))


def live_vectors(vectors: DataFrame, chunks: DataFrame, model: str) -> DataFrame:
    """The vectors without those of a model that no chunk has any more; other models' stay."""
    return vectors.where(F.col("model") != model).unionByName(vectors.where(F.col("model") == model).join(chunks.select("content_hash").distinct(), "content_hash", "left_semi").select(*vectors.columns))


def without_model(vectors: DataFrame, model: str) -> DataFrame:
    return vectors.where(F.col("model") != model)


def unembedded(chunks: DataFrame, vectors: DataFrame, model: str) -> int:
    """How many distinct hashes have no vector of the model."""
    return chunks.select("content_hash").distinct().join(vectors.where(F.col("model") == model), "content_hash", "left_anti").count()


def bm25_each(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """query_id, id, score: the k best documents of each query (query_id, text), by any of its terms. One pass over the texts: a token is kept
    only if a query has it, so what is shuffled follows the hits; k rows a query and task at most are merged."""
    asked = cut(queries.select("query_id", F.explode(T.token_set(F.col("text"))).alias("term")).distinct())
    terms = asked.select("term").distinct().withColumn("hit", F.lit(True))
    if terms.limit(TERMS + 1).count() <= TERMS:
        terms = F.broadcast(terms)
    own = docs.select(id_col, T.let(T.tokens(F.col(text_col)), lambda w: F.struct(F.size(w).alias("dl"), w.alias("w"))).alias("x")).select(id_col, F.col("x.dl").alias("dl"), F.explode_outer("x.w").alias("term"))
    tf = cut(own.join(terms, "term", "left").groupBy(id_col, "dl", F.when(F.col("hit"), F.col("term")).alias("term")).agg(F.count("*").alias("tf")))
    whole = tf.select(id_col, "dl").distinct().agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).withColumn("_one", F.lit(1))
    hits = tf.where("term is not null")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.greatest(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(IDF_FLOOR))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    weighed = hits.join(df, "term").withColumn("_one", F.lit(1)).join(F.broadcast(whole), "_one").select("term", id_col, part.alias("part"))
    scored = asked.join(weighed, "term").groupBy("query_id", id_col).agg(F.round(F.sum("part"), 6).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return scored.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= k).drop("_k")


def marked_snippet(text: Column, query: str, width: int = SNIPPET) -> Column:
    """Up to width words of a text from the first hit on, with a few before it; words of the query are put in brackets, what is cut off is …"""
    wanted = sorted({w for p in query_phrases(query) for w in p})
    plain = lambda x: F.regexp_replace(F.lower(x), T.NOT_WORD, "")

    def of(words: Column) -> Column:
        hits = F.transform(words, lambda x: plain(x).isin(wanted))
        first = F.greatest(F.coalesce(F.array_position(hits, F.lit(True)), F.lit(0)) - 1 - width // 4, F.lit(0)).cast("int")
        shown = F.transform(F.slice(words, first + 1, width), lambda x: F.when(plain(x).isin(wanted), F.concat(F.lit("["), x, F.lit("]"))).otherwise(x))
        return F.concat(F.when(first > 0, "…").otherwise(""), F.array_join(shown, " "), F.when(F.size(words) > first + width, "…").otherwise(""))

    return T.let(F.split(T.ws_normalize(F.coalesce(text, F.lit(""))), " "), of)


def hydrated(hits: DataFrame, chunks: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The few hits of a search with the columns of their chunks."""
    return chunks.select(*keys, *columns).join(F.broadcast(hits), list(keys))
