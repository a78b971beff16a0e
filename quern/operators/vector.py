"""Dense vectors: norms, brute-force cosine, and the bookkeeping of stored vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block.
BLOCK = 2048


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """A zero vector stays as it is."""
    return F.when(norm(v) == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(F.transform(v, lambda x: x.cast("double") / norm(v)))


def cosine_topk(vectors: DataFrame, query: list[float], k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, score: one query vector as a literal, so a scan, and k rows a task at most are merged."""
    q = F.array(*[F.lit(float(x)) for x in query])
    n = sum(x * x for x in query) ** 0.5 or 1.0
    score = F.round(dot(F.col(vec_col), q) / n / F.coalesce(F.nullif(norm(F.col(vec_col)), F.lit(0.0)), F.lit(1.0)), 6)
    return vectors.select(id_col, score.alias("score")).orderBy(F.desc("score"), id_col).limit(k)


def _blocks(vectors: DataFrame, name: str, id_col: str, vec_col: str) -> DataFrame:
    n = -(-vectors.count() // BLOCK) or 1
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    return own.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias(f"{name}_block")).agg(F.collect_list(F.struct("id", "v")).alias(name))


def cosine_topk_each(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, id, score: the k best rows of each query. Blocks of queries meet blocks of rows, and a pair of blocks gives k rows a
    query at most, so what is shuffled are these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(x: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
            ids, v = x.values.field("id").to_numpy(), np.array(x.values.field("v").to_pylist(), np.float64)
            norms = np.sqrt((v * v).sum(axis=1))
            return ids, v / np.where(norms == 0, 1.0, norms)[:, None]

        for b in batches:
            for x, y in zip(b["q"], b["v"], strict=True):
                (qs, q), (ids, v) = block(x), block(y)
                score = np.round(q @ v.T, 6)
                for i, own in enumerate(score):
                    best = np.lexsort((ids, -own))[:k]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), qs[i])), pa.array(ids[best]), pa.array(own[best])], ["query_id", id_col, "score"])

    pairs = _blocks(queries, "q", id_col, vec_col).crossJoin(_blocks(vectors, "v", id_col, vec_col)).select("q", "v")
    best = pairs.mapInArrow(run, f"query_id long, {id_col} long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), id_col))
    return best.withColumn("k", rank).where(F.col("k") <= k).drop("k")


def hash_budget(scored: DataFrame, carriers: DataFrame, k: int, hash_col: str = "content_hash") -> DataFrame:
    """The k best hashes that any carrier has, each with all its carriers: the budget counts hashes and not rows."""
    best = scored.join(carriers.select(hash_col).distinct(), hash_col, "left_semi").orderBy(F.desc("score"), hash_col).limit(k)
    return carriers.join(F.broadcast(best), hash_col)


def pending(chunks: DataFrame, vectors: DataFrame, hash_col: str = "content_hash") -> DataFrame:
    """Distinct hashes without a vector."""
    return chunks.select(hash_col).distinct().join(vectors.select(hash_col), hash_col, "left_anti")


def orphans(vectors: DataFrame, chunks: DataFrame, hash_col: str = "content_hash") -> DataFrame:
    """Vectors whose hash no chunk has."""
    return vectors.join(chunks.select(hash_col), hash_col, "left_anti")


def models(vectors: DataFrame, model_col: str, vec_col: str) -> DataFrame:
    return vectors.groupBy(model_col).agg(F.count("*").alias("n_vectors"), F.sum(F.size(vec_col) * 4).alias("n_bytes"))
