"""Lexical, vector and hybrid retrieval, and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluation, lexical, retrieval, vector
from ..session import load
from .registry import query

TERMS = ["the", "and", "that"]
_TOK = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_TF = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(TERMS))
_PART = " + ".join(f"greatest(ln((n - df{i} + 0.5) / (df{i} + 0.5)), 1e-6) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * dl / avgdl))" for i in range(3))
_BM = f"""t AS (SELECT doc_id, {_TOK} AS w FROM documents), c AS (SELECT doc_id, len(w) AS dl, {_TF} FROM t),
s AS (SELECT count(*) AS n, avg(dl) AS avgdl, {', '.join(f'count(*) FILTER (tf{i} > 0) AS df{i}' for i in range(3))} FROM c),
bm AS (SELECT doc_id, round({_PART}, 6) AS score FROM c, s WHERE tf0 > 0 OR tf1 > 0 OR tf2 > 0)"""
_COS = """q AS (SELECT list_transform(embedding, lambda x: x::DOUBLE) AS q FROM embeddings WHERE vec_id = 0),
cs AS (SELECT vec_id, round(list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), q) / sqrt(list_dot_product(q, q)) / coalesce(nullif(sqrt(list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), list_transform(embedding, lambda x: x::DOUBLE))), 0), 1), 6) AS score FROM embeddings, q)"""


def _query_vector(spark: SparkSession, sf: str) -> list[float]:
    return [float(x) for x in load(spark, sf, "embeddings").where("vec_id = 0").first()["embedding"]]


@query(f"WITH {_BM} SELECT * FROM bm ORDER BY score DESC, doc_id LIMIT 20")
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.bm25(load(spark, sf, "documents"), TERMS).orderBy(F.desc("score"), "doc_id").limit(20)


@query(f"""WITH t AS (SELECT doc_id, {_TOK} AS w FROM documents), p AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM t WHERE len(w) > 1)
SELECT doc_id, count(*) AS n FROM p WHERE w[i] = 'of' AND w[i + 1] = 'the' GROUP BY doc_id""")
def bm25_phrase(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.phrase(load(spark, sf, "documents"), ["of", "the"]).select("doc_id", F.col("n").cast("long").alias("n"))


@query(f"WITH t AS (SELECT doc_id, unnest({_TOK}) AS term FROM documents) SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM t GROUP BY term")
def postings_stats(spark: SparkSession, sf: str) -> DataFrame:
    each = load(spark, sf, "documents").select("doc_id", F.explode(T.tokens(F.col("text"))).alias("term"))
    return each.groupBy("term", "doc_id").count().groupBy("term").agg(F.count("*").alias("df"), F.sum("count").alias("cf"))


@query(f"WITH {_COS} SELECT * FROM cs ORDER BY score DESC, vec_id LIMIT 20")
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    return vector.cosine_topk(load(spark, sf, "embeddings"), _query_vector(spark, sf), 20)


@query("""WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), s AS (SELECT vec_id, v, coalesce(nullif(sqrt(list_dot_product(v, v)), 0), 1) AS l FROM n),
c AS (SELECT q.vec_id AS query_id, s.vec_id, round(list_dot_product(s.v, q.v) / q.l / s.l, 6) AS score FROM s, s q WHERE q.vec_id % 100 = 0)
SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""")
def cosine_topk_each(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "embeddings")
    return vector.cosine_topk_each(e, e.where("vec_id % 100 = 0"), 20)


@query(f"WITH {_COS}, b AS (SELECT label, max(score) AS score FROM cs JOIN embeddings USING (vec_id) GROUP BY label ORDER BY 2 DESC, 1 LIMIT 3) SELECT label, vec_id, b.score FROM b JOIN embeddings USING (label)")
def cosine_hash_budget(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "embeddings")
    q = F.array(*map(F.lit, _query_vector(spark, sf)))
    scored = e.select("label", F.round(vector.dot(F.col("embedding"), q) / vector.norm(q) / F.coalesce(F.nullif(vector.norm(F.col("embedding")), F.lit(0.0)), F.lit(1.0)), 6).alias("score")).groupBy("label").agg(F.max("score").alias("score"))
    return vector.hash_budget(scored, e.select("label", "vec_id"), 3, "label")


@query("SELECT vec_id, round(sqrt(list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), list_transform(embedding, lambda x: x::DOUBLE))), 6) AS norm, len(embedding)::INT AS dim FROM embeddings")
def l2_norms(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "embeddings").select("vec_id", F.round(vector.norm(F.col("embedding")), 6).alias("norm"), F.size("embedding").alias("dim"))


@query("SELECT vec_id, round(list_transform(embedding, lambda x: x::DOUBLE)[1] / sqrt(list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), list_transform(embedding, lambda x: x::DOUBLE))), 6) AS x0 FROM embeddings")
def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "embeddings").select("vec_id", F.round(F.get(vector.l2_normalize(F.col("embedding")), F.lit(0)), 6).alias("x0"))


@query("SELECT DISTINCT doc_id AS content_hash FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def pending_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return vector.pending(load(spark, sf, "documents").select(F.col("doc_id").alias("content_hash")), load(spark, sf, "embeddings").select(F.col("vec_id").alias("content_hash")))


@query("SELECT vec_id AS content_hash FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)")
def orphan_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vector.orphans(load(spark, sf, "embeddings").select(F.col("vec_id").alias("content_hash")), load(spark, sf, "labels").select(F.col("doc_id").alias("content_hash")))


@query("SELECT label, count(*) AS n_vectors, sum(len(embedding) * 4)::BIGINT AS n_bytes FROM embeddings GROUP BY label")
def vector_models(spark: SparkSession, sf: str) -> DataFrame:
    return vector.models(load(spark, sf, "embeddings"), "label", "embedding")


_RRF = f"""WITH {_BM}, {_COS}, a AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM bm QUALIFY r <= 50),
b AS (SELECT vec_id AS doc_id, row_number() OVER (ORDER BY score DESC, vec_id) AS r FROM cs QUALIFY r <= 50)
SELECT doc_id, round(sum(1.0::DOUBLE / (60 + r)), 9) AS rrf FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY doc_id ORDER BY rrf DESC, doc_id LIMIT 20"""


@query(_RRF)
def hybrid_rrf(spark: SparkSession, sf: str) -> DataFrame:
    lexical_hits = lexical.bm25(load(spark, sf, "documents"), TERMS)
    vector_hits = vector.cosine_topk(load(spark, sf, "embeddings"), _query_vector(spark, sf), retrieval.POOL).withColumnRenamed("vec_id", "doc_id")
    return retrieval.rrf([lexical_hits, vector_hits], "doc_id")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def facet_filter(spark: SparkSession, sf: str) -> DataFrame:
    topics = load(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("topic"))
    return retrieval.facet_filter(load(spark, sf, "customer"), {"c_mktsegment": ["BUILDING", "MACHINERY"]}, topics, "1-URGENT", "c_custkey").select("c_custkey")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NOT NULL AS s FROM orders) WHERE NOT s")
def superseded_gate(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = load(spark, sf, "orders").withColumn("s", F.lead("o_orderkey").over(w).isNotNull())
    return retrieval.superseded_gate(o, F.col("s")).select("o_orderkey")


@query(f"""WITH {_BM}, r AS (SELECT lang, doc_id, quality, row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) AS k FROM bm JOIN documents USING (doc_id) JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id) QUALIFY k <= 10)
SELECT lang, count(*) FILTER (quality = 1) > 0 AS hit, round(coalesce(1.0::DOUBLE / min(k) FILTER (quality = 1), 0), 6) AS rr, round(avg(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS precision FROM r GROUP BY lang""")
def retrieval_eval(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    labels = load(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    hits = lexical.bm25(docs, TERMS).join(docs.select("doc_id", "lang"), "doc_id").join(labels, "doc_id")
    ranked = hits.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), "doc_id")))
    return evaluation.metrics(ranked.withColumn("m", F.col("quality") == 1), "lang", "k", "m", 10)


@query(r"""WITH p AS (SELECT conv_id, max(text) FILTER (turn = 0) AS a, max(text) FILTER (turn = 1) AS b FROM conversations GROUP BY 1),
t AS (SELECT conv_id, list_distinct(list_filter(string_split_regex(lower(coalesce(a, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS x, list_distinct(list_filter(string_split_regex(lower(coalesce(b, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS y FROM p)
SELECT conv_id, round(CASE WHEN len(x) = 0 THEN 1 ELSE len(list_intersect(x, y))::DOUBLE / len(x) END, 6) AS recall FROM t""")
def token_recall(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.witness(_turns(spark, sf), "conv_id", "a", "b").select("conv_id", "recall")


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "conversations").groupBy("conv_id").agg(F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("a"), F.max(F.when(F.col("turn") == 1, F.col("text"))).alias("b"))


@query(r"""WITH p AS (SELECT conv_id, max(text) FILTER (turn = 0) AS a, max(text) FILTER (turn = 1) AS b FROM conversations GROUP BY 1),
n AS (SELECT conv_id, unnest(regexp_extract_all(coalesce(a, ''), '[0-9]+(?:[.,][0-9]+)*')) AS x, 1 AS s FROM p UNION ALL SELECT conv_id, unnest(regexp_extract_all(coalesce(b, ''), '[0-9]+(?:[.,][0-9]+)*')), -1 FROM p),
d AS (SELECT conv_id, x, sum(s) AS s FROM n GROUP BY 1, 2)
SELECT p.conv_id, coalesce(sum(greatest(s, 0)), 0)::INT AS numbers_missing, coalesce(sum(greatest(-s, 0)), 0)::INT AS numbers_added FROM p LEFT JOIN d ON p.conv_id = d.conv_id GROUP BY 1""")
def numeric_delta(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.witness(_turns(spark, sf), "conv_id", "a", "b").select("conv_id", "numbers_missing", "numbers_added")


@query(r"""WITH p AS (SELECT conv_id, max(text) FILTER (turn = 0) AS a, max(text) FILTER (turn = 1) AS b FROM conversations GROUP BY 1),
n AS (SELECT conv_id, trim(regexp_replace(replace(left(a, 200), '#', ''), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS g, trim(regexp_replace(replace(left(b, 200), '#', ''), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS c FROM p WHERE a IS NOT NULL AND b IS NOT NULL AND regexp_matches(a || b, '^[\x00-\x7F]*$'))
SELECT conv_id, round(CASE WHEN length(g) = 0 THEN CASE WHEN length(c) = 0 THEN 0 ELSE 1 END ELSE levenshtein(g, c)::DOUBLE / length(g) END, 6) AS cer FROM n""")
def cer(spark: SparkSession, sf: str) -> DataFrame:
    p = _turns(spark, sf).where("a is not null and b is not null").where(F.concat("a", "b").rlike(r"^[\x00-\x7F]*$"))
    return p.select("conv_id", F.round(T.cer(F.left("a", F.lit(200)), F.left("b", F.lit(200))), 6).alias("cer"))


@query()
def cer_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Of whole texts and all conversations; a text that is missing counts as empty."""
    a, b = (F.coalesce(F.col(c), F.lit("")) for c in "ab")
    return _turns(spark, sf).select("conv_id", F.round(T.cer(a, b), 6).alias("cer"))
