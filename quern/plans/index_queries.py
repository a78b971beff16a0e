"""Search with many queries, snippets, the stored index and the walks of the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import convert, evaluation, graph, index, lexical
from ..session import load
from .registry import query

_TOK = r"list_filter(string_split_regex(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
_EACH = f"""WITH q AS (SELECT DISTINCT item_id AS query_id, unnest(list_distinct({_TOK.format('text')}[1:4])) AS term FROM benchmark), t AS (SELECT doc_id, {_TOK.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM t), e AS (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM t), tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM e WHERE term IN (SELECT term FROM q) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
c AS (SELECT query_id, doc_id, round(sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM q JOIN tf USING (term) JOIN df USING (term), s GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS k FROM c QUALIFY k <= 10)"""


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    head = F.array_join(F.slice(T.tokens(F.col("text")), 1, 4), " ")
    return load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), head.alias("text"))


@query(f"{_EACH} SELECT query_id, doc_id, score FROM k")
def bm25_each(spark: SparkSession, sf: str) -> DataFrame:
    return index.bm25_each(load(spark, sf, "documents"), _queries(spark, sf), 10)


@query(f"""{_EACH}, m AS (SELECT query_id, k, lang = 'en' AS m FROM k JOIN documents USING (doc_id)) SELECT query_id, count(*) FILTER (m) > 0 AS hit, round(coalesce(1.0::DOUBLE / min(k) FILTER (m), 0), 6) AS rr, round(avg(CASE WHEN m THEN 1.0::DOUBLE ELSE 0 END), 6) AS precision FROM m GROUP BY query_id""")
def channel_eval(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    docs = load(spark, sf, "documents")
    hits = index.bm25_each(docs, _queries(spark, sf), 10).withColumn("k", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")))
    return evaluation.metrics(hits.join(docs.select("doc_id", "lang"), "doc_id").withColumn("m", F.col("lang") == "en"), "query_id", "k", "m", 10)


@query(r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents), c AS (SELECT doc_id, len(w) AS dl, len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) AS a, len(list_filter(w, lambda x: x = 'and')) AS b FROM w),
s AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM c)
SELECT doc_id, round(greatest(ln((n - da + 0.5) / (da + 0.5)), 1e-6) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + greatest(ln((n - db + 0.5) / (db + 0.5)), 1e-6) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score FROM c, s WHERE a > 0 AND b > 0""")
def phrase_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(load(spark, sf, "documents"), 'of-the  "and"')


@query(r"""WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\f\x0B]+', ' ', 'g')), ' ') AS w FROM documents), h AS (SELECT *, greatest(coalesce(list_position(list_transform(w, lambda x: regexp_replace(lower(x), '[^\p{L}\p{N}]+', '', 'g') IN ('the', 'and')), true), 0) - 4, 0) AS f FROM w)
SELECT doc_id, CASE WHEN f > 0 THEN '…' ELSE '' END || array_to_string(list_transform(w[f + 1:f + 12], lambda x: CASE WHEN regexp_replace(lower(x), '[^\p{L}\p{N}]+', '', 'g') IN ('the', 'and') THEN '[' || x || ']' ELSE x END), ' ') || CASE WHEN len(w) > f + 12 THEN '…' ELSE '' END AS snippet FROM h""")
def marked_snippets(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", index.marked_snippet(F.col("text"), "the and").alias("snippet"))


_DE = "d AS (SELECT DISTINCT 'doc:' || l_orderkey AS src, 'doc:' || (l_partkey + 1) AS dst, CASE l_linenumber % 3 WHEN 0 THEN 'implements' WHEN 1 THEN 'cites' ELSE 'supersedes' END AS etype, CASE WHEN l_suppkey % 2 = 0 THEN 'L0' ELSE 'L1' END AS layer FROM lineitem WHERE l_orderkey <> l_partkey + 1)"


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("l_linenumber") % 3
    li = load(spark, sf, "lineitem").where("l_orderkey <> l_partkey + 1")
    kind = F.when(k == 0, "implements").when(k == 1, "cites").otherwise("supersedes")
    return li.select(graph.node_id("doc", F.col("l_orderkey")).alias("src"), graph.node_id("doc", F.col("l_partkey") + 1).alias("dst"), kind.alias("etype"), F.when(F.col("l_suppkey") % 2 == 0, "L0").otherwise("L1").alias("layer")).distinct()


@query(f"""WITH {_DE}, e AS (SELECT * FROM d WHERE etype <> 'supersedes'), w AS (SELECT src, dst, etype, layer, 'out' AS direction FROM e UNION SELECT dst, src, etype, layer, 'in' FROM e), s AS (SELECT 'doc:' || x AS id FROM (VALUES (1), (2), (3)) v(x)),
h1 AS (SELECT DISTINCT dst AS id FROM w WHERE src IN (FROM s) AND dst NOT IN (FROM s)), h2 AS (SELECT DISTINCT dst AS id FROM w WHERE src IN (FROM h1) AND dst NOT IN (FROM s) AND dst NOT IN (FROM h1))
SELECT DISTINCT dst AS id, 1 AS hops, etype, layer, direction FROM w WHERE src IN (FROM s) AND dst IN (FROM h1) UNION ALL SELECT DISTINCT dst, 2, etype, layer, direction FROM w WHERE src IN (FROM h1) AND dst IN (FROM h2)""")
def typed_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    seeds = spark.createDataFrame([("doc:1",), ("doc:2",), ("doc:3",)], "id string")
    return graph.neighbours(_documents(spark, sf), seeds, 2, ["implements", "cites"], "doc:")


@query(f"WITH {_DE} SELECT DISTINCT src AS id, dst AS target FROM d WHERE etype = 'implements'")
def implementations(spark: SparkSession, sf: str) -> DataFrame:
    d = _documents(spark, sf)
    return graph.descendants(d, d.select(F.col("src").alias("id")).distinct(), "implements")


@query("SELECT DISTINCT o_orderkey - 1 AS id FROM orders WHERE o_orderkey % 3 = 0 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0")
def superseded_records(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    rel = lambda kind, target: F.struct(F.lit(kind).alias("type"), target.alias("target"))
    rels = F.array_compact(F.array(F.when(k % 3 == 0, rel("supersedes", k - 1)), F.when(k % 5 == 0, rel("superseded_by", k + 1)), rel("cites", k + 2)))
    return index.superseded(load(spark, sf, "orders").select(k.alias("id"), rels.alias("relations")))


@query("SELECT vec_id AS content_hash, CASE WHEN vec_id % 3 = 0 THEN 'b' ELSE 'a' END AS model FROM embeddings WHERE vec_id % 3 = 0 OR vec_id IN (SELECT doc_id FROM documents WHERE doc_id % 4 <> 0)")
def live_vectors(spark: SparkSession, sf: str) -> DataFrame:
    v = load(spark, sf, "embeddings").select(F.col("vec_id").alias("content_hash"), F.when(F.col("vec_id") % 3 == 0, "b").otherwise("a").alias("model"))
    return index.live_vectors(v, load(spark, sf, "documents").where("doc_id % 4 <> 0").select(F.col("doc_id").alias("content_hash")), "a")


@query("WITH o AS (SELECT vec_id AS content_hash, 'a' AS model, embedding[1] AS v FROM embeddings WHERE vec_id % 2 = 0), n AS (SELECT vec_id AS content_hash, 'a' AS model, embedding[2] AS v FROM embeddings WHERE vec_id % 3 = 0) SELECT * FROM n UNION ALL SELECT * FROM o WHERE content_hash NOT IN (SELECT content_hash FROM n)")
def vector_upsert(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "embeddings")
    of = lambda cond, i: e.where(cond).select(F.col("vec_id").alias("content_hash"), F.lit("a").alias("model"), F.get("embedding", F.lit(i)).alias("v"))
    return index.upsert_vectors(of("vec_id % 2 = 0", 0), of("vec_id % 3 = 0", 1))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'eng' WHEN 'de' THEN 'deu+eng' WHEN 'fr' THEN 'fra+eng' WHEN 'es' THEN 'spa+eng' END AS ocr, length(trim(text)) < 50 AS scan FROM documents")
def ocr_plan(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    return d.select("doc_id", convert.ocr_languages(F.col("lang")).alias("ocr")).join(convert.is_scan(d, "doc_id", "text"), "doc_id")


@query()
def html_markdown(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.col("html").cast("binary").alias("content"))
    return convert.converted(pages)


@query()
def chunk_vectors(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents").select(F.sha2("text", 256).alias("content_hash"), "text")
    return index.embedded(d, index.HashEmbedder(32))


_RE = """SELECT c_custkey AS id, 'Title ' || c_custkey AS title, 'Issuer ' || (c_custkey % 17) AS issuer, CASE WHEN c_custkey % 2 = 0 THEN 'national' ELSE 'intl' END AS geo_scope, 'C' || c_nationkey AS entity_id, c_mktsegment AS pattern, 't' || (c_custkey % 5) AS t1, 't' || (c_custkey % 3) AS t2,
 CASE WHEN c_custkey % 4 = 0 THEN c_custkey - 1 END AS supersedes FROM customer"""
_BL = "SELECT r_name AS bloc, 'The ' || r_name AS label, 'C' || n_nationkey AS iso2 FROM nation JOIN region ON n_regionkey = r_regionkey"
_CI = "SELECT DISTINCT o_custkey AS source_id, o_custkey % 50 AS target_id, 'ISO ' || (o_custkey % 9) AS identifier, 'iso' AS rule FROM orders WHERE o_custkey % 50 > 0"


def _graph_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    for t in ("customer", "nation", "region", "orders"):
        load(spark, sf, t).createOrReplaceTempView(f"quern_{t}")
    sql = lambda q: spark.sql(q.replace("FROM ", "FROM quern_").replace("JOIN ", "JOIN quern_"))
    relations = F.array_compact(F.array(F.when(F.col("supersedes").isNotNull(), F.struct(F.lit("supersedes").alias("type"), F.col("supersedes").alias("target")))))
    records = sql(_RE).select("id", "title", "issuer", "geo_scope", "entity_id", F.array("pattern").alias("patterns"), F.array("t1", "t2").alias("topics"), relations.alias("relations"))
    return records, sql(_BL), sql(_CI)


@query(f"""WITH r AS ({_RE}), s AS (SELECT DISTINCT lower(entity_id) AS iso2 FROM r WHERE geo_scope = 'national'), b AS (SELECT * FROM ({_BL}) WHERE lower(iso2) IN (FROM s))
SELECT 'doc:' || id AS id, 'document' AS ntype, title AS label, NULL AS level FROM r UNION ALL SELECT DISTINCT 'issuer:' || issuer, 'issuer', issuer, NULL FROM r UNION ALL SELECT DISTINCT 'pattern:' || pattern, 'pattern', pattern, NULL FROM r
UNION ALL SELECT DISTINCT 'topic:' || t, 'topic', t, NULL FROM (SELECT t1 AS t FROM r UNION SELECT t2 FROM r) UNION ALL SELECT 'country:' || iso2, 'jurisdiction', upper(iso2), 'country' FROM s UNION ALL SELECT DISTINCT 'bloc:' || bloc, 'jurisdiction', label, 'bloc' FROM b""")
def corpus_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.build(*_graph_inputs(spark, sf))[0]


@query(f"""WITH r AS ({_RE}), s AS (SELECT DISTINCT lower(entity_id) AS iso2 FROM r WHERE geo_scope = 'national'), b AS (SELECT * FROM ({_BL}) WHERE lower(iso2) IN (FROM s))
SELECT *, 'L0' AS layer, NULL AS rule, NULL AS identifier FROM (SELECT 'doc:' || id AS src, 'issuer:' || issuer AS dst, 'published_by' AS etype FROM r UNION ALL SELECT 'doc:' || id, 'pattern:' || pattern, 'exemplifies' FROM r
UNION ALL (SELECT 'doc:' || id, 'topic:' || t1, 'about' FROM r UNION SELECT 'doc:' || id, 'topic:' || t2, 'about' FROM r) UNION ALL SELECT 'doc:' || id, 'country:' || lower(entity_id), 'applies_to' FROM r WHERE geo_scope = 'national'
UNION ALL SELECT 'country:' || lower(iso2), 'bloc:' || bloc, 'member_of' FROM b UNION ALL SELECT 'doc:' || id, 'doc:' || supersedes, 'supersedes' FROM r WHERE supersedes IS NOT NULL)
UNION ALL SELECT 'doc:' || source_id, 'doc:' || target_id, 'cites', 'L1', rule, identifier FROM ({_CI})""")
def corpus_edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.build(*_graph_inputs(spark, sf))[1]


@query("WITH v AS (SELECT o_orderkey, o_orderdate, o_orderkey + 1 AS a, o_orderkey + 2 AS b FROM orders WHERE o_orderkey % 3 = 0), e AS (SELECT o_orderkey, a AS s FROM v UNION SELECT o_orderkey, b FROM v WHERE o_orderkey % 2 = 0), j AS (SELECT e.o_orderkey, count(*) AS n, min(o.o_orderdate) AS t FROM e LEFT JOIN orders o ON e.s = o.o_orderkey GROUP BY 1) SELECT o_orderkey AS doc_id, 'several successors' AS warning FROM j WHERE n > 1 UNION ALL SELECT o_orderkey, 'ends before it begins' FROM j JOIN orders USING (o_orderkey) WHERE t < o_orderdate")
def validity_warnings(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    k = F.col("o_orderkey")
    heirs = o.where(k % 3 == 0).select(k.alias("doc_id"), F.explode(F.when(k % 2 == 0, F.array(k + 1, k + 2)).otherwise(F.array(k + 1))).alias("successor"))
    return graph.validity_warnings(o.select(k.alias("doc_id"), F.col("o_orderdate").alias("valid_from")), heirs)
