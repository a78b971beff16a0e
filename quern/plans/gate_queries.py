"""Filters, gates and record mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import gates as G
from ..session import load
from .registry import query

_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_FLAT = r"trim(regexp_replace({}, '[ \t\n\r\f\x0B]+', ' ', 'g'))"


@query(f"SELECT page_id, {_HOST} = 'example.org' OR {_HOST} LIKE '%.example.org' OR contains(url, 'utm_source') AS filtered FROM pages")
def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", G.url_filtered(F.col("url"), ["example.org"], ["utm_source"]).alias("filtered"))


@query(f"SELECT page_id, CASE WHEN regexp_matches(url, '^https?://') AND contains({_HOST}, '.') AND length(url) >= 12 THEN url END AS clean FROM (SELECT page_id, regexp_replace(trim(url), '[).,;]+$', '') AS url FROM (SELECT page_id, ' ' || url || ').' AS url FROM pages))")
def sanitized_urls(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", G.sanitize_url(F.concat(F.lit(" "), "url", F.lit(")."))).alias("clean"))


@query("SELECT p_partkey FROM part WHERE NOT (contains(lower(p_type), 'brass') OR contains(lower(p_type), 'promo'))")
def status_filter(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").where(~G.excluded_status(F.col("p_type"), ["BRASS", "promo"])).select("p_partkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') OR (o_orderpriority = '5-LOW' AND o_orderstatus IN ('F', 'P'))")
def scope_filter(spark: SparkSession, sf: str) -> DataFrame:
    scope = G.in_scope(F.col("o_orderpriority"), F.col("o_orderstatus"), ["1-URGENT", "2-HIGH"], "5-LOW", ["F", "P"])
    return load(spark, sf, "orders").where(scope).select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND coalesce(source NOT IN ('src0', 'src1'), true)")
def source_filter(spark: SparkSession, sf: str) -> DataFrame:
    return G.source_filter(load(spark, sf, "documents"), "source", "lang", deny=["src0", "src1"], tracks=["en", "de"]).select("doc_id")


@query("SELECT page_id FROM pages WHERE url IS NOT NULL AND split_part(url, '#', 1) NOT IN (SELECT split_part(url, '#', 1) FROM pages WHERE contains(url, 'example.org'))")
def foreign_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages").where("url is not null")
    return G.foreign_links(pages, "url", pages.where(F.contains("url", F.lit("example.org"))), "url").select("page_id")


@query(r"""WITH w AS (SELECT doc_id, lower(text) AS low, list_filter(list_distinct(regexp_split_to_array(lower(string_split(text, chr(10))[1]), '[^\p{L}\p{N}]+')), lambda x: length(x) >= 4) AS own FROM documents WHERE text IS NOT NULL)
SELECT doc_id, len(list_filter(own, lambda x: contains(low, x))) >= greatest(1, round_even(len(own) * 0.4, 0)) AS ok FROM w""")
def title_match(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").where("text is not null").select("doc_id", G.title_matches(F.get(F.split("text", "\n"), F.lit(0)), F.col("text")).alias("ok"))


@query(f"SELECT doc_id, coalesce(s <> '' AND contains(t, s), false) AS ok FROM (SELECT doc_id, lower({_FLAT.format('source')}) AS s, lower({_FLAT.format('text')}) AS t FROM documents)")
def verbatim_gate(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", G.verbatim(F.col("source"), F.col("text")).alias("ok"))


@query("SELECT o_orderkey FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), DATE '1995-06-17') < 7 AND o_orderstatus <> 'F'")
def deferral(spark: SparkSession, sf: str) -> DataFrame:
    put_off = G.deferred(F.col("o_orderdate").cast("date"), F.lit("1995-06-17").cast("date"), F.col("o_orderstatus") != "F")
    return load(spark, sf, "orders").where(put_off).select("o_orderkey")


@query("SELECT user_id, len(xs) = 3 AND len(list_filter(xs, lambda x: x IS NULL)) = 0 AS dense FROM (SELECT user_id, list(CASE WHEN value > 1 THEN value END) AS xs FROM events GROUP BY user_id)")
def charts_eligible(spark: SparkSession, sf: str) -> DataFrame:
    points = load(spark, sf, "events").select("user_id", F.when(F.col("value") > 1, F.col("value")).alias("v"))
    return G.dense_groups(points, "user_id", "v", 3)


@query("SELECT o_orderkey, o_orderstatus || CASE WHEN o_orderpriority <> o_orderstatus THEN ';' || o_orderpriority ELSE '' END || CASE WHEN o_totalprice > 100000 THEN ';large' ELSE '' END AS flags FROM orders")
def provenance_facets(spark: SparkSession, sf: str) -> DataFrame:
    flags = F.array(F.concat("o_orderstatus", F.lit(": a")), F.concat("o_orderpriority", F.lit(" : b:c")), F.concat("o_orderstatus", F.lit(":d")))
    return load(spark, sf, "orders").select("o_orderkey", G.flag_names(flags, F.when(F.col("o_totalprice") > 100000, "large")).alias("flags"))


@query("SELECT doc_id, sha256(CASE WHEN coalesce(source, '') <> '' THEN source || chr(10) || text ELSE text END) AS input FROM documents")
def embed_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", F.sha2(G.embed_input(F.col("source"), F.col("text")), 256).alias("input"))


@query("SELECT o_orderkey, sha256('u' || o_custkey || '|' || o_orderpriority || '|' || strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderstatus = 'P' THEN '|p' ELSE '' END) AS raw_hash FROM orders")
def manual_hashes(spark: SparkSession, sf: str) -> DataFrame:
    of = G.manual_hash(F.concat(F.lit("u"), "o_custkey"), F.col("o_orderpriority"), F.col("o_orderdate"), F.when(F.col("o_orderstatus") == "P", "p"))
    return load(spark, sf, "orders").select("o_orderkey", of.alias("raw_hash"))


@query("SELECT c_custkey, c_name || ': ' || c_mktsegment AS title, nullif(CASE WHEN c_acctbal < 0 THEN '-' ELSE c_mktsegment END, '-') AS summary FROM customer")
def standard_rows(spark: SparkSession, sf: str) -> DataFrame:
    summary = F.when(F.col("c_acctbal") < 0, " - ").otherwise(F.col("c_mktsegment"))
    return load(spark, sf, "customer").select("c_custkey", G.named_title(F.col("c_name"), F.col("c_mktsegment")).alias("title"), G.dash_null(summary).alias("summary"))


@query(f"""WITH f AS (SELECT doc_id, {_FLAT.format("coalesce(text, '')")} AS t FROM documents), a AS (SELECT doc_id, t, greatest(1, instr(lower(t), 'the') - 40) AS s FROM f)
SELECT doc_id, CASE WHEN s > 1 THEN '…' ELSE '' END || substr(t, s, 80) || CASE WHEN length(t) >= s + 80 THEN '…' ELSE '' END AS snip FROM a""")
def snippets(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", G.snippet(F.col("text"), "the").alias("snip"))
