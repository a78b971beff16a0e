"""Record maps over rows made of the driver tables by expressions that both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mapping
from ..session import load
from .registry import query

_AG = """SELECT o_orderkey AS native_id, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'Act ' || o_orderkey END AS official_name, 'Casual ' || o_custkey AS casual_name, 'Issuer ' || (o_custkey % 9) AS authority, CASE WHEN o_custkey % 3 = 0 THEN ' ' ELSE 'J' || (o_custkey % 5) END AS jurisdiction,
 CASE WHEN o_orderkey % 7 = 0 THEN 'ftp://x' ELSE 'https://a.gov/' || o_orderkey || '.pdf' END AS link, CASE WHEN o_orderkey % 5 = 0 THEN 'Enacted' END AS activity, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS activity_date, CAST(o_orderdate AS DATE) AS proposed_date,
 'Summary ' || o_orderpriority AS summary, o_orderkey % 2 = 0 AS machine, o_orderpriority || '; ;x ' AS tags, o_orderkey % 6 = 0 AS probe, o_orderpriority AS haystack FROM orders"""


def _view(spark: SparkSession, sf: str, sql: str, *tables: str) -> DataFrame:
    for t in tables:
        load(spark, sf, t).createOrReplaceTempView(f"quern_{t}")
        sql = sql.replace(f"FROM {t}", f"FROM quern_{t}")
    return spark.sql(sql)


@query(f"""SELECT '' || native_id AS native_id, CASE WHEN official_name = '' THEN casual_name ELSE official_name END AS title, nullif(trim(jurisdiction), '') AS jurisdiction, coalesce(activity_date, proposed_date) AS doc_date, link AS source_url,
 CASE WHEN NOT machine THEN summary END AS native_summary, trim(string_split(tags, ';')[1]) || '|x' || CASE WHEN activity IS NOT NULL THEN '|activity: ' || activity ELSE '' END || CASE WHEN probe THEN '|probe (matched: ' || CASE WHEN regexp_matches(haystack, '(?i)\\burgent\\b') THEN 'urgent' ELSE '' END || ')' ELSE '' END AS native_tags,
 sha256(native_id || '|' || official_name || '|' || link || '|' || coalesce('' || activity_date, 'None')) AS raw_hash FROM ({_AG}) WHERE link LIKE 'https%'""")
def registry_candidates(spark: SparkSession, sf: str) -> DataFrame:
    c = mapping.registry_row(_view(spark, sf, _AG, "orders"), ["urgent"])
    return c.select("native_id", "title", "jurisdiction", "doc_date", "source_url", "native_summary", F.array_join("native_tags", "|").alias("native_tags"), "raw_hash")


_OE = """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE 'Plan ' || (c_custkey % 40) END AS en, 'Orig ' || c_custkey AS orig, CASE WHEN c_custkey % 4 = 0 THEN 'n/a' ELSE 'https://s.org/' || (c_custkey % 60) END AS site, CASE WHEN c_custkey % 5 < 3 THEN 'http://r.org/' || c_custkey || '.docx' END AS rel,
 CASE WHEN c_custkey % 2 = 0 THEN 'Land ' || c_nationkey END AS country, c_mktsegment AS category, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 2000 + c_custkey % 25 END AS year FROM customer"""


@query(f"""WITH r AS (SELECT *, coalesce(nullif(trim(en), ''), orig) AS title, coalesce(CASE WHEN site LIKE 'http%' THEN site END, rel) AS url FROM ({_OE})),
a AS (SELECT site FROM r WHERE site LIKE 'http%' GROUP BY site HAVING count(DISTINCT regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}]+', '', 'g')) > 1)
SELECT '' || id AS native_id, title, coalesce(country, 'IGO') AS jurisdiction, nullif(year, 0) AS doc_year, url AS source_url, 'category: ' || category AS native_tags, CASE WHEN site IN (SELECT site FROM a) THEN 'suspect' ELSE 'stated' END AS url_provenance, sha256(id || '|' || trim(en) || '|None') AS raw_hash FROM r WHERE url IS NOT NULL""")
def initiative_candidates(spark: SparkSession, sf: str) -> DataFrame:
    r = _view(spark, sf, _OE, "customer").select(F.struct(
        "id", F.col("en").alias("englishName"), F.col("orig").alias("originalName"), F.col("site").alias("website"), F.array("rel").alias("relevantUrls"), F.struct(F.col("country").alias("name")).alias("gaiinCountry"),
        F.struct(F.lit("IGO").alias("name")).alias("intergovernmentalOrganisation"), F.lit("Org").alias("responsibleOrganisation"), F.lit("d").alias("description"), "category", F.struct(F.lit(None).cast("string").alias("name")).alias("initiativeType"),
        F.lit(None).cast("string").alias("extentBinding"), F.col("year").alias("startYear"), F.lit(None).cast("string").alias("updatedAt"),
    ).alias("x"))
    n = r.count()
    pages = r.groupBy(F.lit(1).alias("page")).agg(F.collect_list("x").alias("data")).select("page", F.lit(1).alias("last_page"), F.lit(n).alias("total"), "data") if n <= 20_000 else None
    rows = mapping.checked_pages(pages) if pages is not None else r.select("x.*")
    return mapping.initiative_row(rows).select("native_id", "title", "jurisdiction", "doc_year", "source_url", F.array_join("native_tags", "|").alias("native_tags"), "url_provenance", "raw_hash")


_SP = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem"
_JS = """'{"results":{"bindings":[{"celex":{"value":"' || (CASE l_orderkey % 3 WHEN 0 THEN '3' WHEN 1 THEN '5' ELSE '9' END) || '2020' || (CASE l_orderkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'DC' WHEN 2 THEN 'L' ELSE 'Q' END) || lpad('' || l_orderkey, 7, '0') || '"}' || (CASE WHEN l_linenumber > 1 THEN ',"title":{"value":"T' || l_partkey || '"}' ELSE '' END) ||
 ',"date":{"value":"' || (CASE WHEN l_suppkey % 5 = 0 THEN 'soon' ELSE '2020-0' || (1 + l_suppkey % 9) || '-15T00:00' END) || '"},"author":{"value":"A' || (l_suppkey % 4) || '"},"concept":{"value":"http://c/' || (l_partkey % 6) || '"}}]}}'"""


@query("""WITH r AS (SELECT (CASE l_orderkey % 3 WHEN 0 THEN '3' WHEN 1 THEN '5' ELSE '9' END) || '2020' || (CASE l_orderkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'DC' WHEN 2 THEN 'L' ELSE 'Q' END) || lpad('' || l_orderkey, 7, '0') AS celex, (l_linenumber, l_partkey, l_suppkey) AS o, CASE WHEN l_linenumber > 1 THEN 'T' || l_partkey END AS title,
 CASE WHEN l_suppkey % 5 = 0 THEN 'soon' ELSE '2020-0' || (1 + l_suppkey % 9) || '-15T00:00' END AS date, 'A' || (l_suppkey % 4) AS author, '' || (l_partkey % 6) AS concept FROM lineitem),
g AS (SELECT celex, arg_min(title, o) FILTER (title IS NOT NULL) AS title, arg_min(date, o) AS date, string_agg(DISTINCT author, ' / ' ORDER BY author) AS issuer, string_agg(DISTINCT concept, ', ' ORDER BY concept) AS concepts FROM r GROUP BY celex)
SELECT celex AS native_id, title, issuer, try_cast(left(date, 10) AS DATE) AS doc_date, 'https://eur-lex.europa.eu/legal-content/EN/TXT/HTML/?uri=CELEX:' || celex AS source_url, 'EUR-Lex: ' || (CASE celex[1] WHEN '3' THEN 'legal act' WHEN '5' THEN 'preparatory act' ELSE 'other' END) || ', ' || (CASE regexp_extract(celex, '^[0-9]{5}([A-Z]+)', 1) WHEN 'R' THEN 'Regulation' WHEN 'DC' THEN 'communication/notice' WHEN 'L' THEN 'Directive' ELSE 'Q' END) || '|concepts: ' || concepts AS native_tags,
 sha256(celex || '|' || coalesce('' || try_cast(left(date, 10) AS DATE), 'None') || '|' || title || '|' || issuer) AS raw_hash FROM g WHERE title IS NOT NULL""")
def act_candidates(spark: SparkSession, sf: str) -> DataFrame:
    j = _view(spark, sf, f"SELECT l_linenumber, l_partkey, l_suppkey, {_JS} AS body FROM lineitem", "lineitem")
    names = ["celex", "title", "date", "author", "concept"]
    rows = j.select("l_linenumber", "l_partkey", "l_suppkey", F.from_json("body", f"struct<results:struct<bindings:array<struct<{','.join(f'{n}:struct<value:string>' for n in names)}>>>>")["results"]["bindings"].alias("b"))
    rows = rows.select(F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ordinal"), F.explode_outer("b").alias("x")).where("x is not null").select("ordinal", *[F.col(f"x.{n}.value").alias(n) for n in names])
    c = mapping.act_row(mapping.group_acts(rows))
    return c.select("native_id", "title", "issuer", "doc_date", "source_url", F.array_join("native_tags", "|").alias("native_tags"), "raw_hash")


_LK = """SELECT page_id AS source_id, url, CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'HTTP://in.text/' WHEN 2 THEN ' Machine Learning guide ' ELSE 'https://stated.title' END AS anchor, CASE page_id % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'citation' ELSE 'html' END AS kind, CASE WHEN page_id % 2 = 0 THEN page_id % 7 END AS page FROM pages"""


@query(rf"""WITH r AS (SELECT *, trim(anchor) AS a, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path FROM ({_LK}))
SELECT source_id || CASE WHEN kind = 'pdf' AND page IS NOT NULL THEN '#p' || page ELSE '#' || kind END AS native_id, coalesce(nullif(CASE WHEN kind <> 'citation' AND regexp_matches(lower(a), '^https?://') THEN '' ELSE a END, ''), nullif(regexp_extract(path, '([^/]*)$', 1), ''), host) AS title, CASE WHEN kind = 'citation' THEN 'stated' ELSE 'derived' END AS title_provenance, nullif(a, '') AS native_summary,
 sha256('snowball|https://' || host || path || regexp_extract(url, '^[^?#]*(\?[^#]*)', 1)) AS raw_hash, CASE WHEN a LIKE '%achine%' THEN 'machine-learning' ELSE '' END AS matched_tags FROM r""")
def link_maps(spark: SparkSession, sf: str) -> DataFrame:
    c = mapping.link_row(_view(spark, sf, _LK, "pages"), {"machine-learning": "machine learning", "law": "law of"})
    return c.select("native_id", "title", "title_provenance", "native_summary", "raw_hash", F.array_join("matched_tags", ",").alias("matched_tags"))


_CD = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'T' || o_orderkey END AS title, CASE WHEN o_orderkey % 4 <> 0 THEN 'I' || o_custkey END AS issuer, CASE WHEN o_orderkey % 5 = 0 THEN 'en' END AS language, 'https://x/' || o_orderkey AS source_url, CASE WHEN o_orderkey % 6 = 0 THEN 'old' || (o_orderkey % 12) END AS supersedes, CASE WHEN o_orderkey % 7 = 0 THEN 'derived' ELSE 'stated' END AS tp, CASE WHEN o_orderkey % 9 = 0 THEN 'suspect' END AS up, o_orderdate FROM orders"
_DC = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'Curated ' || o_orderkey END AS title, NULL AS issuer, 'de' AS language, NULL AS source_url, o_orderkey % 12 = 6 AS has FROM orders WHERE o_orderkey % 3 = 0"


@query(f"""SELECT c.k, coalesce(d.title, c.title) AS title, c.issuer, d.language AS language, c.source_url, CASE WHEN d.has THEN 'supersedes>old6' || CASE WHEN c.supersedes IS NOT NULL AND c.supersedes <> 'old6' THEN ',supersedes>' || c.supersedes ELSE '' END WHEN c.supersedes IS NOT NULL THEN 'supersedes>' || c.supersedes ELSE '' END AS relations FROM ({_CD}) c JOIN ({_DC}) d ON c.k = d.k""")
def promoted_records(spark: SparkSession, sf: str) -> DataFrame:
    d = _view(spark, sf, _DC, "orders").select("k", "title", F.col("issuer").cast("string").alias("issuer"), "language", F.col("source_url").cast("string").alias("source_url"), F.when(F.col("has"), F.array(F.struct(F.lit("supersedes").alias("type"), F.lit("old6").alias("target")))).alias("relations"))
    r = mapping.promote(_view(spark, sf, _CD, "orders"), d, "k", ["title", "issuer", "language", "source_url"])
    return r.withColumn("relations", F.array_join(F.transform("relations", lambda x: F.concat(x["type"], F.lit(">"), x["target"])), ","))


@query(f"""SELECT k, rtrim(CASE WHEN title IS NULL OR tp = 'derived' THEN 'title,' ELSE '' END || CASE WHEN issuer IS NULL THEN 'issuer,' ELSE '' END || CASE WHEN language IS NULL THEN 'language,' ELSE '' END || CASE WHEN up = 'suspect' THEN 'source_url,' ELSE '' END, ',') AS missing FROM ({_CD})""")
def missing_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, _CD, "orders").select("k", F.array_join(mapping.missing_fields(F.col("tp"), F.col("up")), ",").alias("missing"))


@query(f"""WITH r AS (SELECT k, CASE WHEN k % 3 = 0 THEN year(o_orderdate) WHEN k % 3 = 1 THEN 1995 END AS y, CASE WHEN k % 4 <> 0 THEN o_orderdate END AS d, CASE k % 4 WHEN 0 THEN 'report' WHEN 1 THEN 'legislation' WHEN 2 THEN 'framework' ELSE 'poem' END AS t, CASE WHEN k % 5 = 0 THEN 'Montenegro' END AS j, CASE k % 3 WHEN 0 THEN 'academia' ELSE 'igo' END AS i FROM ({_CD}))
SELECT k, coalesce(y, year(d))::INT AS doc_year, coalesce(y <> year(d), false) AS contradiction, CASE t WHEN 'report' THEN 'report' WHEN 'legislation' THEN 'binding_law' WHEN 'framework' THEN 'soft_law' END AS authority, CASE WHEN j IS NOT NULL THEN 'target-entity' WHEN i = 'academia' THEN 'research-papers' ELSE 'intl-xperience' END AS track,
 nullif(CASE WHEN k % 6 = 0 THEN 'archived_snapshot' || CASE WHEN k % 4 = 1 THEN ';no-headings' ELSE '' END WHEN k % 4 = 1 THEN 'no-headings' ELSE '' END, '') AS note FROM r""")
def record_defaults(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    d = F.when(k % 4 != 0, F.col("o_orderdate"))
    year, odd = mapping.doc_year(F.when(k % 3 == 0, F.year("o_orderdate")).when(k % 3 == 1, 1995), d)
    kind = F.when(k % 4 == 0, "report").when(k % 4 == 1, "legislation").when(k % 4 == 2, "framework").otherwise("poem")
    note = mapping.provenance_note(F.when(k % 6 == 0, "archived_snapshot").otherwise("live"), F.when(k % 4 == 1, "no-headings").otherwise(""))
    track = mapping.track(F.when(k % 5 == 0, "Montenegro"), F.when(k % 3 == 0, "academia").otherwise("igo"), ["Montenegro"])
    return _view(spark, sf, _CD, "orders").select("k", year.alias("doc_year"), odd.alias("contradiction"), mapping.authority(kind).alias("authority"), track.alias("track"), note.alias("note"))


@query("WITH u AS (SELECT 'c0' AS c, 0 AS p, o_orderkey AS o, 'k' || (o_custkey % 400) AS key FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'c1', 1, c_custkey, CASE WHEN c_custkey % 10 > 0 THEN 'k' || (c_custkey % 700) END FROM customer), f AS (SELECT *, key IS NULL OR row_number() OVER (PARTITION BY key ORDER BY p, o) = 1 AS fresh FROM u) SELECT c, count(*) AS found, count(*) FILTER (fresh) AS fresh, count(*) FILTER (NOT fresh) AS merged FROM f GROUP BY c")
def connector_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    a = load(spark, sf, "orders").where("o_orderkey % 2 = 0").select(F.lit("c0").alias("c"), F.col("o_orderkey").cast("long").alias("o"), F.concat(F.lit("k"), F.col("o_custkey") % 400).alias("key"))
    b = load(spark, sf, "customer").select(F.lit("c1").alias("c"), F.col("c_custkey").cast("long").alias("o"), F.when(F.col("c_custkey") % 10 > 0, F.concat(F.lit("k"), F.col("c_custkey") % 700)).alias("key"))
    return mapping.diagnostics(mapping.fresh(mapping.ordered_union([a, b], "o"), F.col("key")), "c")


@query(r"""SELECT p_partkey, array_to_string(list_filter([trim(p_name), trim(p_brand || ' '), CASE WHEN trim('' || p_size) <> '' AND false THEN '' END], lambda x: x IS NOT NULL), '|') AS captions, [CASE WHEN p_size % 2 = 0 THEN p_size END, CASE WHEN p_size % 3 = 0 THEN p_size * 2 END, NULL]::VARCHAR AS dense,
 CASE WHEN p_partkey % 702 >= 26 THEN chr((65 + (p_partkey % 702) // 26 - 1)::INT) ELSE '' END || chr((65 + (p_partkey % 702) % 26)::INT) || (p_size + 1) AS cell FROM part""")
def chart_scalars(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    points = F.map_filter(F.create_map(F.lit(0), F.when(F.col("p_size") % 2 == 0, F.col("p_size")), F.lit(1), F.when(F.col("p_size") % 3 == 0, F.col("p_size") * 2)), lambda k, v: v.isNotNull())
    shown = F.concat(F.lit("["), F.array_join(mapping.dense(points, F.lit(3)), ", ", "NULL"), F.lit("]"))
    captions = mapping.caption_texts(F.array(F.col("p_name"), F.concat("p_brand", F.lit(" ")), F.col("p_size").cast("string"), F.col("p_brand"), F.lit(" ")))
    return p.select("p_partkey", F.array_join(captions, "|").alias("captions"), shown.alias("dense"), mapping.cell_name(F.col("p_partkey") % 702, F.col("p_size")).alias("cell"))
