"""Scalar functions, lines, links, citations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import citations, evaluation, lines, links
from ..session import load
from .registry import query


@query(r"""SELECT page_id, CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) = '' THEN url ELSE
 'https://' || lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) || regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') || regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) END AS norm FROM pages""")
def normalize_url(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", T.normalize_url(F.col("url")).alias("norm"))


@query(r"SELECT doc_id, regexp_replace(lower(string_split(text, chr(10))[1]), '[^\p{L}\p{N}]+', '', 'g') AS title FROM documents")
def normalized_title(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", T.normalized_title(F.get(F.split("text", "\n"), F.lit(0))).alias("title"))


@query(r"""SELECT page_id, CASE WHEN lower(regexp_extract(url, '\.([A-Za-z0-9]{2,5})(?:[?#].*)?$', 1)) IN ('pdf','docx','xlsx','pptx','csv','json','xml','txt')
 THEN lower(regexp_extract(url, '\.([A-Za-z0-9]{2,5})(?:[?#].*)?$', 1)) ELSE 'html' END AS hint, regexp_matches(url, '^https?://[^\s/@\x00-\x1f]+(?:[/?#][^\s\x00-\x1f]*)?$') AS safe FROM pages""")
def format_hint(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", T.format_hint(F.col("url")).alias("hint"), T.safe_url(F.col("url")).alias("safe"))


@query("SELECT doc_id, sha256(lang || chr(0) || text) AS hash FROM documents")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", T.content_hash(F.col("text"), F.col("lang")).alias("hash"))


@query(r"SELECT doc_id, length(trim(regexp_replace(text, '[ \t\n\r\f\x0B]+', ' ', 'g'))) AS n FROM documents")
def ws_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", F.length(T.ws_normalize(F.col("text"))).cast("long").alias("n"))


@query(r"""SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN regexp_matches(line, '^#{1,6} ') THEN 1 ELSE 0 END)::BIGINT AS n_headings,
 count(nullif(length(line) - length(replace(line, '|', '')), 0)) AS n_table_rows FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""")
def lint(spark: SparkSession, sf: str) -> DataFrame:
    ls = lines.lines(load(spark, sf, "documents"))
    n = ls.groupBy("doc_id").agg(F.count("*").alias("n_lines"))
    return evaluation.lint(ls).join(n, "doc_id").select("doc_id", "n_lines", F.col("n_headings").cast("long").alias("n_headings"), "n_table_rows")


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
m AS (SELECT *, length(line) >= 40 AS m, sum(CASE WHEN length(line) >= 40 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM l)
SELECT doc_id, min(pos)::INT AS start, max(pos)::INT AS stop, count(*) AS n FROM m WHERE m GROUP BY doc_id, i HAVING count(*) >= 3""")
def dense_runs(spark: SparkSession, sf: str) -> DataFrame:
    return lines.runs(lines.lines(load(spark, sf, "documents")), "doc_id", "pos", F.length("line") >= 40, 3)


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
SELECT doc_id, pos::INT AS pos, md5(first_value(CASE WHEN trim(line) <> '' THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS next_line FROM l""")
def next_nonblank(spark: SparkSession, sf: str) -> DataFrame:
    return lines.next_nonblank(lines.lines(load(spark, sf, "documents"))).select("doc_id", "pos", F.md5("next_line").alias("next_line"))


@query(r"""WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN md5(text) END AS v FROM conversations)
SELECT conv_id, turn, last_value(v IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS filled FROM c""")
def forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "conversations")
    return lines.forward_fill(c, "conv_id", "turn", F.when(F.col("role") == "user", F.md5("text"))).select("conv_id", "turn", "filled")


@query()
def breadcrumbs(spark: SparkSession, sf: str) -> DataFrame:
    return lines.breadcrumbs(lines.lines(load(spark, sf, "documents"))).where("breadcrumb <> ''").select("doc_id", "pos", "breadcrumb")


_LINKS = """WITH x AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"#][^"]*)"[^>]*>([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"#][^"]*)"[^>]*>([^<]*)</a>', 2) AS a FROM pages),
y AS (SELECT page_id, url, unnest(h) AS href, unnest(a) AS anchor, generate_subscripts(h, 1) - 1 AS pos FROM x)
SELECT page_id, pos::INT AS pos, href, CASE WHEN href[1] = '/' THEN regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || href ELSE href END AS target FROM y"""


@query(_LINKS)
def html_links(spark: SparkSession, sf: str) -> DataFrame:
    return links.html_links(load(spark, sf, "pages")).select("page_id", "pos", "href", "target")


@query(r"""SELECT doc_id, url, md5(line) AS context FROM (SELECT doc_id, line, unnest(regexp_extract_all(line, 'https?://[^ \t\n\r<>"'')]+[A-Za-z0-9/]')) AS url
 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))""")
def printed_urls(spark: SparkSession, sf: str) -> DataFrame:
    return links.printed_urls(lines.lines(load(spark, sf, "documents"))).select("doc_id", "url", F.md5("context").alias("context"))


_RULES = r"""r AS (
 SELECT doc_id, upper(unnest(regexp_extract_all(text, '\b[1-9][0-9]{4}[A-Z]{1,2}[0-9]{4}\b'))) AS identifier, 'celex' AS rule FROM documents UNION ALL
 SELECT doc_id, unnest(regexp_extract_all(text, '\bISO(?:/IEC)? [0-9]{4,5}(?:-[0-9]+)?\b')), 'iso' FROM documents UNION ALL
 SELECT doc_id, lower(unnest(regexp_extract_all(text, '\b(?:MIT|Apache|GNU General Public) License\b'))), 'license' FROM documents UNION ALL
 SELECT doc_id, unnest(regexp_extract_all(text, '\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b')), 'ipv4' FROM documents UNION ALL
 SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'))), 'email' FROM documents),
f AS (SELECT doc_id, identifier, min(rule) AS rule FROM r GROUP BY 1, 2),
o AS (SELECT identifier, min(doc_id) AS owner FROM f GROUP BY 1 HAVING count(DISTINCT doc_id) > 1)"""


@query(f"WITH {_RULES} SELECT * FROM f")
def cites_extract(spark: SparkSession, sf: str) -> DataFrame:
    return citations.extract(load(spark, sf, "documents"))


def _owners(found: DataFrame) -> DataFrame:
    return found.groupBy("identifier").agg(F.min("doc_id").alias("owner"), F.countDistinct("doc_id").alias("n")).where("n > 1").select("identifier", "owner")


@query(f"WITH {_RULES} SELECT doc_id AS source_id, owner AS target_id, identifier, rule FROM f JOIN o USING (identifier) WHERE doc_id <> owner")
def cites_resolve(spark: SparkSession, sf: str) -> DataFrame:
    found = citations.extract(load(spark, sf, "documents"))
    return citations.resolve(found, _owners(found))


@query(f"WITH {_RULES} SELECT identifier, min(rule) AS rule, count(DISTINCT doc_id) AS n_cited_by, min(doc_id) AS first_cited_by FROM f WHERE identifier NOT IN (SELECT identifier FROM o) GROUP BY 1")
def cite_leads(spark: SparkSession, sf: str) -> DataFrame:
    found = citations.extract(load(spark, sf, "documents"))
    return citations.leads(found, _owners(found))


@query(r"SELECT event_id, CAST(regexp_extract(props, '\"k\" *: *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query(r"""SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM part""")
def slugs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select("p_partkey", T.slug(F.col("p_name")).alias("slug"))
