"""Headings, conversion checks and page layout over texts and words made of the driver tables by expressions that both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunking, evaluation, headings, layout, lines
from ..session import load
from .registry import query

_NL = "' || chr(10) || '"
_MD = ("'ANNEX ' || p_partkey || '" + _NL + "' || '" + _NL + "Član' || (p_partkey % 9) || ' ' || (p_partkey % 7) || ' o ' || p_name || '" + _NL + "Article 6 shall apply." + _NL + "GENERAL ' || upper(p_name) || '" + _NL + " " + _NL + "the body" + _NL + "1.' || (p_partkey % 3) || ' ' || (CASE WHEN p_partkey % 2 = 0 THEN 'Scope' ELSE 'scope' END) || '"
       + _NL + "x" + _NL + "EPA 616 XXVIII" + _NL + "## 3. References:" + _NL + "cited ' || p_size || ' work" + _NL + "### Sub" + _NL + "more ' || p_brand || '" + _NL + "## Other" + _NL + "| a | b |" + _NL + "|---|---|" + _NL + "| ' || p_size || ' |" + _NL + "```" + _NL + "# no heading" + _NL + "```'")
_LINES = f"l AS (SELECT p_partkey AS doc_id, unnest(string_split({_MD}, chr(10))) AS line, generate_subscripts(string_split({_MD}, chr(10)), 1) - 1 AS pos FROM part), n AS (SELECT *, coalesce(trim(first_value(CASE WHEN trim(line) <> '' THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)), '') AS nxt FROM l)"


def _markdown(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), F.expr(_MD).alias("text"), "p_size")


_LET = r"'[^\p{L}]', '', 'g'"


@query(rf"""WITH {_LINES}, b AS (SELECT *, regexp_replace(trim(line), '^#{{1,6}}\s+', '') AS s FROM n), w AS (SELECT *, upper(regexp_extract(s, '^(\p{{L}}+)', 1)) AS word, length(s) < 80 AND NOT regexp_matches(s, '[.;]$') AS fits, regexp_replace(s, {_LET}) AS letters,
 CASE WHEN regexp_matches(s, '^\p{{L}}+[0-9]{{1,3}}') THEN rtrim(regexp_replace(s, '^(\p{{L}}+)([0-9]{{1,3}})(?:\s+([0-9]))?\s*(.*)$', '\1 \2\3 \4')) ELSE s END AS unglued FROM b)
SELECT doc_id, pos::INT AS pos, CASE WHEN s = '' THEN line WHEN fits AND word IN ('ANNEX', 'CHAPTER', 'TITLE', 'PART', 'GLAVA', 'PRILOG') THEN '# ' || unglued WHEN fits AND word IN ('SECTION', 'ARTICLE', 'APPENDIX', 'CLAN', 'ČLAN', 'ODJELJAK', 'DIO') THEN '## ' || unglued
 WHEN length(s) <= 100 AND nxt <> '' AND NOT regexp_matches(s, '[.,;:]$') AND length(letters) >= 2 AND length(regexp_replace(letters, '[^\p{{Lu}}]', '', 'g'))::DOUBLE / length(letters) >= 0.7 AND len(string_split_regex(s, '\s+')) >= 2
  AND len(list_filter(string_split_regex(s, '\s+'), lambda x: length(regexp_replace(x, {_LET})) >= 4 AND NOT regexp_matches(regexp_replace(x, {_LET}), '^[IVXLCDM]+$'))) > 0 THEN '## ' || s
 WHEN length(s) < 80 AND NOT ends_with(s, '.') AND nxt <> '' AND regexp_matches(regexp_extract(s, '^[0-9]+(\.[0-9]+)?\.?\s+(.+)$', 2), '^\p{{Lu}}') THEN CASE WHEN regexp_extract(s, '^[0-9]+(\.[0-9]+)?\.?\s+(.+)$', 1) <> '' THEN '### ' ELSE '## ' END || s ELSE s END AS line FROM w""")
def heading_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return headings.promoted(lines.lines(_markdown(spark, sf))).select("doc_id", "pos", "line")


@query(r"SELECT p_partkey AS doc_id, 10 AS start, 'cited ' || p_size || ' work' || chr(10) || '### Sub' || chr(10) || 'more ' || p_brand AS body FROM part")
def citation_sections(spark: SparkSession, sf: str) -> DataFrame:
    return headings.citation_sections(lines.lines(_markdown(spark, sf)))


@query(f"""WITH {_LINES}, f AS (SELECT *, sum(CASE WHEN starts_with(line, '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) % 2 = 1 OR starts_with(line, '```') AS fence FROM l)
SELECT doc_id, count(*) FILTER (trim(line) <> '')::INT AS total, count(*) FILTER (trim(line) <> '' AND (fence OR starts_with(line, '|')))::INT AS markup, count(*) FILTER (trim(line) <> '' AND (fence OR starts_with(line, '|'))) > 0.6 * count(*) FILTER (trim(line) <> '') AS heavy FROM f GROUP BY doc_id""")
def markup_heavy(spark: SparkSession, sf: str) -> DataFrame:
    m = chunking.markup_lines(F.col("text"))
    return _markdown(spark, sf).select("doc_id", m["total"].alias("total"), m["markup"].alias("markup"), chunking.markup_heavy(F.col("text")).alias("heavy"))


_T = "'# T ' || chr(10) || chr(10) || '- one ' || p_name || chr(10) || chr(10) || '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || (CASE WHEN p_size % 3 = 0 THEN chr(10) || '| 1 |' ELSE '' END)"


@query(r"""SELECT p_partkey AS doc_id, array_to_string(list_filter([CASE WHEN p_size % 4 = 0 THEN 'no-headings' END, CASE WHEN r < 0.5 THEN 'text-loss: ' || printf('%.2f', r) END, CASE WHEN p_size % 3 = 0 THEN 'table-ragged: 1' END], lambda x: x IS NOT NULL), '; ') AS defects
FROM (SELECT *, (CASE WHEN p_size % 4 = 0 THEN 4 ELSE 1 END + 4 + length(p_name) + 6 + 6 + CASE WHEN p_size % 3 = 0 THEN 3 ELSE 0 END)::DOUBLE / (20 + p_size * 2) AS r FROM part)""")
def conversion_lint(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("p_size") % 4 == 0, F.replace(F.expr(_T), F.lit("# "), F.lit("T: "))).otherwise(F.expr(_T))
    found = evaluation.conversion_defects(text, F.lit(20) + F.col("p_size") * 2)
    return load(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), F.array_join(found, "; ").alias("defects"))


_A = "'Član ' || p_size || ' and ' || (p_size + 1) || ' of ' || p_name"
_B = "'Clan ' || (CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE p_size + 7 END) || ' and ' || (p_size + 1) || (CASE WHEN p_partkey % 4 = 0 THEN ' of ' || p_name ELSE '' END)"
_SAME = "p_partkey % 3 = 0"


@query(rf"""WITH t AS (SELECT p_partkey, p_size, {_SAME} AS same, {_A} AS a, {_B} AS b FROM part), s AS (SELECT *, list_distinct(list_filter(string_split_regex(lower(a), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) AS x, list_distinct(list_filter(string_split_regex(lower(b), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) AS y FROM t),
r AS (SELECT *, len(list_intersect(x, y))::DOUBLE / len(x) AS r FROM s) SELECT p_partkey, array_to_string(list_filter([CASE WHEN r < 0.8 THEN 'text-loss: ' || printf('%.2f', r) END, CASE WHEN NOT same THEN 'numeric-divergence: witness_only=[' || p_size || '] text_only=[' || (p_size + 7) || ']' END], lambda v: v IS NOT NULL), '; ') AS defects FROM r""")
def witness_check(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select("p_partkey", F.array_join(evaluation.witness_defects(F.expr(_A), F.expr(_B)), "; ").alias("defects"))


@query(f"""SELECT p_partkey, round(levenshtein(trim('Art ' || p_size), trim('# Art ' || (p_size + p_partkey % 2)).replace('# ', ''))::DOUBLE / length('Art ' || p_size), 6) AS cer, 1.0::DOUBLE AS accents, (p_partkey % 2)::INT AS numbers_missing, (p_partkey % 2)::INT AS numbers_added, 1 AS headings, (1 - p_partkey % 2)::INT AS headings_found FROM part""")
def page_scores(spark: SparkSession, sf: str) -> DataFrame:
    gold, text = F.expr("'# Art ' || p_size"), F.expr("'# Art ' || (p_size + p_partkey % 2)")
    s = evaluation.page_score(gold, text)
    return load(spark, sf, "part").select("p_partkey", s.alias("s")).select("p_partkey", F.round("s.cer", 6).alias("cer"), "s.accents", "s.numbers_missing", "s.numbers_added", "s.headings", "s.headings_found")


@query(f"""SELECT p_partkey, 'a' AS "left", 'b' AS "right", CASE WHEN {_SAME} THEN '' ELSE '' || p_size END AS numbers_left, CASE WHEN {_SAME} THEN '' ELSE '' || (p_size + 7) END AS numbers_right FROM part""")
def divergence(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    both = p.select("p_partkey", F.lit("a").alias("name"), F.expr(_A).alias("text")).unionByName(p.select("p_partkey", F.lit("b").alias("name"), F.expr(_B).alias("text")))
    d = evaluation.divergence(both, "p_partkey", "name", "text")
    return d.select("p_partkey", "left", "right", F.array_join("numbers_left", ",").alias("numbers_left"), F.array_join("numbers_right", ",").alias("numbers_right"))


_W = """SELECT l_orderkey AS page, l_partkey * 10 + l_linenumber AS id, CAST(CASE WHEN l_linenumber % 2 = 0 THEN 50 + l_suppkey % 60 ELSE 330 + l_suppkey % 90 END AS DOUBLE) AS x0, CAST(CASE WHEN l_linenumber % 2 = 0 THEN 150 + l_suppkey % 90 + (l_partkey % 5) * 30 ELSE 480 END AS DOUBLE) AS x1,
 CAST(100 + l_linenumber * 40 + (l_partkey % 3) AS DOUBLE) AS top, CAST(112 + l_linenumber * 40 + (l_partkey % 3) AS DOUBLE) AS bottom, 'w' || l_partkey AS text FROM lineitem"""


def _words(spark: SparkSession, sf: str) -> DataFrame:
    load(spark, sf, "lineitem").createOrReplaceTempView("quern_lineitem")
    return spark.sql(_W.replace("FROM lineitem", "FROM quern_lineitem"))


@query(f"""WITH w AS ({_W}), b AS (SELECT DISTINCT page, unnest(range(floor(x0 / 2)::BIGINT, floor(x1 / 2)::BIGINT + 1)) AS bin FROM w), g AS (SELECT page, (lag(bin) OVER (PARTITION BY page ORDER BY bin) + 1) * 2.0 AS a, bin * 2.0 AS b FROM b),
f AS (SELECT * FROM g WHERE b - a >= 14 AND (a + b) / 2 BETWEEN 180 AND 420), s AS (SELECT page, a, b, max((x1 <= a)::INT) AS l, max((x0 >= b)::INT) AS r, max(top) FILTER (x1 <= a OR x0 >= b) - min(top) FILTER (x1 <= a OR x0 >= b) AS span, greatest(max(bottom) - min(top), 1) AS h FROM w JOIN f USING (page) GROUP BY ALL)
SELECT page, round(arg_max((a + b) / 2, (b - a, -a)), 6)::DOUBLE AS split FROM s WHERE l = 1 AND r = 1 AND span >= 0.45 * h GROUP BY page""")
def page_columns(spark: SparkSession, sf: str) -> DataFrame:
    return layout.columns(_words(spark, sf), ["page"], 600.0).select("page", F.round("split", 6).alias("split"))


@query(f"""WITH w AS (SELECT page, row_number() OVER (PARTITION BY page ORDER BY top, id) AS line, top + id % 7 * 3 AS top, bottom + id % 7 * 3 AS bottom, text FROM ({_W})), g AS (SELECT *, top - lag(bottom) OVER (PARTITION BY page ORDER BY line) AS g FROM w),
m AS (SELECT page, coalesce(list_sort(list(g) FILTER (g IS NOT NULL))[count(g) // 2 + 1], 0) AS m FROM g GROUP BY page), p AS (SELECT page, line, text, sum(CASE WHEN m > 0 AND g > 1.6 * m THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY line) AS paragraph FROM g JOIN m USING (page))
SELECT page, paragraph::BIGINT AS paragraph, string_agg(text, ' ' ORDER BY line) AS text FROM p GROUP BY 1, 2""")
def page_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    w = _words(spark, sf)
    w = w.withColumn("line", F.row_number().over(Window.partitionBy("page").orderBy("top", "id"))).withColumns({"top": F.col("top") + F.col("id") % 7 * 3, "bottom": F.col("bottom") + F.col("id") % 7 * 3})
    return layout.paragraphs(w, ["page"])


@query(f"""SELECT id, left(sha256(page || '|' || round_even(x0, 0)::BIGINT || ',' || round_even(top, 0)::BIGINT || ',' || round_even(x1, 0)::BIGINT || ',' || round_even(bottom, 0)::BIGINT || '|a|' || text), 12) AS hash, least(x1 - x0, bottom - top) >= 4 AND (x1 - x0) * (bottom - top) <= 0.85 * 480000 AS usable, CASE WHEN id % 4 = 0 THEN 1 WHEN id % 4 = 1 THEN 2 END AS level FROM ({_W})""")
def region_scalars(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    size = F.when(c("id") % 4 == 0, 20.2).when(c("id") % 4 == 1, 16.0).otherwise(11.0)
    return _words(spark, sf).select("id", layout.region_hash(c("page"), c("x0"), c("top"), c("x1"), c("bottom"), F.array(c("text"), F.lit("a"))).alias("hash"), layout.usable(c("x1") - c("x0"), c("bottom") - c("top"), 480000.0).alias("usable"), layout.heading_level(size, F.array(F.lit(20.0), F.lit(16.2))).alias("level"))


_SEE = "'See ' || url || ').' || chr(10) || 'no link here' || chr(10) || 'and <' || url || '?page=' || page_id || '>, \"' || url || '\"'"


@query(rf"""SELECT page_id, url, line AS context FROM (SELECT page_id, line, unnest(regexp_extract_all(line, 'https?://[^ \t\n\r<>"'')]+[A-Za-z0-9/]')) AS url FROM (SELECT page_id, unnest(string_split({_SEE}, chr(10))) AS line FROM pages))""")
def printed_page_urls(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import links

    pages = load(spark, sf, "pages").select("page_id", F.expr(_SEE).alias("text"))
    return links.printed_urls(lines.lines(pages, "page_id"), "page_id")


_PATHS = "'intro' || chr(10) || '# ' || p_brand || chr(10) || 'a' || chr(10) || '## ' || p_type || ' #' || chr(10) || 'b' || chr(10) || '```' || chr(10) || '# no' || chr(10) || '```' || chr(10) || '# Z' || chr(10) || '### Deep' || chr(10) || 'c'"


@query("""SELECT p_partkey AS doc_id, pos::INT AS pos, CASE WHEN pos < 3 THEN p_brand WHEN pos < 8 THEN p_brand || ' › ' || p_type WHEN pos = 8 THEN 'Z' ELSE 'Z › Deep' END AS breadcrumb FROM (SELECT *, unnest(range(1, 11)) AS pos FROM part)""")
def heading_paths(spark: SparkSession, sf: str) -> DataFrame:
    own = load(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), F.expr(_PATHS).alias("text"))
    return lines.breadcrumbs(lines.lines(own)).where("breadcrumb <> ''").select("doc_id", "pos", "breadcrumb")


@query("SELECT o_orderkey AS id, o_orderkey + 1 AS target FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey + 1 NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)")
def dangling_relations(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = load(spark, sf, "orders")
    return o.where(k % 3 == 0).select(k.alias("id"), (k + 1).alias("target")).join(o.where(k % 2 == 0).select(k.alias("target")), "target", "left_anti").select("id", "target")
