"""Legal citations, acquisition and rechecks. The driver tables hold no responses or citations, so these are made of them by expressions that
both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import acquire, legal
from ..session import load
from .registry import query

_TEXT = """CASE o_orderkey % 7 WHEN 0 THEN 'Regulation (EU) ' || (2000 + o_orderkey % 60) || '/' || (o_orderkey % 2000) || ' and 32024R1689'
 WHEN 1 THEN 'Regulation (EEC) No ' || (o_orderkey % 3000) || '/' || (50 + o_orderkey % 50) WHEN 2 THEN 'Directives ' || year(o_orderdate) || '/' || (o_orderkey % 900) || '/EC'
 WHEN 3 THEN 'Službeni list CG, br. ' || (o_orderkey % 90) || '/20, ' || (o_orderkey % 30) || '/2021 i 04/24' WHEN 4 THEN 'ISO/IEC ' || (27000 + o_orderkey % 100) || '-' || (o_orderkey % 5) || ':2022 or ISO 9001.'
 WHEN 5 THEN 'NIST SP 800-' || (o_orderkey % 200) || 'a, NIST AI 100-' || (o_orderkey % 3) || ', xEU AI Act' ELSE 'https://data.europa.eu/eli/reg/2024/' || (o_orderkey % 1000) || '/oj, Decision 768/2008/EC, the eu ai act' END"""


def _act(kind: str, year: str, number: str) -> str:
    full = f"CASE WHEN {year} < 100 THEN {year} + 1900 ELSE {year} END"
    letter = f"CASE lower({kind}) WHEN 'regulation' THEN 'R' WHEN 'directive' THEN 'L' WHEN 'decision' THEN 'D' WHEN 'reg' THEN 'R' WHEN 'dir' THEN 'L' ELSE 'D' END"
    return f"CASE WHEN ({full}) BETWEEN 1950 AND 2049 THEN 'CELEX:3' || lpad(({full})::VARCHAR, 4, '0') || ({letter}) || lpad({number}::VARCHAR, 4, '0') END"


def _all(rx: str, i: str = "0") -> str:
    return f"unnest(regexp_extract_all(text, '{rx}', {i})) AS x"


_KIND = "regexp_extract(x, '^(Regulation|Directive|Decision)', 1)"
_A, _B = (f"regexp_extract(x, '([0-9]{{1,4}})\\s*/\\s*([0-9]{{1,4}})$', {k})::INT" for k in (1, 2))
_S1, _S2 = (f"regexp_extract(x, '([0-9]{{2,4}})\\s*/\\s*([0-9]{{1,4}})\\s*/', {k})::INT" for k in (1, 2))
_E1, _E2, _E3 = (f"regexp_extract(x, '/eli/(reg|dir|dec)/([0-9]{{4}})/([0-9]{{1,4}})$', {k})" for k in (1, 2, 3))
_NO = r"regexp_matches(x, '\)\s+No\s')"
_EU = _act(_KIND, f"(CASE WHEN {_NO} THEN {_B} ELSE {_A} END)", f"(CASE WHEN {_NO} THEN {_A} ELSE {_B} END)")
_CITES = rf"""WITH t AS (SELECT o_orderkey AS doc_id, {_TEXT} AS text FROM orders), f AS (
 SELECT doc_id, 'CELEX:' || x AS identifier, 'celex' AS rule FROM (SELECT doc_id, {_all(r'\b3[0-9]{4}[LRDE][0-9]{4}\b')} FROM t)
 UNION ALL SELECT doc_id, {_EU}, 'eu_act' FROM (SELECT doc_id, {_all(r'\b(?:Regulation|Directive|Decision)s?\s+\((?:EU|EC|EEC|Euratom)\)\s+(?:No\s+)?[0-9]{1,4}\s*/\s*[0-9]{1,4}\b')} FROM t)
 UNION ALL SELECT doc_id, {_act(_KIND, _S1, _S2)}, 'eu_act_slash' FROM (SELECT doc_id, {_all(r'\b(?:Directive|Decision|Regulation)s?\s+[0-9]{2,4}\s*/\s*[0-9]{1,4}\s*/\s*(?:EC|EEC|EU|Euratom)\b')} FROM t)
 UNION ALL SELECT doc_id, {_act(_E1, _E2 + '::INT', _E3 + '::INT')}, 'eli_uri' FROM (SELECT doc_id, {_all(r'\b(?:data|eur-lex)\.europa\.eu/eli/(?:reg|dir|dec)/[0-9]{4}/[0-9]{1,4}\b')} FROM t)
 UNION ALL SELECT doc_id, (CASE WHEN starts_with(x, 'ISO/IEC') THEN 'ISO/IEC ' ELSE 'ISO ' END) || regexp_extract(x, '\s(\S+)$', 1), 'iso' FROM (SELECT doc_id, {_all(r'\bISO(?:/IEC)?\s+[0-9]{3,5}(?:-[0-9]+)?(?::[0-9]{4})?\b')} FROM t)
 UNION ALL SELECT doc_id, CASE WHEN x LIKE '%SP%' THEN 'NIST SP 800-' || regexp_extract(x, '800-(\S+)$', 1) ELSE 'NIST AI ' || regexp_extract(x, '(\S+)$', 1) END, 'nist' FROM (SELECT doc_id, {_all(r'\bNIST\s+(?:SP\s+800-[0-9]+[A-Za-z]?|AI\s+[0-9]+(?:-[0-9]+)?)\b')} FROM t)
 UNION ALL SELECT doc_id, 'SLCG:' || (string_split(x, '/')[1])::INT || '/' || CASE WHEN length(string_split(x, '/')[2]) = 4 THEN string_split(x, '/')[2]::INT ELSE 2000 + string_split(x, '/')[2]::INT END, 'sluzbeni_list_cg' FROM (SELECT doc_id, {_all(r'[0-9]+/[0-9]{2,4}')} FROM t WHERE text LIKE 'Slu%')
 UNION ALL SELECT doc_id, 'CELEX:32024R1689', 'zz' FROM t WHERE regexp_matches(text, '(?i)(^|[^\w])EU AI Act($|[^\w])'))
SELECT doc_id, identifier, CASE min(rule) WHEN 'zz' THEN 'alias' ELSE min(rule) END AS rule FROM f WHERE identifier IS NOT NULL GROUP BY doc_id, identifier"""


@query(_CITES)
def cites_legal(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.expr(_TEXT).alias("text"))
    return legal.extract(docs, {"EU AI Act": "CELEX:32024R1689"})


_URL = "CASE o_orderkey % 3 WHEN 0 THEN 'https://x.eu/?uri=CELEX:5' || year(o_orderdate) || 'DC' || lpad('' || o_orderkey % 500, 4, '0') WHEN 1 THEN 'https://x.eu/?uri=celex%3A3' || year(o_orderdate) || 'r' || lpad('' || o_orderkey % 50, 4, '0') || 'R(01)-20200101' ELSE 'https://x.eu/none' END"
_OWN = rf"u AS (SELECT o_orderkey, upper(regexp_extract({_URL}, '(?i)CELEX(?::|%3A)([0-9]{{5}}[A-Z]{{1,3}}[0-9]{{2,8}}(?:R?\([0-9]{{2}}\))?(?:-[0-9]{{8}})?)', 1)) AS x FROM orders), o AS (SELECT 'CELEX:' || x AS identifier, min(o_orderkey) AS owner FROM u WHERE x <> '' GROUP BY 1 HAVING min(o_orderkey) = max(o_orderkey))"


@query(f"WITH {_OWN}, c AS (SELECT 'CELEX:5' || year(o_orderdate) || 'DC' || lpad('' || o_orderkey % 500, 4, '0') AS identifier, max(o_custkey)::BIGINT AS owner FROM orders WHERE o_orderkey % 9 = 0 GROUP BY 1), g AS (SELECT * FROM c WHERE owner IN (SELECT o_orderkey FROM orders)) SELECT * FROM g UNION ALL SELECT * FROM o WHERE identifier NOT IN (SELECT identifier FROM g)")
def identifier_resolution(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    name = F.expr("'CELEX:5' || year(o_orderdate) || 'DC' || lpad('' || o_orderkey % 500, 4, '0')")
    curated = o.where("o_orderkey % 9 = 0").groupBy(name.alias("identifier")).agg(F.max("o_custkey").cast("long").alias("owner"))
    return legal.resolution(o.select("o_orderkey", F.expr(_URL).alias("url")), curated, o, "o_orderkey", "url")[0].select("identifier", F.col("owner").cast("long").alias("owner"))


_STATUS = "CASE page_id % 7 WHEN 2 THEN 404 WHEN 3 THEN 206 WHEN 4 THEN 503 WHEN 5 THEN 410 ELSE 200 END"
_HEAD = f"""'HTTP/1.1 301 Moved' || chr(13) || chr(10) || 'cf-ray: 1' || chr(13) || chr(10) || 'ETag: "old"' || chr(13) || chr(10) || chr(13) || chr(10) || 'HTTP/2 ' || ({_STATUS}) || chr(13) || chr(10) || 'Content-Type: ' ||
 (CASE WHEN page_id % 5 = 0 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END) || chr(13) || chr(10) || (CASE WHEN page_id % 11 = 0 THEN 'CF-Ray: 7' WHEN page_id % 13 = 0 THEN 'x-amzn-waf-action: Challenge' ELSE 'Server: x' END) || chr(13) || chr(10) || 'etag: "' || (page_id % 4) || '"' || chr(13) || chr(10)"""
_BODY = "CASE page_id % 6 WHEN 0 THEN '%PDF-1.7 ' || html WHEN 1 THEN html || ' Just a moment' WHEN 2 THEN substr(html, 1, 100) WHEN 3 THEN 'PK' || chr(3) || chr(4) || html || html || html ELSE html END"
_WANT = "CASE page_id % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'html' WHEN 2 THEN 'docx' ELSE 'xlsx' END"
_RESP = f"r AS (SELECT page_id, {_STATUS} AS status, page_id % 11 = 0 OR page_id % 13 = 0 OR page_id % 6 = 1 AS wall, page_id % 5 <> 0 AS ishtml, {_BODY} AS body, {_WANT} AS want, strlen({_BODY}) AS size FROM pages)"


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", F.expr(_HEAD).alias("headers"), F.expr(_BODY).alias("body"), F.expr(_WANT).alias("want"))


@query(f"""WITH {_RESP}, c AS (SELECT *, CASE WHEN status IN (404, 410) THEN 'dead/status' WHEN want = 'pdf' AND starts_with(body, '%PDF') THEN 'ok/valid' WHEN wall THEN 'blocked/challenge'
 WHEN want = 'pdf' THEN CASE WHEN ishtml THEN 'blocked/html instead' WHEN size < 2048 THEN 'blocked/too small' ELSE 'blocked/unexpected' END
 WHEN want = 'html' THEN CASE WHEN starts_with(body, '%PDF') THEN 'blocked/pdf instead' WHEN status = 200 AND ishtml AND size >= 1024 THEN 'ok/valid' ELSE 'blocked/unexpected' END
 WHEN status = 200 AND starts_with(body, 'PK' || chr(3) || chr(4)) AND size >= 4096 THEN 'ok/valid' WHEN ishtml THEN 'blocked/html instead' ELSE 'blocked/unexpected' END AS v FROM r)
SELECT page_id, string_split(v, '/')[1] AS outcome, string_split(v, '/')[2] AS reason FROM c""")
def response_formats(spark: SparkSession, sf: str) -> DataFrame:
    v = acquire.classify(F.col("body"), F.col("headers"), F.col("want"))
    return _responses(spark, sf).select("page_id", v.alias("v")).select("page_id", "v.outcome", "v.reason")


@query(f"""WITH {_RESP} SELECT page_id, status, '"' || (page_id % 4) || '"' AS etag, CASE WHEN wall THEN 'blocked' WHEN status IN (404, 410) THEN 'dead' WHEN status IN (200, 206) AND size > 0 THEN 'ok' ELSE 'blocked' END AS outcome FROM r""")
def probe_classify(spark: SparkSession, sf: str) -> DataFrame:
    v = acquire.classify_probe(F.col("body"), F.col("headers"))
    return _responses(spark, sf).select("page_id", acquire.status_of(F.col("headers")).alias("status"), acquire.header(F.col("headers"), "etag").alias("etag"), v["outcome"].alias("outcome"))


_LADDER = "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'dead' ELSE 'blocked' END AS outcome, CASE event_id % 4 WHEN 0 THEN 'direct' WHEN 1 THEN 'official_alt' WHEN 2 THEN 'archive' ELSE 'manual' END AS rung, event_id % 5 = 0 AS alt, CASE event_id % 6 WHEN 0 THEN 'confidential' WHEN 1 THEN 'normal' END AS s FROM events"


@query(f"SELECT event_id, CASE WHEN outcome = 'ok' THEN NULL WHEN outcome = 'dead' THEN CASE WHEN s = 'confidential' THEN 'manual' ELSE 'archive' END WHEN rung = 'direct' AND alt THEN 'official_alt' ELSE 'manual' END AS next, coalesce(s, 'normal') <> 'confidential' AS disclosable FROM ({_LADDER})")
def ladder_next(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    e = load(spark, sf, "events").select("event_id", F.when(k % 3 == 0, "ok").when(k % 3 == 1, "dead").otherwise("blocked").alias("outcome"), F.when(k % 4 == 0, "direct").when(k % 4 == 1, "official_alt").when(k % 4 == 2, "archive").otherwise("manual").alias("rung"), F.when(k % 6 == 0, "confidential").when(k % 6 == 1, "normal").alias("s"))
    return e.select("event_id", acquire.next_rung(F.col("outcome"), F.col("rung"), k % 5 == 0, F.col("s")).alias("next"), acquire.disclosable(F.col("s")).alias("disclosable"))


_ST = """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'old' END AS finding, CASE WHEN event_id % 4 < 2 THEN 'e' || (event_id % 3) END AS etag, CASE WHEN event_id % 4 IN (1, 2) THEN 'm' || (event_id % 2) END AS lm, CAST(event_id % 5 AS INT) AS confirms,
 CASE WHEN event_id % 7 = 0 THEN 'archived_snapshot' ELSE 'live' END AS fidelity, event_id % 9 = 0 AS same, CASE event_id % 8 WHEN 0 THEN 'dead' WHEN 1 THEN 'blocked' ELSE 'ok' END AS outcome, 'HTTP ' || (event_id % 6) AS reason,
 CASE WHEN event_id % 11 < 9 THEN 'e' || (event_id % 2) END AS petag, CASE WHEN event_id % 13 < 9 THEN 'm' || (event_id % 3) END AS plm, CASE WHEN event_id % 2 = 0 THEN 'html' ELSE 'pdf' END AS fmt FROM events"""


@query(f"""WITH s AS ({_ST}), x AS (SELECT *, coalesce(etag, lm) AS stored, CASE WHEN etag IS NOT NULL THEN petag ELSE plm END AS seen FROM s),
n AS (SELECT *, CASE WHEN same THEN 'not modified' WHEN outcome = 'dead' AND fidelity = 'archived_snapshot' THEN 'dead as expected' WHEN outcome = 'dead' THEN 'link rot' WHEN outcome = 'blocked' THEN 'unverifiable' WHEN fidelity = 'archived_snapshot' THEN 'resurrected'
 WHEN stored IS NULL AND petag IS NULL AND plm IS NULL THEN 'no validators' WHEN stored IS NULL THEN 'validators taken' WHEN seen IS NULL THEN 'validator vanished' WHEN seen = stored THEN 'validator confirmed' WHEN fmt = 'html' AND confirms < 2 THEN 'validator unstable' ELSE 'validator changed' END AS note FROM x)
SELECT event_id, note, CASE note WHEN 'link rot' THEN 'link-rot: ' || reason WHEN 'resurrected' THEN 'resurrected: ' || reason WHEN 'validator changed' THEN 'drift: ' || CASE WHEN etag IS NOT NULL THEN 'ETag ' ELSE 'Last-Modified ' END || stored || ' -> ' || seen ELSE finding END AS finding,
 CASE WHEN note IN ('validators taken', 'validator unstable', 'validator changed') THEN petag ELSE etag END AS etag, CASE WHEN note IN ('validators taken', 'validator unstable', 'validator changed') THEN plm ELSE lm END AS last_modified,
 CASE WHEN note IN ('not modified', 'validator confirmed') THEN confirms + 1 WHEN note IN ('validators taken', 'validator unstable', 'validator changed') THEN 0 ELSE confirms END AS confirms FROM n""")
def recheck_verdict(spark: SparkSession, sf: str) -> DataFrame:
    load(spark, sf, "events").createOrReplaceTempView("quern_events")
    s = spark.sql(_ST.replace("FROM events", "FROM quern_events"))
    state = {"finding": F.col("finding"), "etag": F.col("etag"), "last_modified": F.col("lm"), "confirms": F.col("confirms"), "fidelity": F.col("fidelity")}
    probe = {"not_modified": F.col("same"), "outcome": F.col("outcome"), "reason": F.col("reason"), "etag": F.col("petag"), "last_modified": F.col("plm")}
    return s.select("event_id", acquire.recheck(state, probe, F.col("fmt")).alias("v")).select("event_id", "v.note", "v.finding", "v.etag", "v.last_modified", "v.confirms")


_FACTS = "event_id % 13 = 0 AS force, event_id % 3 <> 0 AS raw, event_id % 7 = 0 AS late, event_id % 5 = 0 AS changed, event_id % 4 <> 0 AS md, event_id % 11 = 0 AS clate, event_id % 2 = 0 AS marks, event_id % 6 = 0 AS stale"


@query(f"""WITH f AS (SELECT event_id, {_FACTS} FROM events), d AS (SELECT *, (force OR NOT raw) AND NOT late AS dl FROM f), c AS (SELECT *, (dl OR force OR changed OR NOT md) AND NOT clate AND (raw OR dl) AS cv FROM d)
SELECT event_id, list_aggregate(list_filter([CASE WHEN dl THEN 'download' END, CASE WHEN cv THEN 'convert' END, CASE WHEN (md OR cv) AND marks THEN 'figures' END, CASE WHEN (md OR cv) AND (stale OR cv) THEN 'frontmatter' END], lambda x: x IS NOT NULL), 'string_agg', ',') AS stages FROM c""")
def stage_plan(spark: SparkSession, sf: str) -> DataFrame:
    f = load(spark, sf, "events").selectExpr("event_id", *_FACTS.split(", "))
    plan = acquire.stages(*[F.col(c) for c in ("force", "raw", "late", "changed", "md", "clate", "marks", "stale")])
    return f.select("event_id", F.nullif(F.array_join(plan, ","), F.lit("")).alias("stages"))


_CAND = "SELECT o_orderkey, sha256('' || o_orderkey) AS raw_hash, CASE WHEN o_orderkey % 3 = 0 THEN 'c' || o_custkey END AS admitted_as, CASE WHEN o_orderkey % 5 = 0 THEN 'no' END AS rejected_reason, CASE WHEN o_orderkey % 4 = 0 THEN 'unacquirable' END AS rejected_kind, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate END AS probe_checked FROM orders"
_LIVE = "SELECT 'c' || c_custkey AS id FROM customer WHERE c_custkey % 2 = 0"


def _candidates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    c = load(spark, sf, "orders").select(
        "o_orderkey", F.sha2(k.cast("string"), 256).alias("raw_hash"), F.when(k % 3 == 0, F.concat(F.lit("c"), "o_custkey")).alias("admitted_as"), F.when(k % 5 == 0, "no").alias("rejected_reason"),
        F.when(k % 4 == 0, "unacquirable").alias("rejected_kind"), F.when(k % 6 != 0, F.col("o_orderdate")).alias("probe_checked"),
    )
    return c, load(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("id"))


@query(f"SELECT o_orderkey FROM ({_CAND}) WHERE rejected_reason IS NULL AND (admitted_as IS NULL OR admitted_as NOT IN ({_LIVE}))")
def pending_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return acquire.pending(*_candidates(spark, sf)).select("o_orderkey")


@query(f"SELECT o_orderkey FROM ({_CAND}) WHERE rejected_kind = 'unacquirable' AND (admitted_as IS NULL OR admitted_as NOT IN ({_LIVE})) ORDER BY probe_checked NULLS FIRST, raw_hash LIMIT 50")
def unacquirable_queue(spark: SparkSession, sf: str) -> DataFrame:
    return acquire.unacquirable(*_candidates(spark, sf), limit=50).select("o_orderkey")


@query("SELECT user_id, population FROM (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'raw' WHEN user_id % 3 = 1 THEN 'failed' END AS population, max(CASE WHEN event_type <> 'click' THEN ts END) AS seen FROM events GROUP BY 1, 2) WHERE population IS NOT NULL QUALIFY row_number() OVER (PARTITION BY population ORDER BY seen NULLS FIRST, user_id) <= 10")
def due_populations(spark: SparkSession, sf: str) -> DataFrame:
    seen = load(spark, sf, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") != "click", F.col("ts"))).alias("seen"))
    k = F.col("user_id") % 3
    return acquire.due(seen, "seen", "user_id", F.when(k == 0, "raw").when(k == 1, "failed"), 10).select("user_id", "population")


@query("WITH c AS (SELECT 'u' || user_id AS url, event_id AS timestamp, CASE WHEN event_id % 3 = 0 THEN 404 ELSE 200 END AS status, CASE WHEN event_type = 'click' THEN 'text/html' ELSE 'application/pdf' END AS mimetype FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY timestamp DESC) AS k FROM c) SELECT url, max(timestamp) AS timestamp FROM r WHERE k <= 5 AND status = 200 AND mimetype = 'application/pdf' GROUP BY url")
def archive_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    cdx = load(spark, sf, "events").select(F.concat(F.lit("u"), "user_id").alias("url"), k.alias("timestamp"), F.when(k % 3 == 0, 404).otherwise(200).alias("status"), F.when(F.col("event_type") == "click", "text/html").otherwise("application/pdf").alias("mimetype"))
    return acquire.snapshot(cdx, "application/pdf")
