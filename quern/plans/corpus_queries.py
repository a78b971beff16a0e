"""Discovery, deduplication, graph, incremental state, layout, streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..cluster import shared_dir
from ..functions import text as T
from ..operators import chunking, dedup, discovery, graph, incremental, layout, lines, links
from ..session import load
from ..streaming import events as stream
from .registry import query


@query("SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text")
def dedup_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return dedup.first_seen(d, "h", "doc_id").select("doc_id")


@query()
def dedup_multi_strategy(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("ordinal"), F.sha2("text", 256).alias("h"), F.sha2(T.normalized_title(F.get(F.split("text", "\n"), F.lit(0))), 256).alias("t"))
    return dedup.multi_strategy(d, ["h", "t"], "ordinal")


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"


@query(f"SELECT {_HOST} AS host, count(DISTINCT url) AS n_owners FROM pages GROUP BY 1 HAVING count(DISTINCT url) > 1")
def ambiguous_owner(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.ambiguous_owner(load(spark, sf, "pages").select(T.netloc(F.col("url")).alias("host"), "url"), "host", "url")


@query(f"SELECT {_HOST} AS host, min(page_id) AS owner FROM pages GROUP BY 1 HAVING count(DISTINCT page_id) = 1")
def unique_identifier_owner(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.unique_owner(load(spark, sf, "pages").select(T.netloc(F.col("url")).alias("host"), "page_id"), "host", "page_id")


_FIRST = "(l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag)"


@query(f"SELECT l_orderkey, arg_min(l_shipdate, {_FIRST}) AS l_shipdate, arg_min(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, {_FIRST}) FILTER (l_returnflag <> 'N') AS l_returnflag FROM lineitem GROUP BY l_orderkey")
def group_first_nonnull(spark: SparkSession, sf: str) -> DataFrame:
    # the flag N counts as missing; the order is total, for line numbers repeat within an order
    li = load(spark, sf, "lineitem").withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"]
    return dedup.group_first(li, "l_orderkey", order, ["l_shipdate", "flag"]).withColumnRenamed("flag", "l_returnflag")


@query("SELECT n_name, CASE WHEN r_name = 'ASIA' THEN 'probe' ELSE 'all' END AS slice, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY r_name = 'ASIA' ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) WHERE r_name <> 'ASIA' OR k <= 25")
def hybrid_slices_topn(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return discovery.slices(c, F.col("r_name") == "ASIA", "c_acctbal", ["c_custkey"], 25).select("n_name", "slice", "c_custkey")


@query("SELECT * FROM (SELECT o_orderkey, unnest([CASE WHEN o_totalprice < 5000 THEN 'cheap' END, CASE WHEN o_orderstatus = 'P' THEN 'partial' END, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'late' END]) AS rule FROM orders) WHERE rule IS NOT NULL")
def registry_violations(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"cheap": F.col("o_totalprice") < 5000, "partial": F.col("o_orderstatus") == "P", "late": F.col("o_orderdate") >= F.expr("timestamp '1998-01-01'")}
    return discovery.violations(load(spark, sf, "orders"), "o_orderkey", rules)


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def dangling_references(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").join(load(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


_TRI = "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'rejected' ELSE 'admitted' END AS status, CASE o_orderkey % 4 WHEN 0 THEN 'admit' WHEN 1 THEN 'reject' WHEN 2 THEN 'revive' END AS action FROM orders"


@query(f"""SELECT o_orderkey, CASE WHEN ok AND action = 'admit' THEN 'admitted' WHEN ok AND action = 'reject' THEN 'rejected' WHEN ok THEN 'pending' ELSE status END AS new_status, action IS NOT NULL AND NOT ok AS illegal
FROM (SELECT *, coalesce((status = 'pending' AND action IN ('admit', 'reject')) OR (status = 'rejected' AND action = 'revive'), false) AS ok FROM ({_TRI}))""")
def triage_apply(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    key = F.col("o_orderkey") % 4
    status = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", "rejected").otherwise("admitted")
    decisions = o.where(key < 3).select("o_orderkey", F.when(key == 0, "admit").when(key == 1, "reject").otherwise("revive").alias("action"))
    return discovery.triage(o.select("o_orderkey", status.alias("status")), decisions, "o_orderkey").select("o_orderkey", "new_status", "illegal")


@query("SELECT user_id, max(ts) AS last_seen FROM events GROUP BY user_id ORDER BY last_seen, user_id LIMIT 20")
def rotation_cursor(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.due(load(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last_seen")), "last_seen", "user_id", 20)


@query("SELECT event_id, CASE WHEN s BETWEEN 200 AND 299 THEN 'ok' WHEN s IN (404, 410) THEN 'gone' WHEN s IN (401, 403, 451) THEN 'blocked' WHEN s = 429 OR s >= 500 THEN 'retry' ELSE 'failed' END AS outcome FROM (SELECT event_id, 200 + (event_id % 7) * 51 AS s FROM events)")
def response_classify(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select("event_id", discovery.response_class(F.lit(200) + F.col("event_id") % 7 * 51, F.col("event_type")).alias("outcome"))


_FOLD = """WITH c AS (SELECT user_id, ts, event_id, event_type, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM c), g AS (SELECT user_id, i, count(*) AS n, min(event_type) AS v FROM i GROUP BY 1, 2)
SELECT user_id, arg_max(n, i) - 1 AS confirms, arg_max(v, i) AS last_value FROM g GROUP BY 1"""


@query(_FOLD)
def validator_fold(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").withColumn("o", F.struct("ts", "event_id"))
    return incremental.validator_fold(e, "user_id", "o", "event_type")


@query("SELECT doc_id, CASE WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'vanished' ELSE 'changed' END AS change FROM (SELECT coalesce(x.doc_id, y.doc_id) AS doc_id, a, b FROM (SELECT doc_id, md5(text) AS a FROM documents WHERE doc_id % 5 <> 0) x FULL JOIN (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN md5(text || '!') ELSE md5(text) END AS b FROM documents WHERE doc_id % 3 <> 0) y ON x.doc_id = y.doc_id) WHERE a IS DISTINCT FROM b")
def fingerprint_diff(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    # two editions of the table: the remainders say which documents vanish, come and change between them
    old = d.where("doc_id % 5 <> 0").select("doc_id", F.md5("text").alias("fingerprint"))
    new = d.where("doc_id % 3 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.md5(F.concat("text", F.lit("!")))).otherwise(F.md5("text")).alias("fingerprint"))
    return incremental.diff(old, new)


@query()
def corpus_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.corpus_fingerprint(load(spark, sf, "documents"), "doc_id", "text")


_VAL = "v AS (SELECT o_orderkey AS doc_id, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to FROM orders)"


def _intervals(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    return graph.validity(o.select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderdate").alias("valid_from")), graph.successors_by_order(o, "o_custkey", "o_orderdate", "o_orderkey"))


@query(f"WITH {_VAL} SELECT doc_id, valid_from, valid_to, true AS known FROM v")
def validity_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return _intervals(spark, sf)


@query(f"WITH {_VAL} SELECT doc_id FROM v WHERE valid_from <= TIMESTAMP '1995-06-17' AND (valid_to IS NULL OR TIMESTAMP '1995-06-17' < valid_to)")
def as_of(spark: SparkSession, sf: str) -> DataFrame:
    return graph.as_of(_intervals(spark, sf), F.expr("timestamp '1995-06-17'")).select("doc_id")


def _graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c, n, r = (load(spark, sf, t) for t in ("customer", "nation", "region"))
    nodes = [c.select(graph.node_id("doc", F.col("c_custkey")).alias("id"), F.lit("doc").alias("ntype")), n.select(graph.node_id("country", F.col("n_nationkey")), F.lit("country")), r.select(graph.node_id("bloc", F.col("r_regionkey")), F.lit("bloc"))]
    edges = [
        c.select(graph.node_id("doc", F.col("c_custkey")).alias("src"), graph.node_id("country", F.col("c_nationkey")).alias("dst"), F.lit("governs").alias("etype")),
        n.select(graph.node_id("country", F.col("n_nationkey")), graph.node_id("bloc", F.col("n_regionkey")), F.lit("member_of")),
    ]
    return nodes[0].union(nodes[1]).union(nodes[2]), edges[0].union(edges[1])


_NODES = "SELECT 'doc:' || c_custkey AS id, 'doc' AS ntype FROM customer UNION ALL SELECT 'country:' || n_nationkey, 'country' FROM nation UNION ALL SELECT 'bloc:' || r_regionkey, 'bloc' FROM region"
_EDGES = "SELECT 'doc:' || c_custkey AS src, 'country:' || c_nationkey AS dst, 'governs' AS etype FROM customer UNION ALL SELECT 'country:' || n_nationkey, 'bloc:' || n_regionkey, 'member_of' FROM nation"


@query(_NODES)
def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _graph(spark, sf)[0]


@query(_EDGES)
def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _graph(spark, sf)[1]


@query(f"SELECT 'node' AS side, ntype AS kind, count(*) AS n FROM ({_NODES}) GROUP BY 2 UNION ALL SELECT 'edge', etype, count(*) FROM ({_EDGES}) GROUP BY 2")
def graph_summary(spark: SparkSession, sf: str) -> DataFrame:
    return graph.summary(*_graph(spark, sf))


@query("SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'")
def docs_in_bloc(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "nation").join(load(spark, sf, "region").where("r_name = 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return load(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey")


@query("SELECT DISTINCT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 7")
def docs_by_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").join(load(spark, sf, "part").where("p_size = 7"), F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("l_orderkey").distinct()


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_orderkey = (SELECT min(l_orderkey) FROM lineitem)")
def lineage(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return li.join(li.agg(F.min("l_orderkey").alias("l_orderkey")), "l_orderkey").select("l_partkey").distinct()


_LP = "e AS (SELECT DISTINCT 's' || l_suppkey AS a, 'p' || l_partkey AS b FROM lineitem), u AS (SELECT a AS src, b AS dst FROM e UNION SELECT b, a FROM e)"


def _supply(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))


@query(f"WITH {_LP}, h1 AS (SELECT DISTINCT dst AS id FROM u WHERE src = 's1' AND dst <> 's1'), h2 AS (SELECT DISTINCT dst AS id FROM u JOIN h1 ON src = id WHERE dst <> 's1' AND dst NOT IN (SELECT id FROM h1)) SELECT id, 1 AS hops FROM h1 UNION ALL SELECT id, 2 FROM h2")
def expand_hops(spark: SparkSession, sf: str) -> DataFrame:
    return graph.expand(_supply(spark, sf).distinct(), spark.createDataFrame([("s1",)], "id string"), 2)


@query("SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS weight FROM (SELECT 's' || l_suppkey AS a, 'p' || l_partkey AS b FROM lineitem) GROUP BY 1, 2")
def graph_projection(spark: SparkSession, sf: str) -> DataFrame:
    return graph.projection(_supply(spark, sf))


@query()
def ppr(spark: SparkSession, sf: str) -> DataFrame:
    edges = _graph(spark, sf)[1]
    return graph.ranked(edges, spark.createDataFrame([("doc:1",)], "id string"), 20).select("id", F.round("score", 9).alias("score"))


@query("WITH RECURSIVE x AS (SELECT 'bloc:' || r_regionkey AS id, 'bloc:' || r_regionkey AS component FROM region) SELECT id, component FROM x UNION ALL SELECT 'country:' || n_nationkey, 'bloc:' || n_regionkey FROM nation UNION ALL SELECT 'doc:' || c_custkey, 'bloc:' || n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
def components(spark: SparkSession, sf: str) -> DataFrame:
    return graph.min_label_components(_graph(spark, sf)[1])


@query()
def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunks(load(spark, sf, "documents"), 128)


@query()
def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    c = chunking.chunks(load(spark, sf, "documents"), 128)
    return c.agg(F.count("*").alias("n_chunks"), F.count_if(F.col("n_tokens") > 128).alias("n_over"), F.max("n_tokens").alias("largest"))


@query("SELECT doc_id, line, count(DISTINCT pos // 10) AS n_pages FROM (SELECT source AS doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents) GROUP BY 1, 2 HAVING count(DISTINCT pos // 10) >= 3")
def boilerplate_lines(spark: SparkSession, sf: str) -> DataFrame:
    ls = lines.lines(load(spark, sf, "documents"), "source").withColumn("page", F.floor(F.col("pos") / 10))
    return ls.groupBy(F.col("source").alias("doc_id"), "line").agg(F.countDistinct("page").alias("n_pages")).where("n_pages >= 3")


@query("SELECT user_id, s AS session, count(*) AS n FROM (SELECT user_id, sum(g) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS g FROM events)) GROUP BY 1, 2")
def line_sessions(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").withColumn("o", F.struct("ts", "event_id"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = e.withColumn("gap", F.coalesce(F.col("ts") - F.lag("ts").over(w) > F.expr("interval 6 hours"), F.lit(False)))
    return lines.sessions(e, "user_id", "o", F.col("gap")).groupBy("user_id", "session").agg(F.count("*").alias("n"))


@query("SELECT user_id AS k, c AS cluster, round(avg(value), 6) AS center, count(*) AS n FROM (SELECT user_id, value, sum(g) OVER (PARTITION BY user_id ORDER BY value) AS c FROM (SELECT user_id, value, CASE WHEN value - lag(value) OVER (PARTITION BY user_id ORDER BY value) > 1.5 THEN 1 ELSE 0 END AS g FROM events)) GROUP BY 1, 2")
def cluster_1d(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select(F.col("user_id").alias("k"), "value")
    return layout.cluster_1d(e, "k", "value", 1.5).select("k", "cluster", F.round("center", 6).alias("center"), "n")


@query("SELECT l_returnflag, round(sum(l_quantity) FILTER (l_linestatus = 'F'), 2) AS f, round(sum(l_quantity) FILTER (l_linestatus = 'O'), 2) AS o FROM lineitem GROUP BY 1")
def chart_pivot(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.round(F.sum("l_quantity"), 2))
    return p.select("l_returnflag", F.col("F").alias("f"), F.col("O").alias("o"))


@query("SELECT page_id, count(*) AS n_links FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"[^\"#][^\"]*\"[^>]*>[^<]*</a>')) AS x FROM pages) GROUP BY 1")
def link_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return links.html_links(load(spark, sf, "pages")).groupBy("page_id").agg(F.count("*").alias("n_links"))


_WINDOWS = "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"


@query(_WINDOWS)
def windowed_events(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


@query(_WINDOWS)
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Drains the events by Structured Streaming into the shared folder."""
    counted = stream.windowed(stream.source(spark, f"{sf}/events.parquet*"))
    return stream.run_once(counted, f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}", "complete").select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query(_FOLD)
def validator_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The counter of equal values kept between batches; of a user's rows the last one holds."""
    folded = stream.run_once(stream.confirms(stream.source(spark, f"{sf}/events.parquet*")), f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}", "update")
    last = folded.groupBy("user_id").agg(F.max_by(F.struct("confirms", "last_value"), "batch").alias("x"))
    return last.select("user_id", "x.confirms", "x.last_value")
