from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from quern import jobs
from quern.operators import index, markers
from quern.sources import paged
from quern.streaming import events, watch


class Fixed:
    enabled = True

    def __init__(self, id_, rows):
        self.id, self.rows = id_, rows

    def discover(self, spark):
        if self.rows is None:
            raise RuntimeError("no answer")
        return spark.createDataFrame(self.rows, "ordinal int, source_url string, title string")


def test_discover(spark):
    r = jobs.Registry()
    for c in (Fixed("a", [(0, "http://X/1/", "one"), (1, "https://x/2", "two")]), Fixed("bad", None), Fixed("b", [(0, "https://x/2#f", "again"), (1, None, "free")])):
        r.register(c)
    with pytest.raises(ValueError, match="there already"):
        r.register(Fixed("a", []))
    existing = spark.createDataFrame([(0, "https://x/1", "old")], "ordinal int, source_url string, title string")
    d = jobs.discover(spark, existing, r.enabled(), ["source_url", "title"])
    assert {tuple(x) for x in d.diagnostics.collect()} == {("a", 2, 1, 1), ("b", 2, 1, 1)} and list(d.errors) == ["bad"]
    assert {x.title for x in d.candidates.where("fresh").collect()} == {"old", "two", "free"} and [c.id for c in r.enabled(["b"])] == ["b"]


def test_index_and_search(spark, tmp_path):
    folder = f"file://{tmp_path}/ix"
    docs = spark.createDataFrame([(1, "# Law\n\nthe data protection law of all", "en"), (2, "cats and dogs play", "en"), (3, "Datenschutz data protection", "de")], "doc_id long, text string, lang string")
    e = index.HashEmbedder(64)
    jobs.build_index(docs, folder, e, ["lang"])
    hits = jobs.search(spark, folder, "data-protection", e).collect()
    assert {r.doc_id for r in hits[:2]} == {1, 3} and "[data] [protection]" in hits[0].snippet and next(r for r in hits if r.doc_id == 1).breadcrumb == "Law"
    assert [r.doc_id for r in jobs.search(spark, folder, "data", None, equal={"lang": ["de"]}).collect()] == [3]
    stamp = (tmp_path / "ix/chunks/_SUCCESS").stat().st_mtime_ns
    jobs.build_index(docs, folder, e, ["lang"])
    assert (tmp_path / "ix/chunks/_SUCCESS").stat().st_mtime_ns == stamp
    jobs.build_index(docs.where("doc_id < 3"), folder, e, ["lang"])
    assert jobs.search(spark, folder, "Datenschutz").count() == 0
    q = spark.createDataFrame([(1, "data law", "en"), (2, "zebra", "et")], "query_id int, text string, lang string")
    got = {r.lang: (r.hit, r.rr, r.n) for r in jobs.evaluate(docs, q, spark.createDataFrame([(1, 1), (2, 2)], "query_id int, doc_id long")).collect()}
    assert got == {"en": (1.0, 1.0, 1), "et": (0.0, 0.0, 1), None: (0.5, 0.5, 2)}


def test_recheck(spark):
    state = spark.createDataFrame([("a", "pdf", "live", None, "e1", None, 0, None), ("b", "pdf", "live", None, "e1", None, 3, None), ("c", "pdf", "live", None, None, None, 0, None)], "doc_id string, format string, fidelity string, finding string, etag string, last_modified string, confirms int, checked date")
    probes = spark.createDataFrame([("a", False, "ok", "r", "e2", None), ("b", False, None, None, None, None)], "doc_id string, not_modified boolean, outcome string, reason string, etag string, last_modified string")
    got = {r.doc_id: r for r in jobs.recheck(state, probes, today=date(2026, 1, 2)).collect()}
    assert got["a"].finding == "drift: ETag e1 -> e2" and got["a"].etag == "e2" and got["b"].confirms == 3 and got["b"].checked == date(2026, 1, 2) and got["c"].checked is None


def test_validate_and_report(spark):
    records = spark.createDataFrame([("a", "law", [("cites", "b")]), ("b", "poem", [("cites", "x")]), ("b", "law", [])], "id string, doc_type string, relations array<struct<type:string,target:string>>")
    found = jobs.validate(records, spark.createDataFrame([("law",)], "term string"), {"named a": F.col("id") == "a"})
    assert sorted(map(tuple, found.collect())) == [("a", "named a"), ("b", "duplicate id"), ("b", "relation to nothing"), ("b", "unknown document type")]
    nodes, edges = spark.createDataFrame([("doc:a", "doc")], "id string, ntype string"), spark.createDataFrame([("doc:a", "doc:b", "cites")], "src string, dst string, etype string")
    spans = spark.createDataFrame([("a", date(2020, 1, 1), date(2021, 1, 1), True), ("b", date(2021, 1, 1), None, True), ("c", None, None, False)], "doc_id string, valid_from date, valid_to date, known boolean")
    counts, now = jobs.graph_report(nodes, edges, spans, date(2021, 1, 1))
    assert counts.count() == 2 and [r.doc_id for r in now.collect()] == ["b", "c"]


def test_pages(spark, tmp_path):
    slept: list = []
    fails = iter([paged.FetchError(503), paged.FetchError(None)])

    def fetch(k):
        if (e := next(fails, None)) is not None:
            raise e
        return {"data": [{"id": k, "secret": "x"}], "total": 2, "lastPage": 2}

    df = paged.table(spark, paged.numbered(fetch, slept.append), "struct<id:int>")
    assert sorted(map(tuple, df.collect())) == [(1,), (2,)] and df.columns == ["id"] and slept == [1, 4]
    with pytest.raises(paged.FetchError):
        paged.retrying(lambda: (_ for _ in ()).throw(paged.FetchError(404)), sleep=slept.append)
    assert len(slept) == 2
    for page, error in (({"data": [], "total": 1, "lastPage": 1}, "empty"), ({"data": [1], "total": 5, "lastPage": 1}, "1 of 5"), ({}, "empty")):
        with pytest.raises(ValueError, match=error):
            list(paged.numbered(lambda k, page=page: page))
    rows = list(range(5))
    assert list(paged.offset(lambda at: (rows[at : at + 2], 5), sleep=slept.append)) == [[0, 1], [2, 3], [4]] and list(paged.offset(lambda at: ([], 9))) == []
    for i in range(2):
        (tmp_path / f"p{i}.json").write_text(json.dumps({"data": [{"id": i, "name": f"n{i}"}]}))
    spark.dataSource.register(paged.JsonPages)
    assert sorted(map(tuple, spark.read.format("quern_pages").schema("id int, name string").load(str(tmp_path)).collect())) == [(0, "n0"), (1, "n1")]


def test_watch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "path string, modificationTime timestamp, length long, content binary"
    read = lambda: spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.pdf").load(str(folder))
    (folder / "small.pdf").write_bytes(b"%PDF")
    assert watch.choose(read()) == ("waiting", None)
    (folder / "one.pdf").write_bytes(b"%PDF" + b"x" * 3000)
    assert watch.choose(read())[0] == "accepted" and watch.choose(read(), F.lit(False))[0] == "waiting"
    seen = events.run_once(watch.valid(watch.arrivals(spark, str(folder))).select("path"), f"file://{tmp_path}/run", "append")
    assert [r.path.rsplit("/", 1)[-1] for r in seen.collect()] == ["one.pdf"]
    (folder / "two.pdf").write_bytes(b"%PDF" + b"y" * 3000)
    assert watch.choose(read()) == ("conflict", None)


def test_markers(spark):
    df = spark.createDataFrame([("Figure, p. 6", "m")], "h string, m string")
    o = df.select(markers.opened(F.col("h"), F.col("m")).alias("l")).withColumn("o", markers.opens(F.col("l"))).withColumn("c", markers.closes(markers.closed(F.lit("x")))).first()
    assert o.o and o.c
    lines = spark.createDataFrame([(1, 0, "> [Figure, p. 3, region 0123456789ab]"), (1, 1, "text")], "doc_id int, pos int, line string")
    regions = spark.createDataFrame([(1, 3, "0123456789ab", "grid")], "doc_id int, page int, region string, shape string")
    assert [(r.pos, r["shape"]) for r in markers.marked_regions(lines, regions).collect()] == [(0, "grid")]
    block = spark.range(1).select(markers.region_block(F.lit(3), F.lit("0123456789ab"), F.array(F.lit("a"), F.lit("b"))).alias("b")).first().b
    assert block == "> [Figure, p. 3, region 0123456789ab]\n> Labels: a; b"
    rows = spark.createDataFrame([("d", i, s) for i, s in enumerate([5, 5, 9, 2, 2, 2, 50, 1])], "k string, page int, bytes int")
    got = {r.page: r.batch for r in markers.batched(rows, "k", "page", "bytes", 3, 10).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 2, 4: 2, 5: 2, 6: 3, 7: 4}
    s = spark.createDataFrame([("d1", "See  The Book, 2020"), ("d2", "other")], "doc_id string, body string")
    cache = s.where("doc_id = 'd1'").select(F.sha2("body", 256).alias("digest"), F.expr("array(struct('the book' as title, 'http://b' as url), struct('the book, 2020' as title, null as url), struct('invented' as title, null as url))").alias("citations"))
    links, leads, todo = markers.split_citations(s, cache)
    assert [r.url for r in links.collect()] == ["http://b"] and [r.title for r in leads.collect()] == ["the book, 2020"] and [r.doc_id for r in todo.collect()] == ["d2"]
