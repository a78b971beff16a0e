from __future__ import annotations

import random

import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from quern.operators import acquire, chunking, dedup, gates, graph, headings, incremental, index, layout, legal, lexical, lines
from quern.plans import catalogue


def test_pagerank(spark):
    edges = [("doc:1", "c:1"), ("doc:2", "c:1"), ("doc:2", "c:2"), ("doc:3", "c:2"), ("doc:3", "c:2"), ("doc:4", "doc:4")]
    weight: dict = {}
    for a, b in edges:
        if a != b:
            for x, y in ((a, b), (b, a)):
                weight.setdefault(x, {})[y] = weight.get(x, {}).get(y, 0) + 1
    for seeds in (["doc:1", "doc:9"],):
        nodes = sorted(set(weight) | set(seeds))
        p = {n: (n in seeds) / len(seeds) for n in nodes}
        rank = dict(p)
        for _ in range(100):
            loose = sum(rank[n] for n in nodes if n not in weight)
            new = {n: (0.15 + 0.85 * loose) * p[n] for n in nodes}
            for n, to in weight.items():
                for m, w in to.items():
                    new[m] += 0.85 * rank[n] * w / sum(to.values())
            done = sum(abs(new[n] - rank[n]) for n in nodes) < 1e-4
            rank = new
            if done:
                break
        got = {r.id: r.score for r in graph.pagerank(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(s,) for s in seeds], "id string")).collect()}
        assert got.keys() == rank.keys() and all(abs(got[n] - rank[n]) < 1e-9 for n in nodes)
    best = graph.ranked(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([("doc:1",)], "id string"), 5, rounds=8).collect()
    assert [r.id for r in best] == ["doc:2", "doc:3"]
    assert graph.pagerank(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([], "id string")).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("x", "y")], "src string, dst string")
    got = {r.id: r.component for r in graph.min_label_components(edges).collect()}
    assert set(got.values()) == {"000", "x"} and len(got) == 43


def test_expand_types(spark):
    edges = spark.createDataFrame([("doc:a", "doc:b", "cites", "L1"), ("doc:c", "doc:b", "cites", "L1"), ("doc:c", "doc:b", "implements", "L0"), ("doc:a", "topic:t", "about", "L0"), ("doc:d", "topic:t", "about", "L0"), ("doc:b", "doc:e", "supersedes", "L0")], "src string, dst string, etype string, layer string")
    seeds = spark.createDataFrame([("doc:a",)], "id string")
    got = {tuple(r) for r in graph.neighbours(edges, seeds, 2, ["cites", "implements"], "doc:").collect()}
    assert got == {("doc:b", 1, "cites", "L1", "out"), ("doc:c", 2, "cites", "L1", "in"), ("doc:c", 2, "implements", "L0", "in")}
    assert {r.id for r in graph.expand(edges, seeds, 2).collect()} == {"doc:b", "topic:t", "doc:c", "doc:d", "doc:e"}


def test_chunks():
    assert [c[:2] for c in chunking.chunk_text("intro\n\n# A\n\none two\n\n## B\n\nthree\n\n# C\n\nfour", 50)] == [("", "intro"), ("A", "# A\n\none two"), ("A › B", "## B\n\nthree"), ("C", "# C\n\nfour")]
    table = "| a | b |\n|---|---|\n" + "\n".join(f"| r{i} | x |" for i in range(10))
    parts = [c[1] for c in chunking.chunk_text(f"# T\n\n{table}", 20)]
    assert parts[0].startswith("# T\n\n| a | b |") and all("| a | b |\n|---|---|\n" in p for p in parts) and sum(p.count("| r") for p in parts) == 10
    fence = "```\nx\n\ny\n```"
    assert [c[1] for c in chunking.chunk_text(f"a\n\n{fence}\n\nb", 50)] == [f"a\n\n{fence}\n\nb"] and list(chunking.chunk_text("```\nopen\n\nrest", 50))[0][1] == "```\nopen\n\nrest"
    mark = "> [Figure, p. 1 — VLM interpretation (m); reconstruction, verify against original]"
    flags = [c[3] for c in chunking.chunk_text(f"x y\n\n{mark}\n\nmade up\n\n> [/VLM interpretation 1]\n\nreal text here again", 4)]
    assert flags[0] is False and True in flags and flags[-1] is False
    assert not any(c[3] for c in chunking.chunk_text(f"{mark}\n\nmade\n\n# H\n\nreal", 50) if c[0])
    chars = lambda t: len(t.encode())
    rng = random.Random(1)
    for _ in range(100):
        text = "".join(rng.choice(["ab ", "長い文", ". ", "\n\n", "\n", "word ", "# h\n\n"]) for _ in range(rng.randrange(60)))
        got = list(chunking.chunk_text(text, 12, chars))
        assert all(n == chars(t) and n <= 12 or t.count(" ") or "\n" in t for _, t, n, _ in got)
        assert "".join("".join(t.split()) for _, t, _, _ in got) == "".join(text.split())
    long = " ".join(f"w{i}" for i in range(60_000))
    assert max(c[2] for c in chunking.chunk_text(long, 512)) == 512


def test_legal(spark):
    texts = ["Regulation (EU) 2024/1689, Regulation (EEC) No 3922/91 and 32024R1689", "Directive 95/46/EC; Decision 768/2008/EC", "(„Službeni list CG“, br. 65/20, 146/21 i 4/24)", "ISO/IEC 42001:2023 or NIST AI 600-1, GDPR-om", "eli.gov.pl/eli/reg/2024/1/oj http://data.europa.eu/eli/dir/2016/680/oj", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got: dict = {}
    for r in legal.extract(docs, {"GDPR": "CELEX:32016R0679", " ": "x"}).collect():
        got.setdefault(r.doc_id, set()).add((r.identifier, r.rule))
    assert got == {
        0: {("CELEX:32024R1689", "celex"), ("CELEX:31991R3922", "eu_act")}, 1: {("CELEX:31995L0046", "eu_act_slash")}, 2: {("SLCG:65/2020", "sluzbeni_list_cg"), ("SLCG:146/2021", "sluzbeni_list_cg"), ("SLCG:4/2024", "sluzbeni_list_cg")},
        3: {("ISO/IEC 42001:2023", "iso"), ("NIST AI 600-1", "nist"), ("CELEX:32016R0679", "alias")}, 4: {("CELEX:32016L0680", "eli_uri")},
    }


def test_candidate_prefix(spark):
    c = spark.createDataFrame([("a" * 64,), ("a" * 12 + "b" * 52,), ("c" * 64,)], "raw_hash string")
    assert acquire.by_prefix(c, "c" * 12).count() == 1
    for prefix, error in (("c" * 5, ValueError), ("a" * 12, LookupError), ("d" * 12, LookupError)):
        with pytest.raises(error):
            acquire.by_prefix(c, prefix)


def test_deep_recheck(spark):
    row = spark.createDataFrame([(None, 1, "live", "b" * 64, False, "ok", "b" * 64), (None, 1, "live", "b" * 64, False, "ok", None), ("old", 1, "live", None, False, "ok", "c" * 64)], "finding string, confirms int, fidelity string, baseline string, same boolean, outcome string, digest string")
    null = F.lit(None).cast("string")
    state = {"finding": F.col("finding"), "etag": null, "last_modified": null, "confirms": F.col("confirms"), "fidelity": F.col("fidelity"), "baseline": F.col("baseline")}
    probe = {"not_modified": F.col("same"), "outcome": F.col("outcome"), "reason": F.lit("r"), "etag": null, "last_modified": null, "digest": F.col("digest")}
    got = [(r.v.note, r.v.finding) for r in row.select(acquire.recheck(state, probe, F.lit("pdf"), deep=True).alias("v")).collect()]
    assert got == [("digest confirmed", None), ("digest changed", "drift: digest bbbbbbbbbbbb -> empty"), ("unverifiable", "old")]


def test_headings(spark):
    text = "# x\n```\n# Annex\n```\nANNEX 1\n\nbody"
    ls = lines.lines(spark.createDataFrame([(1, text)], "doc_id int, text string"))
    assert [r.line for r in headings.merged(ls).orderBy("pos").collect()] == ["# x", "```", "# Annex", "```", "# ANNEX 1", "", "body"]
    assert spark.createDataFrame([(text,)], "t string").select(headings.demoted(F.col("t")).alias("t")).first().t == "**x**\n```\n# Annex\n```\nANNEX 1\n\nbody"
    crumbs = lines.breadcrumbs(lines.lines(spark.createDataFrame([(1, "# A\nx\n## B\ny\n# C\nz")], "doc_id int, text string"))).orderBy("pos").collect()
    assert [r.breadcrumb for r in crumbs] == ["A", "A", "A › B", "A › B", "C", "C"]


def test_layout(spark):
    box = lambda x, y, k="rect": (k, float(x), float(y), float(x + 20), float(y + 10))
    frame = lambda boxes: pd.DataFrame(boxes, columns=["kind", "x0", "top", "x1", "bottom"])
    assert layout.recognise(frame([box(x, y) for x in (0, 30) for y in (0, 20)])) == ("grid", 2, 2)
    assert layout.recognise(frame([box(x, 0) for x in (0, 30, 60)])) == ("sequence", 1, 3)
    assert layout.recognise(frame([box(0, y) for y in (0, 20, 40)])) == ("sequence", 3, 1)
    assert layout.recognise(frame([box(0, 0), box(5, 5), box(50, 90)])) == ("opaque", 0, 0) == layout.recognise(frame([box(0, 0, "curve")]))
    elements = spark.createDataFrame([(1, *box(x, 0)) for x in (0, 30, 60)] + [(2, *box(0, 0, "image"))], "r int, kind string, x0 double, top double, x1 double, bottom double")
    assert {tuple(r) for r in layout.regions(elements, ["r"]).collect()} == {(1, "sequence", 1, 3), (2, "opaque", 0, 0)}
    assert layout.distinct_elements(elements.unionByName(elements).withColumn("o", F.monotonically_increasing_id()), ["r"], "o").count() == 4
    assert {tuple(r)[1:] for r in layout.union_bbox(elements, ["r"]).collect()} == {(0.0, 0.0, 80.0, 10.0), (0.0, 0.0, 20.0, 10.0)}
    ids = elements.withColumn("i", F.monotonically_increasing_id())
    assert layout.intersecting(ids, ["r"], "i", 5.5).count() == 2 and layout.intersecting(ids, ["r"], "i", 4.0).count() == 0
    text = spark.createDataFrame([(1, "Page | 7", 5.0, 15.0), (1, "12", 780.0, 790.0), (1, "12", 400.0, 410.0), (1, "body", 300.0, 310.0)], "d int, text string, top double, bottom double")
    known = spark.createDataFrame([(1, "Page ")], "d int, line string").withColumn("line", F.btrim("line"))
    left = layout.without_boilerplate(text.withColumn("text", F.when(F.col("top") == 5, "Page | 7").otherwise(F.col("text"))), "d", "p", 800.0, known).collect()
    assert sorted(r.top for r in left) in ([300.0, 400.0], [5.0, 300.0, 400.0])
    good = spark.createDataFrame([(3, 50, 0.0, 0.0, 10.0, 10.0), (2, 50, 0.0, 0.0, 10.0, 10.0), (3, 0, 0.0, 0.0, 10.0, 10.0), (3, 500, 0.0, 0.0, 10.0, 10.0)], "n_elements int, n_chars int, x0 double, top double, x1 double, bottom double")
    assert layout.guarded(good, 1000.0).count() == 1


def test_index(spark):
    docs = spark.createDataFrame([("a", "f1", "x y"), ("b", "f2", "z"), ("d", "f4", "new")], "doc_id string, fingerprint string, text string")
    old = spark.createDataFrame([("a", "f1"), ("b", "old"), ("c", "f3")], "doc_id string, fingerprint string")
    chunks = spark.createDataFrame([("a", "x y"), ("b", "stale"), ("c", "gone")], "doc_id string, text string")
    got = {tuple(r) for r in index.reindexed(chunks, old, docs, lambda d: d.select("doc_id", "text")).collect()}
    assert got == {("a", "x y"), ("b", "z"), ("d", "new")}
    assert {tuple(r) for r in incremental.merge(chunks, docs.select("doc_id", "text"), incremental.diff(old, docs.select("doc_id", "fingerprint"))).collect()} == got
    v = index.embedded(spark.createDataFrame([("h", "one two"), ("h", "one two"), ("g", None)], "content_hash string, text string"), index.HashEmbedder(8))
    assert {r.content_hash: round(sum(x * x for x in r.vec), 3) for r in v.collect()} == {"h": 1.0, "g": 0.0} and index.check_dimensions(v) == 8
    with pytest.raises(ValueError, match="dimensions"):
        index.check_dimensions(v.unionByName(v.withColumn("vec", F.slice("vec", 1, 3))))
    assert index.unembedded(spark.createDataFrame([("h",), ("new",)], "content_hash string"), v, "hash") == 1 and index.without_model(v, "hash").count() == 0
    index.check_budget(None, 5)
    with pytest.raises(ValueError, match="too long"):
        index.check_budget(6, 5)
    assert index.needs_rebuild(None, "a") == (True, "no index") and index.needs_rebuild("a", "a") == (False, "up to date") and index.stale("a", "b")
    assert lexical.query_phrases("AI  re-use _") == [["ai"], ["re", "use"]] and lexical.search(docs, " ?! ").count() == 0
    assert [r.doc_id for r in lexical.search(docs, "X-Y").collect()] == ["a"]
    f, t = index.facets(spark.createDataFrame([("a", "en", ["t", "t"])], "doc_id string, language string, topics array<string>"), ["language"], "topics")
    assert (f.count(), t.count()) == (1, 1)


def test_first_seen_rules(spark):
    rows = [(1, "u1", "t1"), (2, "u1", "t2"), (3, None, "t2"), (4, "u2", "t1"), (5, None, None)]
    d = spark.createDataFrame(rows, "ordinal long, url string, title string")
    got = {r.ordinal: r.kept_ordinal for r in dedup.multi_strategy(d, ["url", "title"], "ordinal").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5}
    rng = random.Random(2)
    rows = [(i, *(rng.choice([None, *"abcdefghij"[: 3 + i % 8]]) for _ in range(3))) for i in range(60)]
    pool, want = {}, {}
    for i, *own in rows:
        found = next((pool[k, v] for k, v in enumerate(own) if v is not None and (k, v) in pool), None)
        want[i] = i if found is None else found
        if found is None:
            pool |= {(k, v): i for k, v in enumerate(own) if v is not None}
    d = spark.createDataFrame(rows, "ordinal long, x string, y string, z string")
    assert {r.ordinal: r.kept_ordinal for r in dedup.multi_strategy(d, ["x", "y", "z"], "ordinal").collect()} == want
    first = dedup.group_first(spark.createDataFrame([(1, 2, None, "b"), (1, 1, None, "a"), (1, 3, "x", None)], "k int, o int, p string, q string"), "k", ["o"], ["p", "q"]).first()
    assert (first.p, first.q) == ("x", "a")


def test_gates(spark):
    assert spark.range(1).select(gates.url_filtered(F.lit(None).cast("string"), ["a.b"]).alias("x")).first().x is False


@pytest.mark.parametrize("name", ["corpus_fingerprint", "chunk_stats", "html_markdown", "chunk_vectors", "breadcrumbs"])
def test_queries_without_sql(spark, name):
    """The same rows twice, and what can be told of them without SQL."""
    a, b = (sorted(map(str, catalogue.queries()[name](spark, SF).collect())) for _ in range(2))
    assert a == b
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if name == "corpus_fingerprint":
        assert f"n={docs.count()}" in a[0]
    if name == "html_markdown":
        assert len(a) == spark.read.parquet(f"{SF}/pages.parquet").count() and not any("error='" in x for x in a)


def test_stream_confirms(spark, tmp_path):
    from quern.operators import incremental as inc
    from quern.streaming import events

    src = events.source(spark, f"{SF}/events.parquet*")
    q = events.run_once(events.confirms(src), f"file://{tmp_path}/run", "update")
    got = {r.user_id: (r.confirms, r.last_value) for r in q.collect()}
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("o", F.struct("ts", "event_id"))
    assert got == {r.user_id: (r.confirms, r.last_value) for r in inc.validator_fold(e, "user_id", "o", "event_type").collect()}


def test_more(spark, tmp_path):
    from quern.operators import links, mapping

    boxes = spark.createDataFrame([(1, "https://a.gov/x.", 0.0, 0.0, 50.0, 10.0), (1, "https://a.gov/x", 0.0, 20.0, 50.0, 30.0), (1, "nope", 0.0, 0.0, 9.0, 9.0)], "page int, uri string, x0 double, top double, x1 double, bottom double")
    words = spark.createDataFrame([(1, "wide", 0.0, 21.0, 20.0, 29.0), (1, "web", 30.0, 1.0, 45.0, 9.0), (1, "World", 0.0, 1.0, 20.0, 9.0), (1, "out", 60.0, 1.0, 80.0, 9.0)], "page int, text string, x0 double, top double, x1 double, bottom double")
    assert [tuple(r) for r in links.annotation_links(boxes, words, ["page"]).collect()] == [(1, "https://a.gov/x", "World web wide")]
    assert layout.decor(words.select(F.lit(1).alias("d"), F.lit("h").alias("h")), "d", "h").first().n == 4
    with pytest.raises(ValueError, match="no concepts"):
        mapping.act_query([], "l", "en", 1)
    assert "<http://c/1> <http://c/2>" in mapping.act_query(["http://c/1", "http://c/2"], "http://l", "en", 5)
    look = spark.createDataFrame([(1, 2, 1, 2), (1, 2, 1, 3), (1, 2, None, None)], "a long, b long, c long, d long")
    assert [r.m for r in look.select(incremental.must_hash(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("m")).collect()] == [False, True, True]
    states = spark.createDataFrame([("pdf", True, None), ("pdf", True, "m"), ("pdf", None, None), ("html", True, None)], "format string, is_scan boolean, ocr_model string")
    assert tuple(incremental.fallback_counts(states).first()) == (2, 1)
    src = tmp_path / "in"
    rows = lambda v: spark.createDataFrame([("h1", v), (f"h{v}", v)], "content_hash string, vec int").coalesce(1).write.mode("append").parquet(f"file://{src}")
    read = lambda: spark.readStream.schema("content_hash string, vec int").parquet(f"file://{src}")
    rows(2)
    incremental.store_by_batches(read(), ["content_hash"], f"file://{tmp_path}/out").collect()
    rows(3)
    got = incremental.store_by_batches(read(), ["content_hash"], f"file://{tmp_path}/out")
    assert {tuple(r) for r in got.collect()} == {("h1", 3), ("h2", 2), ("h3", 3)}
    assert spark.createDataFrame([(b"abc",)], "c binary").select(incremental.file_hash(F.col("c")).alias("h")).first().h.startswith("ba7816bf")
