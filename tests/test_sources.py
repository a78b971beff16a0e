from __future__ import annotations

import io
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from quern.operators import convert
from quern.sinks import files as sinks
from quern.sources import dimensions, files


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return path


def test_registry(spark, tmp_path):
    meta = "id: {id}\nentity_id: sg\ntrack: t\ntitle: Act\ntopics: [a, b]\ndates: {{published: 2024-01-02}}\n"
    put(tmp_path, "t/sg/r1/meta.yaml", meta.format(id="r1"))
    put(tmp_path, "t/sg/r2/meta.yaml", meta.format(id="r1"))
    records = files.registry(spark, str(tmp_path))
    assert {(r.id, r.published, tuple(r.topics)) for r in records.collect()} == {("r1", date(2024, 1, 2), ("a", "b"))}
    assert {tuple(r) for r in files.layout_errors(records).collect()} == {("r1", "path differs"), ("r1", "duplicate id")}


def test_dimensions(spark, tmp_path):
    root = str(tmp_path)
    put(tmp_path, "vocab_topics.yaml", "terms:\n  ai-law: x\n  data: y\n")
    put(tmp_path, "jurisdictions.yaml", "eu: {label: EU, members: [DE, FR]}\nbad: 3\n")
    put(tmp_path, "identifiers.yaml", "identifiers: {'CELEX:1': d1}\naliases: {AI Act: 'CELEX:1'}\n")
    put(tmp_path, "standards_bodies.yaml", "iso: {kind: sdo, full_name: ISO}\n")
    put(tmp_path, "target_entities.yaml", "jurisdictions: [Montenegro]\n")
    put(tmp_path, "eval_queries.yaml", "queries:\n- {query: q, expect: [d1]}\n- {query: r, expect: [d2], lang: et}\n")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(dimensions.vocabulary(spark, root, "topics")) == [("ai-law", "ai law"), ("data", "data")]
    assert rows(dimensions.blocs(spark, root)) == [("eu", "EU", "de"), ("eu", "EU", "fr")]
    assert rows(dimensions.section(spark, root, "identifiers.yaml", "aliases")) == [("AI Act", "CELEX:1")]
    assert rows(dimensions.section(spark, root, "identifiers.yaml", "none")) == [] == rows(dimensions.section(spark, root, "no.yaml", "aliases"))
    assert rows(dimensions.bodies(spark, root)) == [("iso", "sdo", "ISO")] and dimensions.targets(spark, root) == ["Montenegro"]
    assert [(r.query, r.expect, r.lang) for r in dimensions.eval_queries(spark, root).orderBy("query").collect()] == [("q", ["d1"], "en"), ("r", ["d2"], "et")]
    put(tmp_path, "vocab_empty.yaml", "x: 1\n")
    with pytest.raises(Exception, match="no terms"):
        dimensions.vocabulary(spark, root, "empty").collect()


def test_candidates_and_states(spark, tmp_path):
    put(tmp_path, "c/a.yaml", "- {title: A, raw_hash: h1}\n- {title: B, raw_hash: h2}\n")
    put(tmp_path, "c/b.yaml", "- {title: C, raw_hash: h3}\n")
    read = lambda: [(r.shard, r.pos, r.title) for r in dimensions.candidate_shards(spark, str(tmp_path / "c")).orderBy("shard", "pos").collect()]
    assert read() == [("a.yaml", 0, "A"), ("a.yaml", 1, "B"), ("b.yaml", 0, "C")]
    put(tmp_path, "c/candidates.yaml", "- {title: Old}\n")
    assert read() == [("candidates.yaml", 0, "Old")]
    put(tmp_path, "s/d1.state.yaml", "etag: e\netag_confirms: 2\n")
    put(tmp_path, "s/d2.state.yaml", "")
    records = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "id string")
    got = {r.doc_id: (r.etag, r.etag_confirms) for r in dimensions.states(spark, str(tmp_path / "s"), records).collect()}
    assert got == {"d1": ("e", 2), "d2": (None, 0), "d3": (None, 0)}


def test_files(spark, tmp_path):
    listing = spark.createDataFrame([("/x/a/raw.pdf",), ("/x/b/raw.pdf",), ("/x/b/raw.html",), ("/x/c/doc.md",)], "path string")
    assert {tuple(r) for r in dimensions.raw_files(listing).collect()} == {("/x/a", "/x/a/raw.pdf", 1), ("/x/b", None, 2)}
    put(tmp_path, "doc.md", "---\nid: 1\n---\n# T\n---\nx")
    docs = files.text_documents(spark, str(tmp_path)).select(dimensions.without_front_matter(F.col("text")).alias("t"))
    assert docs.first().t == "# T\n---\nx"
    put(tmp_path, "r.csv", 'a,b\n1,"x\ny"\n')
    table = dimensions.bronze(files.csv_registry(spark, str(tmp_path / "r.csv"), "a int, b string"), "v1")
    assert table.first().b == "x\ny" and dimensions.has_version(table, "v1") and not dimensions.has_version(table, "v2") and not dimensions.has_version(None, "v1")
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("dump/documents.csv", 'id,name\n1,"a, b"\n2,\n')
        z.writestr("dump/authorities.csv", "name\nx\n")
    members = dimensions.zip_members(spark, str(tmp_path / "d.zip"), ["documents.csv", "authorities.csv"])
    assert {tuple(r) for r in dimensions.csv_rows(members, "documents.csv", "id string, name string").collect()} == {("1", "a, b"), ("2", None)}
    meta = spark.createDataFrame([('{"metadata":{"version":"7"},"files":[{"links":{"self":"http://z/f"}}]}',)], "j string").select(dimensions.archive_version(F.col("j")).alias("v")).first().v
    assert tuple(meta) == ("7", "http://z/f")
    kv = spark.createDataFrame([("k", "v")], "key string, value string")
    assert dimensions.read_meta(kv, "k") == "v" and dimensions.read_meta(kv, "none") is None
    docs = spark.createDataFrame([("d1", "a", "b"), ("d2", "a", "c")], "doc_id string, raw_sha string, doc_sha string")
    cache = docs.where("doc_id = 'd1'").select("doc_id", F.sha2(F.concat("raw_sha", "doc_sha"), 256).alias("fingerprint"), F.lit("s").alias("signature"))
    assert {r.doc_id: r.hit for r in dimensions.cached_links(docs, cache, "s").collect()} == {"d1": True, "d2": False}
    assert not dimensions.cached_links(docs, cache, "other").where("hit").count()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", None), (2, "c", "x")], "k int, connector_id string, v string")
    sinks.write_once(df, str(tmp_path / "once"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_once(df, str(tmp_path / "once"))
    assert {tuple(r) for r in sinks.upserted(df, df.where("k = 2").withColumn("v", F.lit("new")), ["k"]).collect()} == {(1, "a b", None), (2, "c", "new")}
    assert {r.k: r.state for r in sinks.without_nulls(df, "k").collect()}[1] == '{"connector_id":"a b"}'
    sinks.save_shards(df, str(tmp_path / "shards"))
    sinks.save_shards(df.where("k = 1"), str(tmp_path / "shards"))
    assert [r.shard for r in spark.read.parquet(str(tmp_path / "shards")).collect()] == ["a__b"]
    with pytest.raises(ValueError, match="share the shard"):
        sinks.save_shards(spark.createDataFrame([("a b",), ("a/b",)], "connector_id string"), str(tmp_path / "clash"))
    sinks.overwrite_partitions(df, str(tmp_path / "p"), ["k"])
    sinks.overwrite_partitions(df.where("k = 1").withColumn("v", F.lit("z")), str(tmp_path / "p"), ["k"])
    assert {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {(1, "z"), (2, "x")}
    front = df.select(sinks.front_matter({"id": F.col("k"), "v": F.col("v")}).alias("f")).orderBy("f").collect()
    assert [r.f for r in front] == ["---\nid: 1\n---\n", "---\nid: 2\nv: x\n---\n"]
    sheet = {r.section: r for r in sinks.worksheet(df, df.where("k > 5"), ["k"], 1).collect()}
    assert sheet["pending"].total == 2 and len(sheet["pending"].rows) == 1 and sheet["unacquirable"].total == 0 and sheet["unacquirable"].rows == []
    parts = spark.createDataFrame([("d", "h", 21, "b"), ("d", "h", 1, "a"), ("d", "old", 41, "c")], "k string, header string, first_page int, text string")
    assert sinks.joined_parts(parts, "h", "k").first().text == "a\n\nb"
    nodes, edges = spark.createDataFrame([("doc:1", "doc")], "id string, ntype string"), spark.createDataFrame([("doc:1", "a&b", "cites")], "src string, dst string, etype string")
    sinks.graphml(nodes, edges, str(tmp_path / "g"))
    from xml.etree import ElementTree

    text = "".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    assert len(list(ElementTree.fromstring(text).iter())) == 8


W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def archive(parts: dict) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


CHART = '<c:chartSpace xmlns:c="http://schemas.openxmlformats.org/drawingml/2006/chart" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"><c:chart><c:title><c:tx><a:t>Sales</a:t></c:tx></c:title><c:plotArea><c:barChart><c:barDir val="col"/><c:grouping val="clustered"/><c:ser><c:tx><c:v>S</c:v></c:tx><c:cat><c:strRef><c:strCache><c:ptCount val="2"/><c:pt idx="0"><c:v>A</c:v></c:pt><c:pt idx="1"><c:v>B</c:v></c:pt></c:strCache></c:strRef></c:cat><c:val><c:numRef><c:numCache><c:ptCount val="{n}"/><c:pt idx="0"><c:v>1.5</c:v></c:pt><c:pt idx="1"><c:v>2</c:v></c:pt></c:numCache></c:numRef></c:val></c:ser></c:barChart></c:plotArea></c:chart></c:chartSpace>'


def workbook() -> bytes:
    s, r = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    rel = lambda *xs: f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(f"""<Relationship Id="{i}" Type="{r}/{k}" Target="{t}"/>""" for i, k, t in xs)}</Relationships>'
    return archive({
        "xl/workbook.xml": f'<workbook xmlns="{s}" xmlns:r="{r}"><sheets><sheet name="One" r:id="a"/><sheet name="Two" state="hidden" r:id="b"/><sheet name="Gone" r:id="z"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": rel(("a", "worksheet", "worksheets/sheet1.xml"), ("b", "worksheet", "/xl/worksheets/sheet2.xml"), ("z", "worksheet", "none.xml")),
        "xl/sharedStrings.xml": f'<sst xmlns="{s}"><si><t>Na</t><t>me</t></si></sst>', "xl/styles.xml": f'<styleSheet xmlns="{s}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{s}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>3.0</v></c></row><row><c r="A2" s="1"><v>45292</v></c><c r="C2"><v>2.5</v></c></row></sheetData></worksheet>',
        "xl/worksheets/_rels/sheet1.xml.rels": rel(("d", "drawing", "../drawings/d.xml")), "xl/drawings/d.xml": "<x/>", "xl/drawings/_rels/d.xml.rels": rel(("c", "chart", "../charts/c.xml")), "xl/charts/c.xml": CHART.format(n=2),
        "xl/worksheets/sheet2.xml": f'<worksheet xmlns="{s}"><sheetData/></worksheet>',
    })


def document() -> bytes:
    p = lambda text, style="": f'<w:p><w:pPr>{style}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>'
    body = p("Title", '<w:pStyle w:val="Heading2"/>') + p("Text") + p("Item", "<w:numPr/>") + "<w:tbl><w:tr><w:tc>" + p("a") + "</w:tc><w:tc>" + p("b") + "</w:tc></w:tr><w:tr><w:tc>" + p("1") + "</w:tc><w:tc>" + p("2") + "</w:tc></w:tr></w:tbl>"
    blip = '<w:p><a:blip xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" r:embed="{}"/></w:p>'
    rels = "".join(f'<Relationship Id="{i}" Type="x/image" Target="media/{i}.png"/>' for i in ("big", "small", "unused"))
    return archive({"word/document.xml": f'<w:document xmlns:w="{W}"><w:body>{body}{blip.format("big")}{blip.format("small")}{blip.format("big")}</w:body></w:document>',
                    "word/_rels/document.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>',
                    "word/media/big.png": b"x" * 6000, "word/media/small.png": b"y" * 10, "word/media/unused.png": b"z" * 6000})


def test_converters(spark):
    page = "<html><nav>Menu</nav><article><h2>Head</h2><p>One <b>two</b><br>three</p><ul><li>x<li>y</ul><table><tr><th>a<th></th><th>b</tr><tr><td>1<td></td><td>2</tr></table><table><tr><th>a<th></th><th>b</tr><tr><td>3<td></td><td>4</tr></table><pre>k  v\nw</pre></article></html>"
    files_ = [("a.html", page.encode()), ("b.docx", document()), ("c.xlsx", workbook()), ("d.pdf", b"%PDF"), ("e.docx", b"no zip"), ("f.html", b"<p></p>")]
    got = {r.path: r for r in convert.converted(spark.createDataFrame(files_, "path string, content binary")).collect()}
    assert got["a.html"].markdown == "## Head\n\nOne two three\n\n- x\n\n- y\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n| 3 | 4 |\n\n```\nk  v\nw\n```"
    docx = got["b.docx"].markdown.split("\n\n")
    assert docx[:3] == ["## Title", "Text", "- Item"] and docx[3].startswith("| a | b |") and len(docx) == 5 and docx[4].startswith("> [Figure, image ")
    xlsx = got["c.xlsx"].markdown
    assert xlsx.startswith("## One\n\n| Name | 3 |\n| --- | --- |\n| 2024-01-01 | 2.5 |\n\n**Sales**\n\n```mermaid\nxychart-beta") and xlsx.endswith("## Two (hidden)\n\n> [empty sheet]")
    assert got["d.pdf"].error == "no converter" and got["e.docx"].error.startswith("BadZipFile") and got["f.html"].error.startswith("ConversionError")


def test_charts():
    from xml.etree import ElementTree

    chart = convert.parse_chart(ElementTree.fromstring(CHART.format(n=3)))
    assert chart["kind"] == "column" and chart["series"] == [{"name": "S", "values": [1.5, 2.0, None]}] and chart["categories"] == ["A", "B"]
    assert "mermaid" not in convert.chart_markdown(chart) and convert.chart_markdown({**chart, "series": []}) is None
    assert [convert.number(x, c) for x, c in ((0.125, "0.0%"), (1234.5, "#,##0.00"), (0.58909, None), (None, "0"))] == ["12.5%", "1,234.50", "0.5891", ""]
    with pytest.raises(convert.ConversionError):
        big = zipfile.ZipFile(io.BytesIO(archive({"a": b""})))
        big.infolist()[0].file_size = 200 << 20
        convert.guard(big)


def test_act_headings():
    page = '<div id="cpt_I"><p class="oj-ti-section-1">CHAPTER I</p><div class="eli-title"><p class="oj-ti-section-2">General</p></div></div><div id="cpt_I.sct_1"><p class="oj-ti-section-1">S 1</p><div class="eli-subdivision" id="art_1"><p class="oj-ti-art">Article 1</p><p>Text</p></div></div><p class="oj-doc-ti">ANNEX</p>'
    assert convert.html_markdown(page.encode()).split("\n\n") == ["# CHAPTER I — General", "## S 1", "### Article 1", "Text", "# ANNEX"]
    text = "a\n> [Figure, image 0123456789ab]\nb\n> [Figure, image ba9876543210]\n"
    assert convert.figures_injected(text, {"0123456789ab": "A cat"}, "m").count("VLM interpretation") == 2 and "ba9876543210]\n" in convert.figures_injected(text, {}, "m")
