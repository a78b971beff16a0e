"""Jobs whose disk, time or memory must not outgrow their input."""

from __future__ import annotations

import random
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators import chunking, graph, headings, layout, lines, mapping


def _plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _split(words: list[tuple], width: float) -> float | None:
    """The plain rule, bin by bin."""
    covered = {b for x0, x1, *_ in words if x0 is not None and x1 is not None for b in range(int(x0 // 2), int(x1 // 2) + 1)}
    height, best = max(max(w[3] for w in words) - min(w[2] for w in words), 1.0), None
    for b in sorted(covered):
        a = max((c for c in covered if c < b), default=None)
        if a is None or (b - a - 1) * 2 < 14 or not 0.3 * width <= a + 1 + b <= 0.7 * width:
            continue
        low, high = (a + 1) * 2.0, b * 2.0
        tops = [t for x0, x1, t, _ in words if x0 is not None and x1 is not None and (x1 <= low or x0 >= high)]
        if any(w[1] <= low for w in words if None not in w[:2]) and max(tops) - min(tops) >= 0.45 * height and (best is None or high - low > best[0]):
            best = (high - low, (low + high) / 2)
    return best and best[1]


def test_columns_are_found_without_bins(spark):
    rng = random.Random(5)
    pages: dict[int, list[tuple]] = {}
    for p in range(80):
        for k in range(rng.randint(1, 9)):
            x0 = rng.choice([rng.uniform(0, 260), rng.uniform(280, 560)])
            pages.setdefault(p, []).append((x0, x0 + rng.uniform(0, 90), top := 40.0 * k + rng.random(), top + 12.0))
    pages[80] = [(50.0, 200.0, 10.0, 20.0), (None, 480.0, 400.0, 410.0), (330.0, 480.0, 90.0, 99.0), (50.0, None, 700.0, 710.0)]
    pages[81] = [(50.0, 200.0, 10.0, 20.0), (330.0, 1e11, 90.0, 99.0)]
    words = spark.createDataFrame([(p, *w) for p, ws in pages.items() for w in ws], "page int, x0 double, x1 double, top double, bottom double")
    found = layout.columns(words, ["page"], 600.0)
    assert "Generate" not in _plan(found)
    want = {p: s for p, ws in pages.items() if p != 81 and (s := _split(ws, 600.0)) is not None} | {81: 266.0}
    assert len(want) > 10 and {r.page: r.split for r in found.collect()} == want


def test_citation_sections_need_no_join(spark):
    rng = random.Random(6)
    parts = ["# References", "## Notes:", "### 2. Further reading", "# Body", "## Sub", "#### Deep", "a", "b ", "", "```", "###### Sources", "##### x"]
    docs = [(i, "\n".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(120)] + [(120, None)]
    ls = lines.lines(spark.createDataFrame(docs, "doc_id int, text string"))
    got = headings.citation_sections(ls)
    assert "Join" not in _plan(got)
    text = {(r.doc_id, r.pos): r.line for r in ls.collect()}
    want = set()
    for s in headings.sections(ls).where(headings.is_citation_heading(F.col("title"))).collect():
        body = "\n".join(v for (d, p), v in sorted(text.items()) if d == s.doc_id and p > s.start and (s.stop is None or p < s.stop)).strip(" \t\n")
        want |= {(s.doc_id, s.start, body)} if body else set()
    assert len(want) > 50 and {tuple(r) for r in got.collect()} == want


def test_pagerank_rounds_leave_out_twins(spark, monkeypatch):
    rng = random.Random(7)
    edges = [(f"d{i}", f"h{h}") for i in range(300) for h in rng.choice([[0], [1], [1, 2], [0, 0, 3], [2, 3]])] + [("h0", "h1"), ("d0", "d1")]
    weight: dict = {}
    for a, b in edges:
        for x, y in ((a, b), (b, a)):
            weight.setdefault(x, {})[y] = weight.get(x, {}).get(y, 0) + 1
    seeds = ["d5", "h2", "lone"]
    p = {n: (n in seeds) / 3 for n in {*weight, *seeds}}
    rank = dict(p)
    for _ in range(9):
        new = {n: (0.15 + 0.85 * rank["lone"]) * p[n] for n in p}
        for n, to in weight.items():
            for m, w in to.items():
                new[m] += 0.85 * rank[n] * w / sum(to.values())
        rank = new
    sizes = []
    monkeypatch.setattr(graph, "cut", lambda df, cut=graph.cut: sizes.append((out := cut(df)).count()) or out)
    scores = graph.pagerank(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(s,) for s in seeds], "id string"), rounds=9, tol=0.0)
    got = {r.id: r.score for r in scores.collect()}
    assert got.keys() == rank.keys() and all(abs(got[n] - rank[n]) < 1e-12 for n in rank)
    assert sizes[-1] < 20


def test_acts_are_parsed_and_grouped_once(spark):
    row = '{"celex":{"value":"%s"},"title":{"value":"T%s"},"date":{"value":"d%s"},"author":{"value":"A%s"},"concept":{"value":"c%s"}}'
    body = '{"results":{"bindings":[' + ",".join([row % v for v in [("x", 1, 1, 2, 9), ("y", 2, 2, 1, 1), ("x", 3, 3, 1, 3)]] + ['{"celex":{"value":"x"},"author":{"value":" "}}', '{"celex":{"value":" "}}', "{}"]) + "]}}"
    results = spark.createDataFrame([(body,), (None,), ('{"results":{"bindings":[]}}',), ("no",)], "body string")
    rows = mapping.bindings(results, "body", ["celex", "title", "date", "author", "concept"])
    assert rows.count() == 6
    got = mapping.group_acts(rows.where("ordinal > 0").unionByName(rows.where("ordinal = 0").withColumn("title", F.lit(None).cast("string"))))
    assert {r.celex: tuple(r)[1:] for r in got.collect()} == {"x": ("d1", "T3", ["A2", "A1"], ["c3", "c9"]), "y": ("d2", "T2", ["A1"], ["c1"])}
    plan = _plan(mapping.group_acts(rows))
    assert plan.count("from_json") == 1 and "Aggregate" not in plan


def test_chunks_are_handed_on_as_they_are_made(spark, monkeypatch):
    monkeypatch.setattr(chunking, "HELD", 100_000)
    texts = [f"# T{i}\n\n" + "\n\n".join(f"word{j} " * 40 for j in range(300)) for i in range(12)]
    ids = [2**53 + 1 + i for i in range(12)] + [None, 7]
    sizes = []

    def seen(batch):
        sizes.append(batch.num_rows)
        return batch

    rows = ((d, i, *c) for d, t in zip(ids, [*texts, None, "a\n\n# B\n\nb"], strict=True) for i, c in enumerate(chunking.chunk_text(t, 50)))
    made = [r for b in map(seen, chunking._batches(rows)) for r in b.to_pylist()]
    assert len(sizes) > 5 and all(sum(len(r["text"]) for r in made[i : i + n]) <= 101_000 for i, n in zip(accumulate([0, *sizes]), sizes, strict=False))
    docs = spark.createDataFrame(list(zip(ids, [*texts, None, "a\n\n# B\n\nb"], strict=True)), "doc_id long, text string")
    got = chunking.chunks(docs, 50)
    assert "MapInArrow" in _plan(got)
    key = lambda r: (r["doc_id"] or 0, r["chunk_index"])
    assert sorted((r.asDict() for r in got.collect()), key=key) == sorted(made, key=key)
    assert {r["doc_id"] for r in made} == {*ids} - {None}
