from __future__ import annotations

import numpy as np
from conftest import SF

from quern.operators import graph, vector
from quern.plans import catalogue


def test_every_query_vector(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(500)] + [(500, [0.0] * 8)]
    v = np.array([x for _, x in rows])
    v /= np.where((n := np.sqrt((v * v).sum(axis=1))) == 0, 1, n)[:, None]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vector.cosine_topk_each(df, df.where("vec_id % 100 = 0"), 5).collect()
    for q in range(0, 501, 100):
        best = sorted(range(501), key=lambda i: (-round(float(v[i] @ v[q]), 5), i))[:5]
        assert sorted(r.vec_id for r in got if r.query_id == q) == sorted(best)


def test_pagerank_converges(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(12)] + [("n0", "n5"), ("n0", "n5")]
    w = np.zeros((13, 13))
    for a, b in edges:
        w[int(a[1:]), int(b[1:])] += 1
        w[int(b[1:]), int(a[1:])] += 1
    seed = np.eye(13)[0]
    want = 0.15 * np.linalg.solve(np.eye(13) - 0.85 * (w / w.sum(axis=1)[:, None]).T, seed)
    got = graph.pagerank(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([("n0",)], "id string")).collect()
    assert sum(abs(r.score - want[int(r.id[1:])]) for r in got) < 1e-3


def test_long_component(spark):
    edges = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}") for i in range(12)], "src string, dst string")
    assert {r.component for r in graph.min_label_components(edges).collect()} == {"n00"}


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_whole_cer(spark):
    got = {r.conv_id: r.cer for r in catalogue.queries()["cer_whole"](spark, SF).collect()}
    turns: dict = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        old = turns.setdefault(r.conv_id, {}).get(r.turn)
        turns[r.conv_id][r.turn] = r.text if old is None else max(old, r.text or old)
    assert set(got) == set(turns)
    tidy = lambda s: __import__("re").sub(r"[ \t\n\r\f\x0b]+", " ", (s or "").replace("#", "")).strip(" ")
    some = [c for c in sorted(turns) if len(turns[c].get(0) or "") < 1500 and len(turns[c].get(1) or "") < 1500][:25]
    for c in some:
        g, x = tidy(turns[c].get(0)), tidy(turns[c].get(1))
        assert abs(got[c] - (distance(g, x) / len(g) if g else float(bool(x)))) < 2e-6
