"""Quality classifier with hierarchical empirical Bayes.

A logistic regression on figures of a text gives each document's probability of low quality. These are summed by host and path; a beta
prior over hosts shrinks each host's rate to the global one, and a prior over paths shrinks each path's rate to its host's, both fitted by
moments, so sparse sites lean on what is above them. A document's log-odds move by SITE_WEIGHT times what its path's posterior differs
from the global one.

host and path are columns; documents have no paths, so source and lang stand for them. Labels are learned from at most SAMPLE rows of a
class. Cases: a null or empty text is of low quality; a null host or path is one of its own; without labels of both classes the evidence
of every text with words is 0; repeated rows each give a row and each count; a document right at the limit is rejected; an empty table gives
no rows; a very long text is read whole; other columns keep their values, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fit_logistic, join_stats, labelled_sample, tune

SAMPLE, SITE_WEIGHT, LIMIT = 4000, 0.25, 0.5
SYMBOLS = "#*$%&|<>!"
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
STOP = re.compile(r"[.!?](?=\s|$)")


def figures(text: str | None) -> list[float]:
    w = (text or "").split()
    n = max(1, len(w))
    distinct = len(set(w))
    twice = sum(map(str.__eq__, w, w[1:]))
    t = text or ""
    lines = [x for x in t.split("\n") if x.strip()]
    return [
        min(3.0, sum(map(t.count, SYMBOLS)) / n), min(1.0, len(UPPER.findall(t)) / max(1, len(t))), twice / n, min(1.0, distinct / n),
        1.0 - min(1.0, distinct / (8 * n**0.75)), min(0.3, len(STOP.findall(t)) / n), min(20.0, len(t) / n) / 10, min(10.0, float(np.log1p(n))) / 10,
        1.0 - len(set(lines)) / max(1, len(lines)), min(2.0, t.count(" | ") / n * 4),
    ]


def evidence(docs: DataFrame, weights: np.ndarray | None, name: str = "p") -> DataFrame:
    """The documents' columns and the probability of low quality."""
    tune(docs.sparkSession)
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].to_pylist()
            empty = np.array([not (t and t.strip()) for t in texts], bool)
            p = np.zeros(len(texts))
            if weights is not None and len(texts):
                x = np.array([figures(t) for t in texts])
                p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.where(empty, 1.0, p), pa.float64())], [*names, name])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", `{name}` double")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    tune(docs.sparkSession)
    chosen = labelled_sample(labels, "quality", sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["y"], pa.array([figures(t.as_py()) for t in b["text"]], pa.list_(pa.float64()))], ["y", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("y", "text").mapInArrow(run, "y int, x array<double>").collect()
    low = 1.0 - np.array([r["y"] for r in rows], float)
    if not len(low) or low.min() == low.max():
        return None
    return fit_logistic(np.array([r["x"] for r in rows]), low, 1e-4)


def _strength(mean: Column, var: Column) -> Column:
    """The prior's weight in rows, by moments, between 1 and 1000."""
    return F.coalesce(F.least(F.greatest(mean * (1 - mean) / F.nullif(var, F.lit(0.0)) - 1, F.lit(1.0)), F.lit(1000.0)), F.lit(1000.0))


def site_rates(scored: DataFrame, host: str, path: str) -> DataFrame:
    """_h, _p, n, host_rate, path_rate, base_rate: rows and posteriors of hosts and paths, from column p."""
    null = F.lit("\x00")
    paths = scored.groupBy(F.coalesce(host, null).alias("_h"), F.coalesce(path, null).alias("_p")).agg(F.count("*").alias("n"), F.sum("p").alias("s"))
    paths = cut(paths)
    hosts = paths.groupBy("_h").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    whole = hosts.agg((F.sum("hs") / F.sum("hn")).alias("base_rate"), F.var_samp(F.col("hs") / F.col("hn")).alias("v")).withColumn("_one", F.lit(1))
    k = _strength(F.col("base_rate"), F.col("v"))
    hosts = hosts.withColumn("_one", F.lit(1)).join(F.broadcast(whole), "_one").select("_h", "base_rate", ((F.col("hs") + k * F.col("base_rate")) / (F.col("hn") + k)).alias("host_rate"))
    both = paths.join(hosts, "_h")
    spread = both.agg(F.avg(F.pow(F.col("s") / F.col("n") - F.col("host_rate"), 2)).alias("v")).withColumn("_one", F.lit(1))
    k = _strength(F.col("host_rate"), F.col("v"))
    return both.withColumn("_one", F.lit(1)).join(F.broadcast(spread), "_one").select("_h", "_p", "n", "base_rate", "host_rate", ((F.col("s") + k * F.col("host_rate")) / (F.col("n") + k)).alias("path_rate"))


def _logit(x: Column) -> Column:
    x = F.least(F.greatest(x, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(x / (1 - x))


def combined(scored: DataFrame, sites: DataFrame, host: str, path: str) -> DataFrame:
    """Adds host_rate, path_rate and low, the probability of low quality after both levels."""
    null = F.lit("\x00")
    keyed = scored.withColumns({"_h": F.coalesce(host, null), "_p": F.coalesce(path, null)})
    odds = _logit(F.col("p")) + SITE_WEIGHT * (_logit(F.col("path_rate")) - _logit(F.col("base_rate")))
    return join_stats(keyed, sites, ["_h", "_p"], "n").withColumn("low", 1 / (1 + F.exp(-odds))).drop("_h", "_p", "base_rate")


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """doc_id, host, path, p, host_rate, path_rate, low, kept for every row."""
    weights = train(docs, labels, sample)
    scored = cut(evidence(docs.select("doc_id", host, path, "text"), weights).drop("text"))
    sites = cut(site_rates(scored, host, path))
    return combined(scored, sites, host, path).withColumn("kept", F.col("low") < LIMIT)


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """The documents that are not rejected."""
    weights = train(docs, labels, sample)
    sites = cut(site_rates(evidence(docs.select(host, path, "text"), weights), host, path))
    own = docs.columns
    tagged = docs.select(*[F.col(c).alias(f"c{i}") if c not in ("text", host, path) else F.col(c) for i, c in enumerate(own)])
    low = combined(evidence(tagged, weights), sites, host, path).where(F.col("low") < LIMIT)
    return low.select(*[F.col(f"c{i}").alias(c) if c not in ("text", host, path) else F.col(c) for i, c in enumerate(own)])


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    r = lambda c: F.round(c, 6).alias(c)
    return classify(docs, labels).select("doc_id", "source", "lang", r("p"), r("host_rate"), r("path_rate"), r("low"), "kept")
