"""Toxicity by compression distance.

Two dictionaries are trained with zstandard's trainer: one on windows of ordinary text, one on what toxic text has of its own, which are the
words that it has surely more than ordinary text (by the lower bound of their log-odds over documents, near copies counted once by the least
hash of their 3-word shingles). Trained on whole toxic texts, the trainer picks what the classes have in common; see the README for figures.
A text is cut into windows of WINDOW words. A window's distance is how many bytes shorter it compresses with the toxic dictionary in
front of the ordinary one than with the ordinary one, so that the lengths differ by what is toxic alone. A logistic curve, fitted on rows
that no dictionary has seen, turns a text's distances into a score.

Labels are learned from rows whose crc32(doc_id as text) mod 3 is 0 (dictionaries) or 2 (curve); at most SAMPLE rows of a class each and
WINDOWS ordinary windows, which bounds what the driver gets. Cases: null and empty texts are scored as texts without a window; null ids are
scored and count as not held out; without labels of both classes, or words that toxic text has of its own, every score is 0; repeated rows
each give a row; ties of samples are cut by id; an empty table gives no rows; a very long text is scored window by window; other columns
are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fit_logistic, labelled_sample, tune, words

#: Labelled rows of a class that are learned from at most, ordinary windows that a dictionary is trained on at most, words of a window, the
#: score of a 1.
SAMPLE, WINDOWS, WINDOW, THRESHOLD = 3000, 80_000, 10, 0.7
#: A word of toxic text's own is in so many toxic documents and in this share of them at least, and has this lower bound of its log-odds.
LEAST, SHARE, ODDS = 4, 0.008, 2.5
#: Bytes of the ordinary dictionary and, of toxic ones, bytes for each of the words; the trainer's segments and their parts.
ORDINARY, TOXIC, SEGMENT, PART = 32_768, 4, (16, 48), (6, 8)
PARAMS = {"window_log": 17, "chain_log": 14, "hash_log": 15, "search_log": 4, "min_match": 4, "target_length": 32, "strategy": zstandard.STRATEGY_LAZY}


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def trained(samples: list[bytes], size: int, segment: int, part: int) -> bytes:
    """A dictionary of the size by zstandard's trainer; of few samples a smaller one, and of too few for the trainer the samples themselves."""
    total = sum(map(len, samples))
    if not total:
        return b""
    size = min(size, max(256, total // 8))
    try:
        return zstandard.train_dictionary(size, samples * (1 + 64 * size // total), k=segment, d=part).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionaries(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[bytes, bytes]:
    """The contents of the toxic and the ordinary dictionary, from rows of fold 0."""
    chosen = labelled_sample(labels, "toxic", sample, fold() == 0)
    shingles = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 3, F.lit(0))), lambda i: F.xxhash64(F.array_join(F.slice("w", i + 1, 3), " ")))
    own = docs.join(F.broadcast(chosen), "doc_id").select("y", "doc_id", words(F.lower("text")).alias("w")).withColumn("sig", F.array_min(shingles)).where("size(w) > 0")
    own = cut(own.groupBy("y", "sig").agg(F.min(F.struct("doc_id", "w")).alias("x")).select("y", "x.doc_id", "x.w"))
    n = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()}
    counts = own.select("y", F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o"))
    rate = lambda c, y: (F.col(c) + 0.5) / (n.get(y, 0) + 1)
    bound = F.log(rate("t", 1) / rate("o", 0)) - F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("o") + 0.5))
    of_toxic = cut(counts.where((bound > ODDS) & (F.col("t") >= max(LEAST, round(SHARE * n.get(1, 0))))).select("word"))
    each = own.where("y = 1").select("doc_id", F.posexplode("w").alias("i", "word")).join(F.broadcast(of_toxic), "word")
    toxic = each.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("t")).orderBy("doc_id").collect()
    windows = F.transform(F.sequence(F.lit(0), F.size("w") - 1, F.lit(WINDOW)), lambda i: F.array_join(F.slice("w", i + 1, WINDOW), " "))
    ordinary = own.where("y = 0").select(F.explode(windows).alias("t")).orderBy(F.xxhash64("t"), "t").limit(WINDOWS).collect()
    spaced = lambda rows: [f" {r['t']} ".encode() for r in rows]
    size = TOXIC * (of_toxic.agg(F.sum(F.octet_length("word") + 1)).first()[0] or 0)
    base = trained(spaced(ordinary), ORDINARY, SEGMENT[0], PART[0])
    # what comes last is cheapest to refer to: common words, so that a toxic word isn't paid for by worse matches of the others
    return trained(spaced(toxic), size, SEGMENT[1], PART[1]) + base, base


@functools.lru_cache(4)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(**PARAMS, write_content_size=0, write_checksum=0, write_dict_id=0)
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=params)


def distances(text: str | None, toxic: bytes, ordinary: bytes) -> np.ndarray:
    """Bytes saved by the toxic dictionary, of each window of the whole text."""
    w = (text or "").lower().split()
    a, b = _compressor(toxic).compress, _compressor(ordinary).compress
    out = []
    for i in range(0, len(w), WINDOW):
        x = (" " + " ".join(w[i : i + WINDOW]) + " ").encode("utf-8", "surrogatepass")
        out.append(len(b(x)) - len(a(x)))
    return np.array(out, np.int64)


def figures(text: str | None, toxic: bytes, ordinary: bytes) -> list[float]:
    """Greatest distance, third greatest, share of windows over 3 bytes, and the log of their number."""
    d = np.sort(distances(text, toxic, ordinary))[::-1]
    if not len(d):
        return [0.0, 0.0, 0.0, 0.0]
    over = float((d > 3).sum())
    return [float(min(d[0], 24)), float(min(d[2], 24)) if len(d) > 2 else 0.0, over / len(d), float(np.log1p(over))]


def _scored(docs: DataFrame, contents: tuple[bytes, bytes], keep: list[str]) -> DataFrame:
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [figures(t.as_py(), *contents) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", x array<double>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The dictionaries' contents and the curve's weights."""
    tune(docs.sparkSession)
    contents = dictionaries(docs, labels, sample)
    chosen = labelled_sample(labels, "toxic", sample, fold() == 2)
    rows = _scored(docs.join(F.broadcast(chosen), "doc_id"), contents, ["y"]).collect()
    y = np.array([r["y"] for r in rows], float)
    if not len(y) or y.min() == y.max() or contents[0] == contents[1]:
        return {"contents": contents, "weights": None}
    return {"contents": contents, "weights": fit_logistic(np.array([r["x"] for r in rows]), y, 1e-3, balanced=False)}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score of every row."""
    tune(docs.sparkSession)
    contents, weights = model["contents"], model["weights"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if weights is None:
                p = np.zeros(b.num_rows)
            else:
                x = np.array([figures(t.as_py(), *contents) for t in b["text"]]).reshape(-1, len(weights) - 1)
                p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.array(p, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = F.coalesce(fold() == 1, F.lit(False))
    return score(docs, train(docs, labels)).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
