"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Each benchmark item is cut into windows of 8 consecutive words. The words of a window are ordered by their rarity in all documents; full
containment is asked for, so the prefix that a containing document must share has one word, the rarest. Documents' words join these
prefix words, the window must fit between the first and last word of the document where the word stands (length and positional bounds),
and the window is then compared word by word with the document at that place.

The prefix words are broadcast only where their counted number is small; else words that are no prefix are dropped by a broadcast of
hashes, itself of a counted number, candidates are found with a shuffled join, and texts are joined back to verify.

Cases: a null text has no words; an item without words has no windows and one of fewer words than a window is one window; repeated
documents each give a row; items of a null item_id are left out; repeated items count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, row_key

WINDOW, MIN_ITEMS = 8, 2
#: Hashes of prefix words that are broadcast at most: some 50 MB.
KEY_ROWS = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """Words after A-Z are lower-cased; lower() does the same on texts without other capitals, and faster."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(low, GAP), "")


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, win: the distinct windows of each item."""
    w = benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return w.select("item_id", "w", F.explode(starts).alias("i")).select("item_id", F.slice("w", F.col("i") + 1, size).alias("win")).distinct()


def prefixes(win: DataFrame, words: DataFrame) -> DataFrame:
    """word, off, n, win: the rarest word of each distinct window, its place and the window's length. words: column w of all documents."""
    each = win.select("win").distinct()
    vocab = each.select(F.explode("win").alias("word")).distinct()
    small = vocab.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    said = words.select(F.explode("w").alias("word"))
    counts = said.join(F.broadcast(vocab) if small else vocab, "word", "left_semi").groupBy("word").count()
    placed = each.select("win", F.posexplode("win").alias("off", "word")).join(counts, "word", "left")
    rarest = placed.groupBy("win").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("c"), "word", "off")).alias("x"))
    return rarest.where("x.c > 0").select(F.col("x.word").alias("word"), F.col("x.off").alias("off"), F.size("win").alias("n"), "win")


def matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """k1, k2 (see row_key), start, win: every occurrence of a window in a document."""
    words = docs.select(*row_key(), item_words(F.col("text")).alias("w"))
    prefix = cut(prefixes(windows(benchmark, size), words))
    fits = (F.col("pos") >= F.col("off")) & (F.col("pos") - F.col("off") + F.col("n") <= F.col("size"))
    start = (F.col("pos") - F.col("off")).alias("start")
    verified = F.slice("w", F.col("start") + 1, F.col("n")) == F.col("win")
    if prefix.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        at = words.select("k1", "k2", "w", F.size("w").alias("size"), F.posexplode("w").alias("pos", "word"))
        found = at.join(F.broadcast(prefix), "word").where(fits).select("k1", "k2", "w", start, "n", "win").where(verified)
        return found.select("k1", "k2", "start", "win").distinct()
    at = words.select("k1", "k2", F.size("w").alias("size"), F.posexplode("w").alias("pos", "word"))
    # only prefix words are shuffled, which are the rarest of their windows: others are dropped by a broadcast of the words' hashes, up to
    # KEY_ROWS longs. The longer side is dealt by word and split by AQE
    keys = prefix.select(F.xxhash64("word").alias("h")).distinct()
    if keys.limit(KEY_ROWS + 1).count() <= KEY_ROWS:
        at = at.join(F.broadcast(keys), F.xxhash64(at.word) == keys.h, "left_semi")
    near = at.join(prefix, "word").where(fits).select("k1", "k2", start, "n", "win").distinct()
    return near.join(words, ["k1", "k2"]).where(verified).select("k1", "k2", "start", "win").distinct()


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """k1, k2, n_hit, items: of the documents with any window."""
    found = cut(matches(docs, benchmark, size))
    covered = found.select("k1", "k2", F.explode(F.sequence(F.col("start"), F.col("start") + F.size("win") - 1)).alias("p")).distinct()
    n_hit = covered.groupBy("k1", "k2").agg(F.count("*").alias("n_hit"))
    of = cut(windows(benchmark, size))
    pairs = found.select("k1", "k2", "win").distinct()
    few = of.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    items = pairs.join(F.broadcast(of) if few else of, "win").groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return n_hit.join(items, ["k1", "k2"])


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, min_items: int = MIN_ITEMS) -> DataFrame:
    """doc_id, n_words, n_hit, items, contaminated for every row."""
    own = docs.select("doc_id", *row_key(), F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    joined = own.join(cut(hits(docs, benchmark, size)), ["k1", "k2"], "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), items.alias("items"), (F.size(items) >= min_items).alias("contaminated"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    items = F.col("items")
    return contamination(docs, benchmark).select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, min_items: int = MIN_ITEMS) -> DataFrame:
    """The documents that are not contaminated."""
    bad = hits(docs, benchmark, size).where(F.size("items") >= min_items).select(F.col("k1").alias("__quern_k1"), F.col("k2").alias("__quern_k2"))
    k1, k2 = row_key()
    keyed = docs.withColumns({"__quern_d1": k1, "__quern_d2": k2})
    return keyed.join(bad, (F.col("__quern_d1") == F.col("__quern_k1")) & (F.col("__quern_d2") == F.col("__quern_k2")), "left_anti").drop("__quern_d1", "__quern_d2")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + 8], ' ') AS win, least(len(w), 8) AS n
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 8, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
