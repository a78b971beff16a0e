"""Quality rules with host verdicts, in DataFrame operations only.

Rules are judged on each document. Their failures are summed by host (the source column); a beta prior is fitted to the hosts' failure
rates by moments, less what chance alone spreads the rates of small hosts, and each host's rate is shrunk towards it. Hosts whose shrunk
rate has HOST_ODDS times the odds of the prior's mean are rejected with all their documents. Sums are combined before the shuffle, so a
host may hold any share of the rows.

Cases: a null text has no words and fails; a null source is a host of its own; repeated rows each give a row and each count for their
host; a rate right at the limit is kept; an empty table gives no rows; a very long text is an array of its words and one of its windows,
which a row holds at once; other columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, cut, join_stats, let, words

MIN_WORDS, REPEAT_PERCENT = 50, 50
#: A host is rejected where the odds of its shrunk failure rate are more than so many times those of all hosts.
HOST_ODDS = 6.0


def repeated_words(w: Column) -> Column:
    """Words within 3-word windows that are found twice or more. The windows are sorted with their places, so that equal ones are
    neighbours; then the lengths of the places' union are summed."""

    def places(s: Column) -> Column:
        at = lambda i: F.get(s, i)["t"]
        same = lambda x, i: ((i > 0) & (at(i - 1) == x["t"])) | ((i < F.size(s) - 1) & (at(i + 1) == x["t"]))
        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def union(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])

    def grams(ws: Column) -> Column:
        return F.array_sort(F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.struct(F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("t"), i.alias("i"))))

    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(w, lambda ws: let(grams(ws), lambda s: let(places(s), union))))


def rules(docs: DataFrame) -> DataFrame:
    """The documents' columns doc_id and source, and the figures of the rules."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        "doc_id", "source", words(F.col("text")).alias("w"),
        F.length(F.regexp_replace(text, SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    counted = base.select("doc_id", "source", F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", repeated_words(F.col("w")).cast("long").alias("n_repeat_words"))
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def host_rates(judged: DataFrame, host: str = "source", failed: str = "base_failed") -> DataFrame:
    """host, n, failures, the rate shrunk by a beta prior with the mean of all rows and the variance of the hosts' rates, and that mean.
    The prior's strength is kept between 1 and 1000 rows; with one host, or no variance beyond chance, it is 1000."""
    hosts = judged.groupBy(host).agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("n")
    prior = hosts.agg(F.sum("failures").alias("_f"), F.sum("n").alias("_n"), F.var_samp(rate).alias("_v"), F.avg(1 / F.col("n")).alias("_u"))
    mean = F.col("_f") / F.col("_n")
    spread = F.greatest(F.col("_v") - mean * (1 - mean) * F.col("_u"), F.lit(0.0))
    strength = F.coalesce(F.least(F.greatest(mean * (1 - mean) / F.nullif(spread, F.lit(0.0)) - 1, F.lit(1.0)), F.lit(1000.0)), F.lit(1000.0))
    both = hosts.withColumn("_one", F.lit(1)).join(F.broadcast(prior.withColumn("_one", F.lit(1))), "_one")
    return both.select(host, "n", "failures", ((F.col("failures") + strength * mean) / (F.col("n") + strength)).alias("rate"), mean.alias("mean"))


def verdicts(docs: DataFrame, odds: float = HOST_ODDS) -> DataFrame:
    """The figures, host_rate and kept for every row."""
    judged = cut(rules(docs).withColumn("host", F.coalesce("source", F.lit("\x00"))))
    rates = host_rates(judged, "host")
    # in products, for either rate may be 0 or 1
    good = F.col("rate") * (1 - F.col("mean")) <= odds * F.col("mean") * (1 - F.col("rate"))
    rates = cut(rates.select("host", "n", F.col("rate").alias("host_rate"), good.alias("host_kept")))
    return join_stats(judged, rates, ["host"], "n").withColumn("kept", ~F.col("base_failed") & F.col("host_kept")).drop("host", "source", "host_kept")


def digest(docs: DataFrame) -> DataFrame:
    return verdicts(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    row_number() OVER () AS r FROM documents),
g AS (SELECT r, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS t FROM (SELECT r, w, unnest(range(0, len(w) - 2)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY r),
f AS (
  SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT host, count(*) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS fails FROM j GROUP BY host),
p AS (SELECT sum(fails) / sum(n) AS m, var_samp(fails / n) AS v, avg(1.0::DOUBLE / n) AS u FROM h),
s AS (SELECT m, coalesce(least(greatest(m * (1 - m) / nullif(greatest(v - m * (1 - m) * u, 0), 0) - 1, 1.0), 1000.0), 1000.0) AS k FROM p),
rates AS (SELECT host, (fails + k * m) / (n + k) AS rate, m FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate * (1 - m) <= 6.0 * m * (1 - rate) AS kept
FROM j JOIN rates USING (host)
"""
