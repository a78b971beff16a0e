"""Retrieval metrics, conversion lint, OCR scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def metrics(ranked: DataFrame, query: str, rank: str, match: str, k: int) -> DataFrame:
    """query, hit, rr, precision: of the first k rows by rank; precision is over the rows there are."""
    top = ranked.where(F.col(rank) <= k)
    first = F.min(F.when(F.col(match), F.col(rank)))
    return top.groupBy(query).agg(first.isNotNull().alias("hit"), F.round(F.coalesce(1.0 / first, F.lit(0.0)), 6).alias("rr"), F.round(F.avg(F.col(match).cast("double")), 6).alias("precision"))


def lint(lines: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_headings, n_table_rows, bar_spread: how much the number of bars differs between table rows."""
    bars = F.length("line") - F.length(F.replace("line", F.lit("|")))
    marked = lines.select(id_col, F.when(bars > 0, bars).alias("bars"), F.col("line").rlike(r"^#{1,6} ").cast("int").alias("h"))
    return marked.groupBy(id_col).agg(F.sum("h").alias("n_headings"), F.count("bars").alias("n_table_rows"), (F.max("bars") - F.min("bars")).alias("bar_spread"))


def multiset_delta(a: Column, b: Column) -> Column:
    """How many elements of array a are missing from b, as multisets."""
    count = lambda side, x: F.size(F.filter(side, lambda y: y == x))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda s, x: s + F.greatest(count(a, x) - count(b, x), F.lit(0)))


def witness(pairs: DataFrame, id_col: str, reference: str, candidate: str) -> DataFrame:
    """id, recall, numbers_missing, numbers_added between two texts."""
    a, b = T.numbers(F.col(reference)), T.numbers(F.col(candidate))
    return pairs.select(id_col, F.round(T.token_recall(F.col(reference), F.col(candidate)), 6).alias("recall"), multiset_delta(a, b).alias("numbers_missing"), multiset_delta(b, a).alias("numbers_added"))


# The least share of text that a conversion keeps, the least recall of a witness, and how many numbers a defect names.
LEAST_TEXT, LEAST_RECALL, NAMED = 0.5, 0.8, 10


def text_length(body: Column) -> Column:
    """Characters of the lines without marks of headings, lists, quotes and tables."""
    bare = lambda x: F.replace(F.replace(F.regexp_replace(F.regexp_replace(F.btrim(x), r"^#{1,6}\s+", ""), r"^(?:[-*+>]|\d+\.)\s+", ""), F.lit("|")), F.lit("---"))
    return F.aggregate(F.split(body, "\n"), F.lit(0), lambda n, x: n + F.length(bare(x)))


def ragged_rows(body: Column) -> Column:
    """Rows of tables with another number of cells than their header; a table is a block of bar lines between blank ones."""
    bars = lambda x: F.length(x) - F.length(F.replace(x, F.lit("|")))

    def of(block: Column) -> Column:
        rows = F.filter(F.split(block, "\n"), lambda x: F.btrim(x) != "")
        table = (F.size(rows) > 2) & F.forall(rows, lambda x: x.rlike(r"^\|.*\|\s*$"))
        odd = F.filter(F.slice(rows, 3, F.greatest(F.size(rows), F.lit(1))), lambda x: bars(x) != bars(F.get(rows, F.lit(0))))
        return F.when(table, F.size(odd)).otherwise(0)

    return F.aggregate(F.transform(F.split(body, "\n\n"), of), F.lit(0), lambda n, x: n + x)


def conversion_defects(markdown: Column, raw_chars: Column) -> Column:
    """no-headings, text-loss and table-ragged, as far as they apply, of a text whose front matter doesn't count."""
    body = F.regexp_replace(F.coalesce(markdown, F.lit("")), r"(?s)\A---\n.*?\n---\n", "")
    ratio = text_length(body) / raw_chars
    ragged = ragged_rows(body)
    return F.array_compact(F.array(
        F.when(~body.rlike(r"(?m)^#"), "no-headings"), F.when((raw_chars > 0) & (ratio < LEAST_TEXT), F.concat(F.lit("text-loss: "), F.format_string("%.2f", ratio))),
        F.when(ragged > 0, F.concat(F.lit("table-ragged: "), ragged.cast("string"))),
    ))


def whole_numbers(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[0-9]+"), F.lit(0))


def surplus(a: Column, b: Column) -> Column:
    """Numbers that array a has more often than b, each once, by value."""
    count = lambda side, x: F.size(F.filter(side, lambda y: y == x))
    more = F.filter(F.array_distinct(a), lambda x: count(a, x) > count(b, x))
    bare = lambda x: F.regexp_replace(x, "^0+(?=.)", "")
    return F.transform(F.array_sort(F.transform(more, lambda x: F.struct(F.length(bare(x)).alias("n"), bare(x).alias("v"), x.alias("x")))), lambda s: s["x"])


def _named(xs: Column) -> Column:
    rest = F.size(xs) - NAMED
    return F.when(F.size(xs) == 0, "none").otherwise(F.concat(F.array_join(F.slice(xs, 1, NAMED), ","), F.when(rest > 0, F.concat(F.lit("…+"), rest.cast("string"))).otherwise("")))


def witness_defects(witness_text: Column, text: Column) -> Column:
    """text-loss and numeric-divergence of a text against an independent witness; an empty witness says nothing."""
    recall = T.token_recall(witness_text, text)
    a, b = whole_numbers(witness_text), whole_numbers(text)
    differ = (multiset_delta(a, b) > 0) | (multiset_delta(b, a) > 0)
    told = F.concat(F.lit("numeric-divergence: witness_only=["), _named(surplus(a, b)), F.lit("] text_only=["), _named(surplus(b, a)), F.lit("]"))
    found = F.array_compact(F.array(F.when(recall < LEAST_RECALL, F.concat(F.lit("text-loss: "), F.format_string("%.2f", recall))), F.when(differ, told)))
    return F.when(F.btrim(F.coalesce(witness_text, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(found)


def heading_list(text: Column) -> Column:
    """level:title of the headings of a text outside fences, in order."""
    state = lambda out, fence: F.struct(out.alias("out"), fence.alias("fence"))

    def step(a: Column, line: Column) -> Column:
        mark = line.rlike(r"^\s*```")
        level, title = F.length(F.regexp_extract(line, r"^(#{1,6})\s+\S", 1)), F.btrim(F.regexp_replace(line, r"^#{1,6}\s+", ""))
        own = F.when(mark | a["fence"] | (level == 0), F.array().cast("array<string>")).otherwise(F.array(F.concat(level.cast("string"), F.lit(":"), title)))
        return state(F.concat(a["out"], own), a["fence"] != mark)

    return F.aggregate(F.split(F.coalesce(text, F.lit("")), "\n"), state(F.array().cast("array<string>"), F.lit(False)), step, lambda a: a["out"])


def page_score(gold: Column, candidate: Column) -> Column:
    """Struct of cer, recall of accented letters, numbers missing and added, headings of gold and those found."""
    a, b, g, h = whole_numbers(gold), whole_numbers(candidate), heading_list(gold), heading_list(candidate)
    return F.struct(
        T.cer(gold, candidate).alias("cer"), T.char_recall(gold, candidate).alias("accents"), multiset_delta(a, b).alias("numbers_missing"), multiset_delta(b, a).alias("numbers_added"),
        F.size(g).alias("headings"), (F.size(g) - multiset_delta(g, h)).alias("headings_found"),
    )


def divergence(candidates: DataFrame, id_col: str, name: str, text: str) -> DataFrame:
    """id, left, right, and what numbers and headings either text has more than the other: each pair of a document's candidates, of which there
    are a few. Candidates that failed (null text) are left out."""
    own = candidates.where(F.col(text).isNotNull()).select(id_col, F.col(name).alias("_n"), whole_numbers(F.col(text)).alias("_x"), heading_list(F.col(text)).alias("_h"))
    a, b = (own.select(id_col, *[F.col(c).alias(f"{c}{k}") for c in ("_n", "_x", "_h")]) for k in "ab")
    only = lambda x, y: F.array_sort(F.array_except(x, y))
    return a.join(b, id_col).where("_na < _nb").select(
        id_col, F.col("_na").alias("left"), F.col("_nb").alias("right"), surplus(F.col("_xa"), F.col("_xb")).alias("numbers_left"), surplus(F.col("_xb"), F.col("_xa")).alias("numbers_right"),
        only(F.col("_ha"), F.col("_hb")).alias("headings_left"), only(F.col("_hb"), F.col("_ha")).alias("headings_right"),
    )
