"""Postings, BM25 and phrases. A text is split into tokens once; what is kept of it are its length and the query's terms."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import cut
from ..functions import text as T

K1, B, IDF_FLOOR = 1.2, 0.75, 1e-6


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """term, id, tf, positions."""
    each = docs.select(id_col, F.posexplode(T.tokens(F.col(text_col))).alias("pos", "term"))
    return each.groupBy("term", id_col).agg(F.count("*").alias("tf"), F.sort_array(F.collect_list("pos")).alias("positions"))


def bm25(docs: DataFrame, terms: Sequence[str], id_col: str = "doc_id", text_col: str = "text", every: bool = False) -> DataFrame:
    """id, score of documents with any term (or every one): lengths and the document count are of all documents. One pass over the texts
    leaves a length and the terms' counts a document, from which statistics and scores are taken."""
    terms = list(terms)
    own = lambda w: F.filter(w, lambda x: x.isin(terms))
    count = lambda q, t: F.size(F.filter(q, lambda x: x == F.lit(t)))
    figures = T.let(T.tokens(F.col(text_col)), lambda w: F.struct(F.size(w).alias("dl"), T.let(own(w), lambda q: F.array(*[count(q, t) for t in terms])).alias("tf")))
    return _scored(docs.select(id_col, figures.alias("x")), len(terms), id_col, every)


def _scored(figures: DataFrame, n_terms: int, id_col: str, every: bool) -> DataFrame:
    """id, score from x (dl, tf) of all documents, which are written once for statistics and scores."""
    counted = cut(figures.select(id_col, "x.dl", "x.tf"))
    stats = counted.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col("tf")[i] > 0).alias(f"df{i}") for i in range(n_terms)])
    has = F.forall("tf", lambda x: x > 0) if every else F.exists("tf", lambda x: x > 0)
    both = counted.where(has).withColumn("_one", F.lit(1)).join(F.broadcast(stats.withColumn("_one", F.lit(1))), "_one")
    norm = K1 * (1 - B + B * F.col("dl") / F.col("avgdl"))
    idf = lambda i: F.greatest(F.log((F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5)), F.lit(IDF_FLOOR))
    score = sum((idf(i) * F.col("tf")[i] * (K1 + 1) / (F.col("tf")[i] + norm) for i in range(n_terms)), F.lit(0.0))
    return both.select(id_col, F.round(score, 6).alias("score"))


def phrase(docs: DataFrame, words: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n: documents where the words follow one another, and how often. Tokens are joined by single spaces, and places counted
    from which the phrase follows, so that overlapping ones count."""
    joined = F.concat(F.lit(" "), F.array_join(T.tokens(F.col(text_col)), " "), F.lit(" "))
    places = F.regexp_count(joined, F.lit(f"(?= {re.escape(' '.join(words))} )"))
    return docs.select(id_col, places.alias("n")).where("n > 0")


def query_phrases(query: str) -> list[list[str]]:
    """A query as phrases that must all occur: white space separates them, and what is split further inside one is a phrase."""
    parts = [[w for w in re.split(r"[\W_]+", x.lower()) if w] for x in query.split()]
    return [p for p in parts if p]


def search(docs: DataFrame, query: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score: documents that have every phrase of the query, scored by BM25 with a phrase counted as one term; no document for a
    query without a word."""
    phrases = [" ".join(p) for p in query_phrases(query)]
    if not phrases:
        return docs.select(id_col, F.lit(0.0).alias("score")).where(F.lit(False))
    joined = lambda w: F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
    tf = lambda s: F.array(*[F.regexp_count(s, F.lit(f"(?= {re.escape(p)} )")) for p in phrases])
    figures = T.let(T.tokens(F.col(text_col)), lambda w: F.struct(F.size(w).alias("dl"), T.let(joined(w), tf).alias("tf")))
    return _scored(docs.select(id_col, figures.alias("x")), len(phrases), id_col, True)
