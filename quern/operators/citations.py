"""Citation patterns as a registry of (rule, regex, canonical form); extraction, resolution and leads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The shapes of identifiers.
PATTERNS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "celex": (r"\b[1-9][0-9]{4}[A-Z]{1,2}[0-9]{4}\b", F.upper),
    "iso": (r"\bISO(?:/IEC)? [0-9]{4,5}(?:-[0-9]+)?\b", lambda c: F.regexp_replace(c, "[ ]+", " ")),
    "license": (r"\b(?:MIT|Apache|GNU General Public) License\b", F.lower),
    "ipv4": (r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", lambda c: c),
    "email": (r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", F.lower),
}


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", patterns: dict | None = None) -> DataFrame:
    """id, identifier, rule: distinct; of several rules for an identifier the first by name."""

    def of(rule: str, rx: str, form: Callable[[Column], Column]) -> Column:
        return F.transform(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(rx), F.lit(0)), lambda x: F.struct(form(x).alias("identifier"), F.lit(rule).alias("rule")))

    found = [of(rule, *x) for rule, x in (patterns or PATTERNS).items()]
    each = docs.select(id_col, F.explode(F.concat(*found)).alias("x"))
    return each.groupBy(id_col, F.col("x.identifier").alias("identifier")).agg(F.min("x.rule").alias("rule"))


def resolve(found: DataFrame, owners: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """source, target, identifier, rule: citations of identifiers that a document owns, without those of itself."""
    return found.join(owners.select("identifier", F.col("owner")), "identifier").where(F.col("owner") != F.col(id_col)).select(F.col(id_col).alias("source_id"), F.col("owner").alias("target_id"), "identifier", "rule")


def leads(found: DataFrame, owners: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """identifier, rule, n_cited_by, first_cited_by of identifiers that no document owns."""
    return found.join(owners, "identifier", "left_anti").groupBy("identifier").agg(F.min("rule").alias("rule"), F.countDistinct(id_col).alias("n_cited_by"), F.min(id_col).alias("first_cited_by"))
