"""Formal citations of legal acts and standards: each rule finds its form in a text and writes it as a canonical identifier."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of act types, the years an act may have, the century of two-digit years in the gazette, and the forms.
LETTER = {"regulation": "R", "directive": "L", "decision": "D", "reg": "R", "dir": "L", "dec": "D"}
YEARS, GAZETTE_CENTURY = (1950, 2049), 2000
CELEX = r"\b3\d{4}[LRDE]\d{4}\b"
EU_ACT = r"\b(?:Regulation|Directive|Decision)s?\s+\((?:EU|EC|EEC|Euratom)\)\s+(?:No\s+)?\d{1,4}\s*/\s*\d{1,4}\b"
EU_ACT_SLASH = r"\b(?:Directive|Decision|Regulation)s?\s+\d{2,4}\s*/\s*\d{1,4}\s*/\s*(?:EC|EEC|EU|Euratom)\b"
ELI = r"(?i)\b(?:data|eur-lex)\.europa\.eu/eli/(?:reg|dir|dec)/\d{4}/\d{1,4}\b"
GAZETTE = r"(?i)(?:Службени\s+лист\s+ЦГ|Slu[žz]beni\s+list\s+CG)[\"“”„»']*\s*,?\s*(?:бр|br)\.?\s*\d+\s*/\s*\d{2,4}(?:\s*(?:,|и|i)\s*\d+\s*/\s*\d{2,4})*"
ISO = r"\bISO(?:/IEC)?\s+\d{3,5}(?:-\d+)?(?::\d{4})?\b"
NIST = r"\bNIST\s+(?:SP\s+800-\d+[A-Za-z]?|AI\s+\d+(?:-\d+)?)\b"
URL_ANCHOR = r"(?i)CELEX(?::|%3A)(\d{5}[A-Z]{1,3}\d{2,8}(?:R?\(\d{2}\))?(?:-\d{8})?)"


def _part(x: Column, rx: str, group: int = 1) -> Column:
    return F.regexp_extract(x, rx, group)


def _act(kind: Column, year: Column, number: Column) -> Column:
    """The identifier of an act; null for a year no act can have."""
    letter = F.create_map(*[F.lit(v) for kv in LETTER.items() for v in kv])[F.lower(kind)]
    full = F.when(year < 100, year + 1900).otherwise(year)
    name = F.concat(F.lit("CELEX:3"), F.lpad(full.cast("string"), 4, "0"), letter, F.lpad(number.cast("string"), 4, "0"))
    return F.when(full.between(*YEARS), name)


def _eu_act(x: Column) -> Column:
    a, b = (_part(x, r"(\d{1,4})\s*/\s*(\d{1,4})$", k).cast("int") for k in (1, 2))
    numbered = x.rlike(r"\)\s+No\s")  # number/year, not year/number
    return F.array(_act(_part(x, "^(Regulation|Directive|Decision)"), F.when(numbered, b).otherwise(a), F.when(numbered, a).otherwise(b)))


def _eu_act_slash(x: Column) -> Column:
    year, number = (_part(x, r"(\d{2,4})\s*/\s*(\d{1,4})\s*/", k).cast("int") for k in (1, 2))
    return F.array(_act(_part(x, "^(Regulation|Directive|Decision)"), year, number))


def _eli(x: Column) -> Column:
    rx = r"(?i)/eli/(reg|dir|dec)/(\d{4})/(\d{1,4})$"
    return F.array(_act(_part(x, rx, 1), _part(x, rx, 2).cast("int"), _part(x, rx, 3).cast("int")))


def _gazette(x: Column) -> Column:
    def one(item: Column) -> Column:
        number, year = (_part(item, r"(\d+)\s*/\s*(\d+)", k) for k in (1, 2))
        full = F.when(F.length(year) == 4, year.cast("int")).otherwise(year.cast("int") + GAZETTE_CENTURY)
        return F.concat(F.lit("SLCG:"), number.cast("long").cast("string"), F.lit("/"), full.cast("string"))

    return F.transform(F.regexp_extract_all(x, F.lit(r"\d+\s*/\s*\d{2,4}"), F.lit(0)), one)


def _iso(x: Column) -> Column:
    return F.array(F.concat(F.when(x.startswith("ISO/IEC"), "ISO/IEC ").otherwise("ISO "), _part(x, r"\s(\S+)$")))


def _nist(x: Column) -> Column:
    sp = _part(x, r"SP\s+800-(\S+)$")
    return F.array(F.when(sp != "", F.concat(F.lit("NIST SP 800-"), sp)).otherwise(F.concat(F.lit("NIST AI "), _part(x, r"AI\s+(\S+)$"))))


#: The registry: a rule's form, and the identifiers that a match stands for.
RULES: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "celex": (CELEX, lambda x: F.array(F.concat(F.lit("CELEX:"), F.upper(x)))),
    "eli_uri": (ELI, _eli),
    "eu_act": (EU_ACT, _eu_act),
    "eu_act_slash": (EU_ACT_SLASH, _eu_act_slash),
    "iso": (ISO, _iso),
    "nist": (NIST, _nist),
    "sluzbeni_list_cg": (GAZETTE, _gazette),
}
ALIAS = "alias"


def extract(docs: DataFrame, aliases: Mapping[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", rules: Mapping | None = None) -> DataFrame:
    """id, identifier, rule: distinct. Of several rules the first by name is told, an alias only where no rule found the identifier. An
    alias is found in either case, where no letter or digit adjoins it."""
    text = F.coalesce(text_col, F.lit(""))

    def told(name: str, rx: str, canonical: Callable[[Column], Column]) -> Column:
        ids = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(rx), F.lit(0)), canonical))
        return F.transform(ids, lambda i: F.struct(i.alias("identifier"), F.lit(False).alias("late"), F.lit(name).alias("rule")))

    found = [told(name, *x) for name, x in (RULES if rules is None else rules).items()]
    for alias, identifier in sorted((aliases or {}).items()):
        if alias.strip():
            hit = text.rlike(rf"(?iU)(?<![\w])\Q{alias}\E(?![\w])")
            found.append(F.when(hit, F.array(F.struct(F.lit(identifier).alias("identifier"), F.lit(True).alias("late"), F.lit(ALIAS).alias("rule")))).otherwise(F.array().cast("array<struct<identifier:string,late:boolean,rule:string>>")))
    each = docs.select(id_col, F.explode(F.concat(*found)).alias("x")).where("x.identifier is not null")
    return each.groupBy(id_col, F.col("x.identifier").alias("identifier")).agg(F.min(F.struct("x.late", "x.rule")).alias("r")).select(id_col, "identifier", "r.rule")


def url_identifiers(urls: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """id, identifier: the identifiers that a URL carries word for word."""
    found = F.transform(F.regexp_extract_all(F.coalesce(url_col, F.lit("")), F.lit(URL_ANCHOR), F.lit(1)), lambda x: F.concat(F.lit("CELEX:"), F.upper(x)))
    return urls.select(id_col, F.explode(F.array_distinct(found)).alias("identifier"))


def resolution(urls: DataFrame, curated: DataFrame, known: DataFrame, id_col: str, url_col: str) -> tuple[DataFrame, DataFrame]:
    """(identifier, owner) and the curated rows whose owner isn't known. A curated identifier wins over one that a URL carries; an
    identifier in the URLs of several documents is nobody's."""
    own = url_identifiers(urls, id_col, url_col).groupBy("identifier").agg(F.min(id_col).alias("owner"), F.max(id_col).alias("_last")).where("owner = _last").drop("_last")
    good = curated.join(known.select(F.col(id_col).alias("owner")).distinct(), "owner", "left_semi").select("identifier", "owner")
    dangling = curated.join(known.select(F.col(id_col).alias("owner")).distinct(), "owner", "left_anti")
    return good.unionByName(own.join(good, "identifier", "left_anti")), dangling
