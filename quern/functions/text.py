"""Column functions on text and URLs. Character classes are written out, for \\w and \\s differ between regex dialects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = r"[^\p{L}\p{N}]+"
BLANK = r"[ \t\n\r\f\x0B]+"
#: Accented letters whose recall is measured in OCR scoring.
ACCENTED = "čćžšđ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body over a value that is computed once a row, wherever the optimizer moves what uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ws_normalize(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, BLANK, " "))


def normalized_title(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), NOT_WORD, "")


def tokens(c: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(c, F.lit(""))), NOT_WORD), "")


def token_set(c: Column) -> Column:
    return F.array_distinct(tokens(c))


def netloc(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def normalize_url(url: Column) -> Column:
    """https, lower-case host, no fragment, no trailing slash of the path; the query stays."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(netloc(url) == "", url).otherwise(F.concat(F.lit("https://"), netloc(url), F.regexp_replace(path, r"/+$", ""), query))


def format_hint(url: Column) -> Column:
    """The file format that a URL's path ends in; html otherwise."""
    ext = F.lower(F.regexp_extract(url, r"\.([A-Za-z0-9]{2,5})(?:[?#].*)?$", 1))
    return F.when(ext.isin("pdf", "docx", "xlsx", "pptx", "csv", "json", "xml", "txt"), ext).otherwise("html")


def safe_url(url: Column) -> Column:
    """True for http(s) URLs without credentials, white space or control characters."""
    return F.coalesce(url.rlike(r"^https?://[^\s/@\x00-\x1f]+(?:[/?#][^\s\x00-\x1f]*)?$"), F.lit(False))


def content_hash(text: Column, breadcrumb: Column | None = None) -> Column:
    return F.sha2(F.concat(F.lit("") if breadcrumb is None else breadcrumb, F.lit("\x00"), text), 256)


def normalize_line(c: Column) -> Column:
    """What stands before the first bar, digits made #."""
    return F.regexp_replace(F.btrim(F.get(F.split(c, r"\|"), F.lit(0))), r"[0-9]+", "#")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def token_recall(reference: Column, candidate: Column) -> Column:
    a, b = token_set(reference), token_set(candidate)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def numbers(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[0-9]+(?:[.,][0-9]+)*"), F.lit(0))


def cer_text(c: Column) -> Column:
    return ws_normalize(F.regexp_replace(c, "#", ""))


def cer(gold: Column, candidate: Column) -> Column:
    """Edit distance by gold's length; 0 or 1 where gold is empty."""
    g, x = cer_text(gold), cer_text(candidate)
    return F.when(F.length(g) == 0, F.when(F.length(x) == 0, 0.0).otherwise(1.0)).otherwise(F.levenshtein(g, x) / F.length(g))


def char_recall(gold: Column, candidate: Column, chars: str = ACCENTED) -> Column:
    """Multiset recall over some characters; 1 if gold has none."""
    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x)))
    have = sum((F.least(count(gold, x), count(candidate, x)) for x in chars), F.lit(0))
    want = sum((count(gold, x) for x in chars), F.lit(0))
    return F.when(want == 0, F.lit(1.0)).otherwise(have / want)


def upper_share(c: Column) -> Column:
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    return F.when(letters == 0, 0.0).otherwise(F.length(F.regexp_replace(c, r"[^\p{Lu}]", "")) / letters)
