"""Filters and record mappings as column expressions; gates that need another table as anti-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Days for which a failed download is put off, the share of title words a page must have, and their least length.
DEFER_DAYS, TITLE_SHARE, TITLE_WORD = 7, 0.4, 4


def url_filtered(url: Column, domains: Sequence[str] = (), parts: Sequence[str] = ()) -> Column:
    """True where the host is one of the domains or below one, or the URL has one of the parts."""
    host = T.netloc(url)
    hit = F.lit(False)
    for d in domains:
        hit = hit | (host == d) | host.endswith(f".{d}")
    for p in parts:
        hit = hit | F.contains(url, F.lit(p))
    return F.coalesce(hit, F.lit(False))


def sanitize_url(url: Column) -> Column:
    """The trimmed URL without closing punctuation at its end; null unless it is http(s), has a dot in its host and 12 characters."""
    u = F.regexp_replace(T.ws_normalize(url), "[).,;»”’\"']+$", "")
    return F.when(u.rlike(r"^https?://") & F.contains(T.netloc(u), F.lit(".")) & (F.length(u) >= 12), u)


def excluded_status(status: Column, parts: Sequence[str]) -> Column:
    """True where a status has one of the parts, in either case; a null status is not excluded."""
    low, hit = F.lower(status), F.lit(False)
    for p in parts:
        hit = hit | F.contains(low, F.lit(p.lower()))
    return F.coalesce(hit, F.lit(False))


def in_scope(category: Column, kind: Column, include: Sequence[str], probe: str, kinds: Sequence[str]) -> Column:
    """True for an included category, and for the probed one if the kind is listed."""
    return F.coalesce(category.isin(*include), F.lit(False)) | F.coalesce((category == probe) & kind.isin(*kinds), F.lit(False))


def source_filter(df: DataFrame, id_col: str, track_col: str, allow: Sequence[str] = (), deny: Sequence[str] = (), tracks: Sequence[str] = ()) -> DataFrame:
    """Rows on the allow-list and tracks and off the deny-list; an empty list lets all through."""
    if allow:
        df = df.where(F.col(id_col).isin(*allow))
    if deny:
        df = df.where(~F.coalesce(F.col(id_col).isin(*deny), F.lit(False)))
    return df.where(F.col(track_col).isin(*tracks)) if tracks else df


def foreign_links(links: DataFrame, url: str, owners: DataFrame, owner_url: str) -> DataFrame:
    """Links whose normalized URL belongs to no row of owners."""
    own = owners.select(T.normalize_url(F.col(owner_url)).alias("__own")).where("__own is not null").distinct()
    return links.join(own, T.normalize_url(F.col(url)) == F.col("__own"), "left_anti")


def title_words(title: Column) -> Column:
    return F.filter(F.array_distinct(F.split(F.lower(F.coalesce(title, F.lit(""))), T.NOT_WORD)), lambda w: F.length(w) >= TITLE_WORD)


def title_matches(title: Column, page: Column) -> Column:
    """True where the page has max(1, 0.4 n rounded half to even) of the title's n distinct words of four letters or more."""
    own, low = title_words(title), F.lower(F.coalesce(page, F.lit("")))
    found = F.size(F.filter(own, lambda w: F.contains(low, w)))
    return found >= F.greatest(F.lit(1), F.bround(F.size(own) * TITLE_SHARE).cast("int"))


def verbatim(title: Column, section: Column) -> Column:
    """True where the title, in lower case and with white space run together, is part of the section."""
    flat = lambda c: F.lower(T.ws_normalize(c))
    return F.coalesce((flat(title) != "") & F.contains(flat(section), flat(title)), F.lit(False))


def deferred(failed: Column, today: Column, same_key: Column, force: bool = False) -> Column:
    """True for a failure of less than DEFER_DAYS days with an unchanged key, unless forced."""
    if force:
        return F.lit(False)
    return F.coalesce((F.datediff(today, failed) < DEFER_DAYS) & same_key, F.lit(False))


def dense_series(categories: Column, series: Column) -> Column:
    """True where every series is as long as the categories and has no null."""
    return F.forall(series, lambda s: (F.size(s) == F.size(categories)) & ~F.exists(s, F.isnull))


def dense_groups(points: DataFrame, chart: str, value: str, length: int) -> DataFrame:
    """chart, dense: like dense_series() of one series a chart, whose points are rows; counts are enough, so no point is gathered."""
    n = points.groupBy(chart).agg(F.count("*").alias("n"), F.count(value).alias("whole"))
    return n.select(chart, ((F.col("n") == length) & (F.col("whole") == length)).alias("dense"))


def flag_names(flags: Column, finding: Column | None = None) -> Column:
    """Names before the first colon, each once in order, then the finding; joined by semicolons, null if there is none."""
    names = F.transform(F.coalesce(flags, F.array().cast("array<string>")), lambda x: F.btrim(F.get(F.split(x, ":"), F.lit(0))))
    if finding is not None:
        names = F.concat(names, F.array_compact(F.array(finding)))
    return F.nullif(F.array_join(F.array_distinct(names), ";"), F.lit(""))


def embed_input(breadcrumb: Column, text: Column) -> Column:
    return F.when(F.coalesce(breadcrumb, F.lit("")) != "", F.concat(breadcrumb, F.lit("\n"), text)).otherwise(text)


def manual_hash(url: Column, title: Column, date: Column, supersedes: Column | None = None) -> Column:
    """Digest of a candidate entered by hand; what it supersedes is appended only where given."""
    parts = [F.coalesce(url, F.lit("")), F.coalesce(title, F.lit("")), F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit(""))]
    return F.sha2(F.concat_ws("|", *parts, *([] if supersedes is None else [supersedes])), 256)


def named_title(name: Column, title: Column) -> Column:
    return F.concat_ws(": ", F.nullif(name, F.lit("")), F.nullif(title, F.lit("")))


def dash_null(c: Column) -> Column:
    return F.nullif(F.btrim(c), F.lit("-"))


def snippet(text: Column, term: str, width: int = 80) -> Column:
    """The surroundings of the first place of a term, in either case, with white space run together; the start of a text without it."""
    flat = T.ws_normalize(F.coalesce(text, F.lit("")))
    at = F.instr(F.lower(flat), term.lower())
    start = F.greatest(F.lit(1), at - F.lit(width // 2))
    return F.concat(F.when(start > 1, "…").otherwise(""), F.substr(flat, start, F.lit(width)), F.when(F.length(flat) >= start + width, "…").otherwise(""))
