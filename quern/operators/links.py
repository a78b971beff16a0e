"""Links in HTML, printed URLs, and link candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

HREF = r'<a href="([^"#][^"]*)"[^>]*>([^<]*)</a>'
PRINTED = r"https?://[^ \t\n\r<>\"')]+[A-Za-z0-9/]"


def html_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """id, pos, href, target, anchor: links in page order, fragments left out; targets that start with / are put on the page's host."""
    html = F.coalesce(html_col, F.lit(""))
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(HREF), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(HREF), F.lit(2)).alias("anchor"))
    each = pages.select(id_col, url_col, F.posexplode(both).alias("pos", "x"))
    host = F.regexp_extract(url_col, r"^([A-Za-z]+://[^/?#]*)", 1)
    target = F.when(F.col("x.href").startswith("/"), F.concat(host, F.col("x.href"))).otherwise(F.col("x.href"))
    return each.select(id_col, "pos", F.col("x.href").alias("href"), target.alias("target"), T.ws_normalize(F.col("x.anchor")).alias("anchor"))


def printed_urls(lines: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, url, context: URLs in the text of lines."""
    return lines.select(id_col, F.explode(F.regexp_extract_all("line", F.lit(PRINTED), F.lit(0))).alias("url"), F.col("line").alias("context"))


def annotation_links(annotations: DataFrame, words: DataFrame, page: list[str], url: str = "uri") -> DataFrame:
    """page, url, anchor: the link annotations of a page by URL, and the words in their boxes in reading order. A page bounds both."""
    from .gates import sanitize_url
    from .layout import centre_in

    c = F.col
    own = annotations.withColumn("url", sanitize_url(c(url))).where("url is not null").select(*page, "url", *[c(x).alias(f"_{x}") for x in ("x0", "top", "x1", "bottom")])
    inside = centre_in(c("x0"), c("top"), c("x1"), c("bottom"), {x: c(f"_{x}") for x in ("x0", "top", "x1", "bottom")})
    told = own.join(words, page).where(inside).groupBy(*page, "url").agg(F.sort_array(F.collect_set(F.struct("_top", "_x0", "top", "x0", "text"))).alias("w"))
    anchor = F.coalesce(F.array_join(F.transform("w", lambda x: x["text"]), " "), F.lit(""))
    return own.select(*page, "url").distinct().join(told, [*page, "url"], "left").select(*page, "url", anchor.alias("anchor"))
