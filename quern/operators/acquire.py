"""Acquisition and rechecks: what a response is, which rung of the ladder comes next, what a recheck finds, and which stages a document needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Statuses of a dead URL, signs of a challenge page, magic numbers, least sizes, confirmations that make a validator stable.
DEAD = (404, 410)
CHALLENGES = ("Attention Required", "cf-chl", "Just a moment", "cf_captcha", "turnstile", "Request Rejected", "Unauthorized Access", "errors.edgesuite.net")
WAF_ACTIONS = ("challenge", "captcha")
PDF, ZIP = "%PDF", "PK\x03\x04"
LEAST = {"pdf": 2048, "html": 1024, "docx": 4096, "xlsx": 4096}
STABLE_CONFIRMS = 2
RUNGS = ("direct", "official_alt", "archive", "manual")


def last_hop(headers: Column) -> Column:
    """The header block of the last response of a chain of redirects."""
    return F.regexp_extract(F.coalesce(headers, F.lit("")), r"(?is)^(?:.*[\r\n])?(HTTP/.*)$", 1)


def status_of(headers: Column) -> Column:
    return F.nullif(F.regexp_extract(last_hop(headers), r"(?i)^HTTP/\S*\s+(\d+)", 1), F.lit("")).cast("int")


def header(headers: Column, name: str) -> Column:
    """A header of the last hop, the last one if it is repeated; null without it."""
    return F.btrim(F.try_element_at(F.regexp_extract_all(last_hop(headers), F.lit(rf"(?im)^[ \t]*{name}[ \t]*:([^\r\n]*)"), F.lit(1)), F.lit(-1)))


def challenged(body: Column, headers: Column) -> Column:
    hit = header(headers, "cf-ray").isNotNull() | F.coalesce(F.contains(header(headers, "set-cookie"), F.lit("__cf_bm")), F.lit(False))
    hit |= F.coalesce(F.lower(header(headers, "x-amzn-waf-action")).isin(*WAF_ACTIONS), F.lit(False))
    for mark in CHALLENGES:
        hit |= F.contains(body, F.lit(mark))
    return hit


def _verdict(outcome: str, reason: str) -> Column:
    return F.struct(F.lit(outcome).alias("outcome"), F.lit(reason).alias("reason"))


def classify(body: Column, headers: Column, expected: Column) -> Column:
    """Struct (outcome ok, blocked or dead; reason) of a response whose format is known. body is text, or bytes read as Latin-1. A PDF is known
    by its first bytes even in a challenge's company; for the other formats a challenge is looked for first."""
    body = F.coalesce(body, F.lit(""))
    status, size = status_of(headers), F.octet_length(body)
    wall, html = challenged(body, headers), F.contains(F.coalesce(header(headers, "content-type"), F.lit("")), F.lit("text/html"))
    least = F.create_map(*[F.lit(v) for kv in LEAST.items() for v in kv])[expected]
    other = F.when(html & (expected != "html"), _verdict("blocked", "html instead")).otherwise(_verdict("blocked", "unexpected"))
    office = (status == 200) & body.startswith(ZIP) & (size >= least)
    return (
        F.when(status.isin(*DEAD), _verdict("dead", "status"))
        .when((expected == "pdf") & body.startswith(PDF), _verdict("ok", "valid"))
        .when(wall, _verdict("blocked", "challenge"))
        .when(expected == "pdf", F.when(html, _verdict("blocked", "html instead")).when(size < least, _verdict("blocked", "too small")).otherwise(other))
        .when(expected == "html", F.when(body.startswith(PDF), _verdict("blocked", "pdf instead")).when((status == 200) & html & (size >= least), _verdict("ok", "valid")).otherwise(other))
        .when(expected.isin("docx", "xlsx") & office, _verdict("ok", "valid"))
        .otherwise(other)
    )


def classify_probe(body: Column, headers: Column) -> Column:
    """Like classify(), of whatever format: is the channel open?"""
    body = F.coalesce(body, F.lit(""))
    status = status_of(headers)
    open_ = status.isin(200, 206) & (F.octet_length(body) > 0)
    return (
        F.when(challenged(body, headers), _verdict("blocked", "challenge")).when(status.isin(*DEAD), _verdict("dead", "status"))
        .when(open_, _verdict("ok", "valid")).otherwise(_verdict("blocked", "unexpected"))
    )


def next_rung(outcome: Column, rung: Column, has_alt: Column, sensitivity: Column) -> Column:
    """The rung after an attempt; null after a success. What is confidential never goes to an archive."""
    secret = F.coalesce(sensitivity, F.lit("normal")) == "confidential"
    return (
        F.when(outcome == "ok", F.lit(None).cast("string")).when(outcome == "dead", F.when(secret, "manual").otherwise("archive"))
        .when((rung == "direct") & has_alt, "official_alt").otherwise("manual")
    )


def disclosable(sensitivity: Column) -> Column:
    return F.coalesce(sensitivity, F.lit("normal")) != "confidential"


def recheck(state: dict[str, Column], probe: dict[str, Column], fmt: Column, deep: bool = False) -> Column:
    """Struct (finding, etag, last_modified, confirms, note) after a probe. state: finding, etag, last_modified, confirms, fidelity and, for
    deep, baseline; probe: not_modified, outcome, reason, etag, last_modified and, for deep, digest. A clean result takes no finding back."""

    def out(note: Column | str, finding: Column | None = None, fresh: bool = False, confirms: Column | None = None) -> Column:
        own = probe if fresh else state
        return F.struct(
            (state["finding"] if finding is None else finding).alias("finding"), own["etag"].alias("etag"), own["last_modified"].alias("last_modified"),
            (state["confirms"] if confirms is None else confirms).cast("int").alias("confirms"), (F.lit(note) if isinstance(note, str) else note).alias("note"),
        )

    archived = F.coalesce(state["fidelity"] == "archived_snapshot", F.lit(False))
    before = (
        F.when(probe["not_modified"], out("not modified", confirms=state["confirms"] + 1))
        .when((probe["outcome"] == "dead") & archived, out("dead as expected")).when(probe["outcome"] == "dead", out("link rot", F.concat(F.lit("link-rot: "), probe["reason"])))
        .when(probe["outcome"] == "blocked", out("unverifiable")).when(archived, out("resurrected", F.concat(F.lit("resurrected: "), probe["reason"])))
    )
    if deep:
        base, digest = state["baseline"], probe["digest"]
        moved = F.concat(F.lit("drift: digest "), F.substring(base, 1, 12), F.lit(" -> "), F.coalesce(F.substring(digest, 1, 12), F.lit("empty")))
        return before.when(base.isNull(), out("unverifiable")).when(base.eqNullSafe(digest), out("digest confirmed")).otherwise(out("digest changed", moved))
    by_etag = state["etag"].isNotNull()
    stored = F.when(by_etag, state["etag"]).otherwise(state["last_modified"])
    seen = F.when(by_etag, probe["etag"]).otherwise(probe["last_modified"])
    drift = F.concat(F.lit("drift: "), F.when(by_etag, "ETag ").otherwise("Last-Modified "), stored, F.lit(" -> "), seen)
    none = F.lit(0)
    return (
        before.when(stored.isNull() & probe["etag"].isNull() & probe["last_modified"].isNull(), out("no validators")).when(stored.isNull(), out("validators taken", fresh=True, confirms=none))
        .when(seen.isNull(), out("validator vanished")).when(seen == stored, out("validator confirmed", confirms=state["confirms"] + 1))
        .when((fmt == "html") & (state["confirms"] < STABLE_CONFIRMS), out("validator unstable", fresh=True, confirms=none)).otherwise(out("validator changed", drift, fresh=True, confirms=none))
    )


def stages(force: Column, has_raw: Column, deferred: Column, raw_changed: Column, has_md: Column, convert_deferred: Column, has_markers: Column, front_stale: Column) -> Column:
    """The stages a document needs, in order. What a stage makes stale is made anew by the ones after it."""
    download = (force | ~has_raw) & ~deferred
    convert = (download | force | raw_changed | ~has_md) & ~convert_deferred & (has_raw | download)
    parts = [F.when(download, "download"), F.when(convert, "convert"), F.when((has_md | convert) & has_markers, "figures"), F.when((has_md | convert) & (front_stale | convert), "frontmatter")]
    return F.array_compact(F.array(*parts))


def pending(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates that are neither rejected nor admitted as a record that exists."""
    live = records.select(F.col("id").alias("admitted_as")).distinct()
    return candidates.where("rejected_reason is null").join(live, "admitted_as", "left_anti").select(*candidates.columns)


def unacquirable(candidates: DataFrame, records: DataFrame, limit: int | None = None) -> DataFrame:
    """Candidates that were rejected as unacquirable and not admitted since, those checked longest ago first."""
    live = records.select(F.col("id").alias("admitted_as")).distinct()
    left = candidates.where("rejected_kind = 'unacquirable'").join(live, "admitted_as", "left_anti").select(*candidates.columns)
    left = left.orderBy(F.col("probe_checked").asc_nulls_first(), "raw_hash")
    return left if limit is None else left.limit(limit)


def due(records: DataFrame, checked: str, id_col: str, population: Column, limit: int) -> DataFrame:
    """The limit rows of each population that were checked longest ago, never checked ones first; adds population."""
    w = Window.partitionBy("population").orderBy(F.col(checked).asc_nulls_first(), id_col)
    return records.withColumn("population", population).where("population is not null").withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= limit).drop("_k")


def snapshot(cdx: DataFrame, mimetype: str, last: int = 5) -> DataFrame:
    """url, timestamp: of the last captures of each URL the newest with status 200 and the type."""
    w = Window.partitionBy("url").orderBy(F.desc("timestamp"))
    recent = cdx.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= last)
    return recent.where((F.col("status") == 200) & (F.col("mimetype") == mimetype)).groupBy("url").agg(F.max("timestamp").alias("timestamp"))


def by_prefix(candidates: DataFrame, prefix: str, least: int = 12) -> DataFrame:
    """The one candidate whose hash begins with the prefix; an error if the prefix is short, or none or several match."""
    if len(prefix) < least:
        raise ValueError(f"a prefix has {least} characters or more")
    found = candidates.where(F.col("raw_hash").startswith(prefix))
    if (n := found.limit(2).count()) != 1:
        raise LookupError(f"{'no candidate' if not n else 'several candidates'} for {prefix}")
    return found


def status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.groupBy(status).agg(F.count("*").alias("n"))
