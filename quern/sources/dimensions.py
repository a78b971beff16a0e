"""Small sources: vocabularies, blocs, identifiers, bodies, evaluation queries and operational state as tables; versions, members and caches of
dumps. What a missing file means is said at each."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship

STATE = "doc_id string, sha256 string, etag string, http_last_modified string, fidelity string, acquisition_method string, recheck_finding string, etag_confirms int"
CANDIDATE = "title string, issuer string, jurisdiction string, doc_date string, language string, source_url string, native_id string, connector_id string, raw_hash string, supersedes string, admitted_as string, rejected_reason string, rejected_kind string, shard string, pos int"


def _files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content")


def yaml_rows(spark: SparkSession, root: str, pattern: str, rows: Callable[[str, object], Iterator[dict]], schema: str) -> DataFrame:
    """What rows() makes of the content of each YAML file below root whose name fits the pattern."""
    ship(spark)
    names = [c.strip().split()[0] for c in schema.replace("array<string>", "array_string").split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for b in batches:
            found = [r for path, content in zip(b["path"], b["content"], strict=True) for r in rows(path, yaml.safe_load(content))]
            yield pd.DataFrame([[r.get(n) for n in names] for r in found], columns=names)

    return _files(spark, root, pattern).mapInPandas(run, schema)


def vocabulary(spark: SparkSession, root: str, name: str) -> DataFrame:
    """term, spaced: the keys under terms of vocab_<name>.yaml, and with spaces for hyphens; a file without terms is an error."""

    def rows(path: str, data: object) -> Iterator[dict]:
        if not isinstance(data, dict) or not isinstance(data.get("terms"), dict):
            raise ValueError(f"{path}: no terms")
        yield from ({"term": str(t), "spaced": str(t).replace("-", " ")} for t in data["terms"])

    return yaml_rows(spark, root, f"vocab_{name}.yaml", rows, "term string, spaced string")


def blocs(spark: SparkSession, root: str, pattern: str = "jurisdictions.yaml") -> DataFrame:
    """bloc, label, iso2: a row a member, in lower case; what is no bloc is left out."""

    def rows(path: str, data: object) -> Iterator[dict]:
        for bloc, x in (data.items() if isinstance(data, dict) else ()):
            if isinstance(x, dict) and isinstance(x.get("members"), list):
                yield from ({"bloc": str(bloc), "label": str(x.get("label", bloc)), "iso2": str(m).lower()} for m in x["members"])

    return yaml_rows(spark, root, pattern, rows, "bloc string, label string, iso2 string")


def section(spark: SparkSession, root: str, pattern: str, name: str) -> DataFrame:
    """key, value of one section of a file of mappings, as identifiers and aliases; nothing without the file or the section."""

    def rows(path: str, data: object) -> Iterator[dict]:
        part = data.get(name) if isinstance(data, dict) else None
        yield from ({"key": str(k), "value": str(v)} for k, v in (part.items() if isinstance(part, dict) else ()))

    return yaml_rows(spark, root, pattern, rows, "key string, value string")


def bodies(spark: SparkSession, root: str, pattern: str = "standards_bodies.yaml") -> DataFrame:
    """entity_id, kind, full_name."""
    rows = lambda path, data: ({"entity_id": str(k), "kind": v.get("kind"), "full_name": v.get("full_name")} for k, v in (data or {}).items())
    return yaml_rows(spark, root, pattern, rows, "entity_id string, kind string, full_name string")


def targets(spark: SparkSession, root: str, pattern: str = "target_entities.yaml") -> list[str]:
    """The jurisdictions of the target track: a short list, read on the driver."""
    rows = lambda path, data: ({"jurisdiction": str(x)} for x in data["jurisdictions"])
    return [r["jurisdiction"] for r in yaml_rows(spark, root, pattern, rows, "jurisdiction string").collect()]


def eval_queries(spark: SparkSession, root: str, pattern: str = "eval_queries.yaml") -> DataFrame:
    """query, expect, lang (en unless said); an empty file or a query without a text or expectations is an error."""

    def rows(path: str, data: object) -> Iterator[dict]:
        found = data.get("queries") if isinstance(data, dict) else None
        if not found:
            raise ValueError(f"{path}: no queries")
        for q in found:
            if not q.get("query") or not q.get("expect"):
                raise ValueError(f"{path}: a query lacks a field")
            yield {"query": q["query"], "expect": [str(x) for x in q["expect"]], "lang": q.get("lang", "en")}

    return yaml_rows(spark, root, pattern, rows, "query string, expect array<string>, lang string")


def candidate_shards(spark: SparkSession, root: str, monolith: str = "candidates.yaml") -> DataFrame:
    """Candidates of all shards in a folder, with shard and pos, which order them. A monolith from before there were shards, if there is one,
    is the only source."""
    names = [c.strip().split()[0] for c in CANDIDATE.split(",")]

    def rows(path: str, data: object) -> Iterator[dict]:
        for i, x in enumerate(data or []):
            yield {n: None if x.get(n) is None else str(x[n]) for n in names[:-2]} | {"shard": path.rsplit("/", 1)[-1], "pos": i}

    old = yaml_rows(spark, root, monolith, rows, CANDIDATE)
    return old if not _files(spark, root, monolith).select("path").isEmpty() else yaml_rows(spark, root, "*.yaml", rows, CANDIDATE)


def states(spark: SparkSession, root: str, records: DataFrame, pattern: str = "*.state.yaml") -> DataFrame:
    """A state for every record (id): that of its file <id>.state.yaml, else the default, which an empty file means too."""
    names = [c.strip().split()[0] for c in STATE.split(",")]

    def rows(path: str, data: object) -> Iterator[dict]:
        yield {n: (data or {}).get(n) for n in names[1:]} | {"doc_id": path.rsplit("/", 1)[-1].removesuffix(".state.yaml")}

    kept = yaml_rows(spark, root, pattern, rows, STATE)
    return records.select(F.col("id").alias("doc_id")).join(kept, "doc_id", "left").withColumn("etag_confirms", F.coalesce("etag_confirms", F.lit(0)))


def without_front_matter(text: Column) -> Column:
    """A text without the block between two rules that it begins with."""
    return F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n", "")


def raw_files(listing: DataFrame) -> DataFrame:
    """folder, path, n of files named raw.*: one a folder; with more, path is null and n says so."""
    own = listing.where(F.col("path").rlike(r"/raw\.[^/]+$")).withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    return own.groupBy("folder").agg(F.count("*").alias("n"), F.max("path").alias("_p")).select("folder", F.when(F.col("n") == 1, F.col("_p")).alias("path"), "n")


def bronze(rows: DataFrame, version: str, day: Column | None = None) -> DataFrame:
    """Rows of a registry with the version of their source and the day of the load."""
    return rows.withColumns({"_source_version": F.lit(version), "_loaded": F.current_date() if day is None else day})


def has_version(table: DataFrame | None, version: str) -> bool:
    """Whether a table, if there is one, holds rows of the version."""
    return table is not None and "_source_version" in table.columns and not table.where(F.col("_source_version") == version).limit(1).isEmpty()


def zip_members(spark: SparkSession, path: str, members: Sequence[str]) -> DataFrame:
    """member, text: the members of an archive whose names end so; a missing one, or one too large, is an error."""
    from ..operators.convert import guard

    ship(spark)
    wanted = list(members)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    guard(z)
                    for m in wanted:
                        name = next((n for n in z.namelist() if n.endswith(m)), None)
                        if name is None:
                            raise ValueError(f"the archive has no {m}")
                        yield pd.DataFrame([(m, z.read(name).decode("utf-8-sig"))], columns=["member", "text"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "member string, text string")


def csv_rows(members: DataFrame, member: str, schema: str) -> DataFrame:
    """The rows of one CSV member, by its header; quoted fields may hold line breaks."""
    ship(members.sparkSession)
    names = [c.strip().split()[0].strip("`") for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv

        for b in batches:
            for text in b["text"]:
                rows = csv.DictReader(io.StringIO(text, newline=""))
                yield pd.DataFrame([[r.get(n) or None for n in names] for r in rows], columns=names)

    return members.where(F.col("member") == member).select("text").mapInPandas(run, schema)


def archive_version(metadata: Column) -> Column:
    """Struct (version, url) of a repository's JSON metadata."""
    first = F.get_json_object(metadata, "$.files[0].links.self")
    return F.struct(F.coalesce(F.get_json_object(metadata, "$.metadata.version"), F.get_json_object(metadata, "$.id")).alias("version"), first.alias("url"))


def read_meta(meta: DataFrame, key: str) -> str | None:
    """A value of a key-value table, None without it."""
    row = meta.where(F.col("key") == key).select("value").first()
    return None if row is None else row["value"]


def cached_links(docs: DataFrame, cache: DataFrame, signature: str) -> DataFrame:
    """docs (doc_id, raw_sha, doc_sha) with fingerprint and hit: whether the cache (doc_id, fingerprint, signature) has links of these very texts."""
    own = docs.withColumn("fingerprint", F.sha2(F.concat("raw_sha", "doc_sha"), 256))
    kept = cache.where(F.col("signature") == signature).select("doc_id", "fingerprint").distinct().withColumn("hit", F.lit(True))
    return own.join(kept, ["doc_id", "fingerprint"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
