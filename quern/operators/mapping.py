"""Record maps: rows of registries, JSON dumps and query results become candidates; candidates and decisions become records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# The longest summary, labels of act sectors and types, authorities by document type, and fields an admission needs.
SUMMARY = 600
SECTORS = {"3": "legal act", "4": "international agreement", "5": "preparatory act", "6": "case-law", "7": "national transposition"}
TYPES = {
    "R": "Regulation", "L": "Directive", "D": "Decision", "H": "Recommendation", "G": "Resolution/guideline", "M": "merger notification", "A": "opinion",
    "C": "communication/notice", "DC": "communication/notice", "PC": "proposal", "SC": "staff working document",
}
AUTHORITY = {
    "national_strategy": "soft_law", "framework": "soft_law", "guidance": "soft_law", "legislation": "binding_law", "regulation": "regulation", "technical_standard": "voluntary_standard",
    "technical_spec": "voluntary_standard", "report": "report", "academic_paper": "report",
}
NEEDED = ("title", "issuer", "language", "source_url")


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def filled(c: Column) -> Column:
    """The trimmed text; null where it is blank."""
    return F.nullif(F.btrim(c), F.lit(""))


def web_url(c: Column) -> Column:
    return F.when(c.rlike("^https?://"), c)


def printed(c: Column) -> Column:
    """A value as a row's digest writes it: null is the word None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[printed(p) for p in parts]), 256)


def doc_year(year: Column, date: Column) -> tuple[Column, Column]:
    """The year, taken from the date where there is none, and whether the two contradict one another."""
    return F.coalesce(year, F.year(date)), F.coalesce(year != F.year(date), F.lit(False))


def iso_date(c: Column) -> Column:
    """The date that a text begins with; null if it begins with none."""
    return F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def compact_date(c: Column) -> Column:
    return F.try_to_timestamp(F.substring(c, 1, 8), F.lit("yyyyMMdd")).cast("date")


def registry_row(rows: DataFrame, terms: Sequence[str] = ()) -> DataFrame:
    """Candidates of rows (native_id, official_name, casual_name, authority, jurisdiction, link, activity, activity_date, proposed_date,
    summary, machine, tags, probe, haystack). Rows without a web URL are left out; a summary that a machine wrote isn't kept."""
    tags = F.filter(F.transform(F.split(F.coalesce("tags", F.lit("")), ";"), lambda x: F.btrim(x)), lambda x: x != "")
    hits = [F.when(F.coalesce("haystack", F.lit("")).rlike(rf"(?i)\b\Q{t}\E\b"), t) for t in terms]
    matched = F.concat(F.lit("probe (matched: "), F.array_join(F.array_compact(F.array(*hits)), ", ") if hits else F.lit(""), F.lit(")"))
    extra = F.array_compact(F.array(F.when(filled(F.col("activity")).isNotNull(), F.concat(F.lit("activity: "), F.col("activity"))), F.when(F.col("probe"), matched)))
    return rows.where(web_url(F.col("link")).isNotNull()).select(
        F.col("native_id").cast("string").alias("native_id"), F.coalesce(filled(F.col("official_name")), F.col("casual_name")).alias("title"), F.col("authority").alias("issuer"),
        filled(F.col("jurisdiction")).alias("jurisdiction"), F.coalesce("activity_date", "proposed_date").alias("doc_date"), F.col("link").alias("source_url"),
        F.when(F.col("machine") == F.lit(False), F.substring(filled(F.col("summary")), 1, SUMMARY)).alias("native_summary"), F.concat(tags, extra).alias("native_tags"),
        digest(F.col("native_id"), F.col("official_name"), F.col("link"), F.col("activity_date")).alias("raw_hash"), T.format_hint(F.col("link")).alias("format_hint"),
    )


def ambiguous_sites(rows: DataFrame, site: str, title: Column) -> DataFrame:
    """The sites that rows with different normalized titles share."""
    own = rows.where(web_url(F.col(site)).isNotNull() & filled(title).isNotNull()).select(F.col(site).alias("site"), T.normalized_title(title).alias("t"))
    return own.groupBy("site").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").select("site")


def initiative_row(rows: DataFrame) -> DataFrame:
    """Candidates of initiatives as read from JSON (id, englishName, originalName, website, relevantUrls, gaiinCountry.name,
    intergovernmentalOrganisation.name, responsibleOrganisation, description, category, initiativeType.name, extentBinding, startYear,
    updatedAt). Only these are read: other fields of the dump are invented or personal. A URL that other titles share is suspect."""
    title = F.coalesce(filled(F.col("englishName")), filled(F.col("originalName")))
    shared = ambiguous_sites(rows, "website", title).withColumn("suspect", F.lit(True))
    url = F.coalesce(web_url(F.col("website")), web_url(F.get("relevantUrls", F.lit(0))))
    tag = lambda name, c: F.when(filled(c).isNotNull(), F.concat(F.lit(f"{name}: "), c))
    tags = F.array_compact(F.array(tag("category", F.col("category")), tag("type", F.col("initiativeType.name")), tag("binding", F.col("extentBinding"))))
    own = rows.join(shared, rows.website == F.col("site"), "left").where(title.isNotNull() & url.isNotNull() & F.col("id").isNotNull())
    return own.select(
        F.col("id").cast("string").alias("native_id"), title.alias("title"), filled(F.col("responsibleOrganisation")).alias("issuer"),
        F.coalesce("gaiinCountry.name", "intergovernmentalOrganisation.name").alias("jurisdiction"), F.nullif(F.col("startYear"), F.lit(0)).alias("doc_year"), url.alias("source_url"),
        F.substring(filled(F.col("description")), 1, SUMMARY).alias("native_summary"), tags.alias("native_tags"), F.when(F.col("suspect"), "suspect").otherwise("stated").alias("url_provenance"),
        digest(F.col("id"), F.coalesce(F.btrim("englishName"), F.lit("")), F.col("updatedAt")).alias("raw_hash"), T.format_hint(url).alias("format_hint"),
    )


def checked_pages(pages: DataFrame) -> DataFrame:
    """The rows of pages (page, last_page, total, data array). An error if there is none, or if pages or rows are missing."""
    n = pages.agg(F.count("*").alias("pages"), F.max("last_page").alias("last"), F.max("total").alias("total"), F.sum(F.size("data")).alias("rows")).first()
    if not n["pages"] or (n["last"] or 0) < 1 or (n["total"] or 0) <= 0:
        raise ValueError("the dump is empty")
    if n["pages"] != n["last"] or n["rows"] != n["total"]:
        raise ValueError(f"the dump has {n['pages']} of {n['last']} pages and {n['rows']} of {n['total']} rows")
    return pages.select(F.explode("data").alias("x")).select("x.*")


def bindings(results: DataFrame, json_col: str, names: Sequence[str]) -> DataFrame:
    """Rows of SPARQL results in JSON, one column a variable; null where a row doesn't bind it. Adds ordinal, the place in the results."""
    value = "struct<value:string>"
    schema = f"struct<results:struct<bindings:array<struct<{','.join(f'{n}:{value}' for n in names)}>>>>"
    # the outer form, for of the inner one Spark makes a filter that parses each text again
    each = results.select(F.posexplode_outer(F.from_json(json_col, schema)["results"]["bindings"]).alias("ordinal", "x")).where("ordinal is not null")
    return each.select("ordinal", *[F.col(f"x.{n}.value").alias(n) for n in names])


def group_acts(rows: DataFrame, order: str = "ordinal") -> DataFrame:
    """celex, date, title, authors, concepts: the first date and title there are, authors in order of appearance, concepts as a set. Rows of an
    act are its authors times its concepts, so the arrays are small. As windows: arrays as aggregates would be sorted and written twice."""
    each = Window.partitionBy("celex").orderBy(order, "author")
    act = each.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = lambda c: F.first(F.when(F.col(order).isNotNull(), F.col(c)), ignorenulls=True).over(act)
    authors = F.collect_list(F.when(filled(F.col("author")).isNotNull(), F.col("author"))).over(act)
    groups = rows.where(filled(F.col("celex")).isNotNull()).select(
        "celex", first("date").alias("date"), first("title").alias("title"), authors.alias("a"), F.collect_set("concept").over(act).alias("c"), F.row_number().over(each).alias("_k")
    )
    return groups.where("_k = 1").select("celex", "date", "title", F.array_distinct("a").alias("authors"), F.sort_array("c").alias("concepts"))


def act_type(celex: Column) -> Column:
    """What an identifier says about its act; what isn't known stays as it is."""
    code = F.regexp_extract(celex, r"^\d\d{4}([A-Z]{1,2})\d", 1)
    sector = F.coalesce(_map(SECTORS)[F.substring(celex, 1, 1)], F.lit("other"))
    return F.concat(F.lit("EUR-Lex: "), sector, F.lit(", "), F.coalesce(_map(TYPES)[code], F.nullif(code, F.lit("")), F.lit("unknown")))


def act_row(groups: DataFrame, language: str = "en") -> DataFrame:
    """Candidates of group_acts(); acts without a title are left out."""
    issuer = F.nullif(F.array_join(F.array_sort("authors"), " / "), F.lit(""))
    concepts = F.transform("concepts", lambda c: F.element_at(F.split(c, "/"), -1))
    tags = F.array_compact(F.array(act_type(F.col("celex")), F.when(F.size("concepts") > 0, F.concat(F.lit("concepts: "), F.array_join(F.array_sort(concepts), ", ")))))
    return groups.where(filled(F.col("title")).isNotNull()).select(
        F.col("celex").alias("native_id"), "title", issuer.alias("issuer"), iso_date(F.col("date")).alias("doc_date"), F.lit(language).alias("language"),
        F.concat(F.lit(f"https://eur-lex.europa.eu/legal-content/{language.upper()}/TXT/HTML/?uri=CELEX:"), F.col("celex")).alias("source_url"), tags.alias("native_tags"),
        digest(F.col("celex"), iso_date(F.col("date")), F.col("title"), F.coalesce(issuer, F.lit(""))).alias("raw_hash"),
    )


def vocabulary_tags(text: Column, terms: dict[str, str]) -> Column:
    """The keys whose spaced form is in the text, in either case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(spaced)), key) for key, spaced in terms.items() if spaced]))


def link_row(links: DataFrame, terms: dict[str, str] | None = None) -> DataFrame:
    """Candidates of links (source_id, url, anchor, kind pdf, html, md or citation; page): the title is the anchor, unless it is a URL itself,
    else the last part of the path, else the host. Only a citation's title is stated, others are derived."""
    anchor, stated = F.btrim(F.coalesce("anchor", F.lit(""))), F.col("kind") == "citation"
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    last = F.regexp_extract(F.regexp_replace(path, "/+$", ""), "([^/]*)$", 1)
    usable = F.when(~stated & F.lower(anchor).rlike("^https?://"), "").otherwise(anchor)
    title = F.coalesce(F.nullif(usable, F.lit("")), F.nullif(last, F.lit("")), T.netloc(F.col("url")))
    place = F.when((F.col("kind") == "pdf") & F.col("page").isNotNull(), F.concat(F.lit("#p"), F.col("page").cast("string"))).otherwise(F.concat(F.lit("#"), F.col("kind")))
    return links.select(
        F.concat(F.col("source_id").cast("string"), place).alias("native_id"), title.alias("title"), F.when(stated, "stated").otherwise("derived").alias("title_provenance"), F.col("url").alias("source_url"),
        F.substring(F.nullif(anchor, F.lit("")), 1, SUMMARY).alias("native_summary"), F.sha2(F.concat(F.lit("snowball|"), T.normalize_url(F.col("url"))), 256).alias("raw_hash"), vocabulary_tags(anchor, terms or {}).alias("matched_tags"),
    )


def track(jurisdiction: Column, issuer_type: Column, targets: Sequence[str]) -> Column:
    return F.when(F.coalesce(jurisdiction.isin(*targets), F.lit(False)), "target-entity").when(issuer_type.isin("think_tank", "academia"), "research-papers").otherwise("intl-xperience")


def authority(doc_type: Column) -> Column:
    """The authority that a document type mostly has; null for a type that isn't known."""
    return _map(AUTHORITY)[doc_type]


def promote(candidates: DataFrame, decisions: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Admitted candidates as records: a decision's field lies over the candidate's, and what the candidate supersedes becomes a relation,
    unless the decision has it already. decisions: the key, fields, relations array<struct<type,target>>."""
    c, d = candidates.alias("c"), decisions.alias("d")
    edge = F.struct(F.lit("supersedes").alias("type"), F.col("c.supersedes").alias("target"))
    own = F.coalesce("d.relations", F.array().cast("array<struct<type:string,target:string>>"))
    relations = F.when(F.col("c.supersedes").isNotNull() & ~F.array_contains(own, edge), F.concat(own, F.array(edge))).otherwise(own)
    return c.join(d, F.col(f"c.{key}") == F.col(f"d.{key}")).select(F.col(f"c.{key}").alias(key), *[F.coalesce(f"d.{f}", f"c.{f}").alias(f) for f in fields], relations.alias("relations"))


def missing_fields(title_provenance: Column, url_provenance: Column, fields: Sequence[str] = NEEDED) -> Column:
    """The fields that a decision has to give: those that are null, a derived title, a suspect URL."""
    unusable = {"title": F.coalesce(title_provenance == "derived", F.lit(False)), "source_url": F.coalesce(url_provenance == "suspect", F.lit(False))}
    return F.array_compact(F.array(*[F.when(F.col(f).isNull() | unusable.get(f, F.lit(False)), f) for f in fields]))


def provenance_note(fidelity: Column, flags: Column) -> Column:
    """archived_snapshot before the quality flags; null if there is nothing to say."""
    return F.nullif(F.concat_ws(";", F.when(fidelity == "archived_snapshot", fidelity), F.nullif(flags, F.lit(""))), F.lit(""))


def ordered_union(parts: Sequence[DataFrame], order: str) -> DataFrame:
    """The rows of all parts, those of a part after those of the ones before it; ordinal says which comes first."""
    own = [p.withColumns({"_part": F.lit(i), "_order": F.col(order)}) for i, p in enumerate(parts)]
    union = own[0]
    for p in own[1:]:
        union = union.unionByName(p)
    return union.withColumn("ordinal", F.struct("_part", "_order")).drop("_part", "_order")


def fresh(union: DataFrame, key: Column) -> DataFrame:
    """Whether each row is the first of its key; rows without a key are."""
    own = union.withColumn("_key", key)
    least = own.where("_key is not null").groupBy("_key").agg(F.min("ordinal").alias("_first"))
    return own.join(least, "_key", "left").withColumn("fresh", F.col("_key").isNull() | (F.col("_first") == F.col("ordinal"))).drop("_key", "_first")


def diagnostics(rows: DataFrame, connector: str) -> DataFrame:
    """connector, found, fresh, merged."""
    return rows.groupBy(connector).agg(F.count("*").alias("found"), F.count_if("fresh").alias("fresh"), F.count_if(~F.col("fresh")).alias("merged"))


def latest(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def caption_texts(texts: Column) -> Column:
    """Trimmed texts without blanks and bare numbers, each once, in order."""
    return F.array_distinct(F.filter(F.transform(texts, lambda x: F.btrim(x)), lambda x: (x != "") & ~x.rlike(r"^-?\d+$")))


def dense(points: Column, n: Column) -> Column:
    """A map of places to values as an array of length n, null where there is a gap."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.try_element_at(points, i))).otherwise(F.array())


def cell_name(column: Column, row: Column) -> Column:
    """The name of a cell from its column and row, both from 0, for up to 702 columns."""
    letter = lambda k: F.chr(F.lit(65) + k)
    return F.concat(F.when(column >= 26, letter(F.floor(column / 26) - 1)).otherwise(""), letter(column % 26), (row + 1).cast("string"))


def act_query(concepts: Sequence[str], language: str, label: str, limit: int) -> str:
    """The SPARQL query for acts about any of the concepts, newest first; an error without concepts."""
    if not concepts:
        raise ValueError("no concepts to look for")
    lines = [
        "PREFIX cdm: <http://publications.europa.eu/ontology/cdm#>", "PREFIX skos: <http://www.w3.org/2004/02/skos/core#>", "SELECT ?celex ?date ?title ?author ?concept WHERE {",
        f"  VALUES ?concept {{ {' '.join(f'<{c}>' for c in concepts)} }}", "  ?work cdm:work_is_about_concept_eurovoc ?concept ; cdm:resource_legal_id_celex ?celex .", "  OPTIONAL { ?work cdm:work_date_document ?date . }",
        f"  OPTIONAL {{ ?text cdm:expression_belongs_to_work ?work ; cdm:expression_uses_language <{language}> ; cdm:expression_title ?title . }}",
        f'  OPTIONAL {{ ?work cdm:work_created_by_agent ?agent . ?agent skos:prefLabel ?author . FILTER(LANG(?author) = "{label}") }}', f"}} ORDER BY DESC(?date) LIMIT {limit}",
    ]
    return "\n".join(lines)
