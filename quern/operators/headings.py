"""Headings: found in flat text by three tiers, demoted where a machine wrote them, and the sections that headings open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import lines

# Words that open a heading of the first and second level, longest headings, share of capitals, headings of citations.
FIRST = ("ANNEX", "CHAPTER", "TITLE", "PART", "GLAVA", "PRILOG")
SECOND = ("SECTION", "ARTICLE", "APPENDIX", "CLAN", "ČLAN", "ODJELJAK", "DIO")
LONGEST, LONGEST_CAPS, CAPS = 80, 100, 0.7
CITATIONS = ("references", "bibliography", "sources", "endnotes", "notes", "reference list", "further resources", "further reading", "литература", "извори")


def _letters(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}]", "")


def _unglued(c: Column) -> Column:
    """Puts back the space between a word and its number, and closes the one within the number."""
    rx = r"^(\p{L}+)(\d{1,3})(?:\s+(\d))?\s*(.*)$"
    part = lambda k: F.regexp_extract(c, rx, k)
    return F.when(c.rlike(rx), F.rtrim(F.concat(part(1), F.lit(" "), part(2), part(3), F.lit(" "), part(4)))).otherwise(c)


def by_word(c: Column) -> Column:
    """A short line that begins with a heading's word and doesn't end like a sentence."""
    word = F.upper(F.regexp_extract(c, r"^(\p{L}+)", 1))
    fits = (F.length(c) < LONGEST) & ~c.rlike(r"[.;]$")
    return F.when(fits & word.isin(*FIRST), F.concat(F.lit("# "), _unglued(c))).when(fits & word.isin(*SECOND), F.concat(F.lit("## "), _unglued(c)))


def by_capitals(c: Column, following: Column) -> Column:
    """A line of two words or more in capitals with text after it; one of its words must be more than an acronym or a Roman number."""
    letters, words = _letters(c), F.split(c, r"\s+")
    share = F.length(F.regexp_replace(letters, r"[^\p{Lu}]", "")) / F.length(letters)
    real = F.exists(words, lambda w: (F.length(_letters(w)) >= 4) & ~_letters(w).rlike("^[IVXLCDM]+$"))
    fits = (F.length(c) <= LONGEST_CAPS) & (F.length(following) > 0) & ~c.rlike(r"[.,;:]$") & (F.length(letters) >= 2)
    return F.when(fits & (F.size(words) >= 2) & real, F.when(share >= CAPS, F.concat(F.lit("## "), c)))


def by_number(c: Column, following: Column) -> Column:
    """A number of one or two parts, and a short title with a capital that doesn't end like a sentence."""
    rx = r"^\d+(\.\d+)?\.?\s+(.+)$"
    fits = (F.length(c) < LONGEST) & ~c.endswith(".") & (F.length(following) > 0) & F.regexp_extract(c, rx, 2).rlike(r"^\p{Lu}")
    return F.when(fits, F.concat(F.when(F.regexp_extract(c, rx, 1) != "", "### ").otherwise("## "), c))


def promoted(ls: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The lines with headings of all tiers; existing marks are taken off and judged anew."""
    own = lines.next_nonblank(ls, id_col)
    bare = F.regexp_replace(F.btrim("line"), r"^#{1,6}\s+", "")
    following = F.btrim(F.coalesce("next_line", F.lit("")))
    made = F.coalesce(by_word(bare), by_capitals(bare, following), by_number(bare, following), bare)
    return own.withColumn("line", F.when(bare == "", F.col("line")).otherwise(made)).drop("next_line")


def merged(ls: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The lines with headings added that the first two tiers find; headings there are, tables, quotes and fences stay as they are."""
    own = lines.fenced(lines.next_nonblank(ls, id_col), id_col)
    bare, following = F.btrim("line"), F.btrim(F.coalesce("next_line", F.lit("")))
    keep = F.col("in_fence") | (bare == "") | bare.rlike(r"^[#|>]")
    return own.withColumn("line", F.when(keep, F.col("line")).otherwise(F.coalesce(by_word(bare), by_capitals(bare, following), F.col("line")))).drop("next_line", "in_fence")


def demoted(text: Column) -> Column:
    """A machine's text with headings made bold, but not within fences. One pass over the lines with the fence's state."""
    state = lambda out, fence: F.struct(out.alias("out"), fence.alias("fence"))

    def step(a: Column, line: Column) -> Column:
        mark = line.rlike(r"^\s*```")
        title = F.regexp_extract(F.btrim(line), r"^#{1,6}\s+(.+?)\s*$", 1)
        new = F.when(mark | a["fence"] | (title == ""), line).otherwise(F.concat(F.lit("**"), title, F.lit("**")))
        return state(F.concat(a["out"], F.array(new)), a["fence"] != mark)

    empty = state(F.array().cast("array<string>"), F.lit(False))
    return F.aggregate(F.split(F.coalesce(text, F.lit("")), "\n"), empty, step, lambda a: F.array_join(a["out"], "\n"))


def is_citation_heading(title: Column) -> Column:
    """Single words must be the whole heading, phrases a part of it."""
    bare = F.lower(F.regexp_replace(F.btrim(F.regexp_replace(title, r"^[\d.]+\s*", "")), ":+$", ""))
    hit = bare.isin(*[w for w in CITATIONS if " " not in w])
    for w in CITATIONS:
        if " " in w:
            hit |= F.contains(bare, F.lit(w))
    return F.coalesce(hit, F.lit(False))


def sections(ls: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, stop, level, title: each heading, and the line of the next one of its level or a higher one (null: to the end)."""
    own = lines.headings(ls, id_col).where("level is not null")
    after = Window.partitionBy(id_col).orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    ends = [F.min(F.when(F.col("level") <= n, F.col("pos"))).over(after) for n in range(1, 7)]
    return own.select(id_col, F.col("pos").alias("start"), F.get(F.array(*ends), F.col("level") - 1).alias("stop"), "level", "title")


def citation_sections(ls: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, body: the text under each heading of citations. One pass over the lines of a document, without a join: a line is in the last
    section of each level before it, unless a higher heading came since; so a line may be in several."""
    before = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    own = lines.headings(ls, id_col).withColumn("cites", is_citation_heading(F.col("title")))
    for n in range(1, 7):
        own = own.withColumn(f"_h{n}", F.last(F.when(F.col("level") == n, F.struct("pos", "cites")), ignorenulls=True).over(before))
    open_at = []
    for n in range(1, 7):
        live = F.coalesce(F.col("level") > n, F.lit(True)) & F.col(f"_h{n}.cites")
        for m in range(1, n):
            live &= F.col(f"_h{n}.pos") > F.coalesce(F.col(f"_h{m}.pos"), F.lit(-1))
        open_at.append(F.when(live, F.col(f"_h{n}.pos")))
    inside = own.select(id_col, "pos", "line", F.explode(F.array_compact(F.array(*open_at))).alias("start"))
    body = inside.groupBy(id_col, "start").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("x"))
    return body.select(id_col, "start", F.btrim(F.array_join(F.transform("x", lambda x: x["line"]), "\n"), F.lit(" \t\n")).alias("body")).where("body <> ''")
