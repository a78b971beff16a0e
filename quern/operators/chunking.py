"""Structure-aware chunking. Paragraphs of a section are packed into a token budget, and no chunk spans two sections. What is over the budget is
taken apart: a table by rows, with its header repeated; prose by sentences, then words, then characters. A fence is one paragraph."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import ship

HEADING = re.compile(r"^(#{1,6})\s+(.+?)\s*#*\s*$")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
ROW, RULE = re.compile(r"^\s*\|.*\|\s*$"), re.compile(r"^\s*\|(?:\s*:?-+:?\s*\|)+\s*$")
# The lines that open and close a machine interpretation, and the share of markup lines that makes a chunk markup-heavy.
OPENS = r"^> \[.+ — VLM interpretation \(.+\); reconstruction, verify against original\]$"
CLOSES = r"^> \[/VLM interpretation .+\]$"
MARKUP_SHARE = 0.6
MARKUP_LINE = r"^\s*(?:\||> \[)"
FENCE = r"^\s*```"
SCHEMA = "doc_id long, chunk_index int, breadcrumb string, text string, n_tokens int, reconstruction boolean"
TYPES = {"doc_id": pa.int64(), "chunk_index": pa.int32(), "breadcrumb": pa.string(), "text": pa.string(), "n_tokens": pa.int32(), "reconstruction": pa.bool_()}
# Characters of chunks that are held before they are handed on.
HELD = 1 << 22


def count_words(text: str) -> int:
    return len(text.split())


def paragraphs(text: str) -> Iterator[str]:
    """Blank lines end a paragraph, but not within a fence; a fence is a paragraph of its own, an open one reaches to the end."""
    held: list[str] = []
    fence = False
    for line in text.split("\n"):
        mark = line.strip().startswith("```")
        if fence:
            held.append(line)
            if mark:
                yield "\n".join(held)
                held, fence = [], False
        elif mark:
            if held:
                yield "\n".join(held)
            held, fence = [line], True
        elif line.strip():
            held.append(line)
        elif held:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def _halves(text: str, budget: int, count: Callable[[str], int]) -> Iterator[str]:
    """A run of characters without a space, halved until it fits."""
    if len(text) < 2 or count(text) <= budget:
        yield text
    else:
        yield from _halves(text[: len(text) // 2], budget, count)
        yield from _halves(text[len(text) // 2 :], budget, count)


def _filled(units: Sequence[str], sep: str, room: int, budget: int, count: Callable[[str], int], base: int = 0) -> Iterator[list[str]]:
    """Units in groups whose counts, with base, add up to the budget at most; the first group has room. A single unit may be over it."""
    held: list[str] = []
    total = base
    for u in units:
        n = count(u)
        if held and total + n > room:
            yield held
            held, total, room = [], base, budget
        held.append(u)
        total += n
    if held:
        yield held


def pieces(text: str, budget: int, count: Callable[[str], int], room: int | None = None) -> Iterator[str]:
    """A paragraph in parts of at most the budget, the first of at most room; only a single row of a table may be over it."""
    room = budget if room is None else room
    rows = text.split("\n")
    if len(rows) > 2 and ROW.match(rows[0]) and RULE.match(rows[1]):
        head = "\n".join(rows[:2])
        for group in _filled(rows[2:], "\n", room, budget, count, count(head)):
            yield "\n".join([head, *group])
        return
    units: list[str] = []
    for s in filter(None, (x.strip() for x in SENTENCE.split(text))):
        if count(s) <= budget:
            units.append(s)
            continue
        words = [h for w in s.split() for h in _halves(w, budget, count)]
        units += [" ".join(g) for g in _filled(words, " ", budget, budget, count)]
    for group in _filled(units, " ", room, budget, count):
        yield " ".join(group)


def chunk_text(text: str | None, budget: int = 512, count: Callable[[str], int] = count_words) -> Iterator[tuple[str, str, int, bool]]:
    """breadcrumb, text, tokens, and whether any of it is a machine's interpretation. A heading goes with the first piece that follows it;
    an interpretation that isn't closed ends at the next heading."""
    path: dict[int, str] = {}
    held: list[tuple[str, bool]] = []
    total, inside = 0, False
    opens, closes = re.compile(OPENS), re.compile(CLOSES)

    def out(parts: list[tuple[str, bool]]) -> Iterator[tuple[str, str, int, bool]]:
        if parts:
            body = "\n\n".join(p for p, _ in parts)
            yield " › ".join(path[k] for k in sorted(path)), body, count(body), any(f for _, f in parts)

    for p in paragraphs(text or ""):
        first = p.partition("\n")[0].strip()
        m = HEADING.match(first)
        made = bool(opens.match(first) or closes.match(first))
        inside = bool(opens.match(first)) or (inside and not m and not made)
        flag = made or inside
        if m:
            yield from out(held)
            held, total = [], 0
            level = len(m[1])
            path = {k: v for k, v in path.items() if k < level} | {level: m[2]}
        n = count(p)
        if n <= budget:
            if held and total + n > budget:
                yield from out(held)
                held, total = [], 0
            held.append((p, flag))
            total += n
            continue
        only_heading = len(held) == 1 and HEADING.match(held[0][0].partition("\n")[0]) and total < budget
        parts = list(pieces(p, budget, count, budget - total if only_heading else None))
        if only_heading and count(f"{held[0][0]}\n\n{parts[0]}") <= budget:
            yield from out([*held, (parts.pop(0), flag)])
        else:
            yield from out(held)
            parts = list(pieces(p, budget, count)) if only_heading else parts
        held, total = [], 0
        for x in parts:
            yield from out([(x, flag)])
    yield from out(held)


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA as Arrow batches that are closed as soon as their texts reach HELD characters."""
    held: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), TYPES.values(), strict=True)], names=list(TYPES))

    for r in rows:
        held.append(r)
        size += len(r[3]) + 64
        if size >= HELD:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def chunks(docs: DataFrame, budget: int = 512, count: Callable[[str], int] = count_words) -> DataFrame:
    """The chunks of documents (doc_id, text). A worker holds one Arrow batch of its input, one text of it and HELD characters of its output."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for d, text in zip(b.column(0), b.column(1), strict=True):
                key = d.as_py()
                for i, c in enumerate(chunk_text(text.as_py(), budget, count)):
                    yield key, i, *c

    return docs.select("doc_id", "text").mapInArrow(lambda batches: _batches(rows(batches)), SCHEMA)


def markup_lines(text: Column) -> Column:
    """total, markup: lines that aren't blank, and those of them that are fences, within a fence, table rows or markers."""
    state = lambda total, markup, fence: F.struct(total.alias("total"), markup.alias("markup"), fence.alias("fence"))
    one = lambda c: F.when(c, 1).otherwise(0)

    def step(a: Column, line: Column) -> Column:
        mark = line.rlike(FENCE)
        return state(a["total"] + 1, a["markup"] + one(mark | a["fence"] | line.rlike(MARKUP_LINE)), a["fence"] != mark)

    solid = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"\S"))
    return F.aggregate(solid, state(F.lit(0), F.lit(0), F.lit(False)), step)


def markup_heavy(text: Column) -> Column:
    """True where over MARKUP_SHARE of the lines are markup; false for a text without lines."""
    m = markup_lines(text)
    return (m["total"] > 0) & (m["markup"] > m["total"] * MARKUP_SHARE)
