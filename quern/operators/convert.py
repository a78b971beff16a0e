"""Converters of raw files to Markdown, by extension: HTML, DOCX and XLSX by the standard library; charts of either; the guard of archives. A file
that can't be converted is a row with an error, never a failed job."""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import ship

# The largest member of an archive and all of them, the least image that is told, OCR's names of languages.
MEMBER, TOTAL, IMAGE = 128 << 20, 512 << 20, 5000
LANGUAGES = {
    "en": "eng", "sr": "srp", "hr": "hrv", "bs": "bos", "sl": "slv", "sq": "sqi", "mk": "mkd", "de": "deu", "fr": "fra", "it": "ita", "es": "spa", "ru": "rus", "ar": "ara", "zh": "chi_sim", "ja": "jpn",
}
ALONE = ("eng", "chi_sim", "chi_tra", "jpn", "ara")
MAIN, DRAWING = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}", "{http://schemas.openxmlformats.org/drawingml/2006/main}"
SHEET, RELS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}", "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
CHART = "{http://schemas.openxmlformats.org/drawingml/2006/chart}"
CHARTS = {"bar": "bar", "bar3D": "bar", "line": "line", "line3D": "line", "pie": "pie", "pie3D": "pie", "doughnut": "doughnut", "radar": "radar", "scatter": "scatter", "area": "area", "area3D": "area"}


class ConversionError(ValueError):
    pass


def ocr_languages(language: Column) -> Column:
    """What OCR is asked for: a language and English, but for scripts that English would disturb; English for one that isn't known."""
    known = F.coalesce(F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])[F.coalesce(language, F.lit("en"))], F.lit("eng"))
    return F.when(known.isin(*ALONE), known).otherwise(F.concat(known, F.lit("+eng")))


def is_scan(pages: DataFrame, doc: str, text: str) -> DataFrame:
    """doc, scan: whether fewer than half of the pages have 50 characters of text."""
    return pages.groupBy(doc).agg((F.avg((F.length(F.btrim(F.coalesce(text, F.lit("")))) >= 50).cast("int")) < 0.5).alias("scan"))


def guard(archive: zipfile.ZipFile) -> None:
    """An error for an archive that says it inflates to too much."""
    sizes = [x.file_size for x in archive.infolist()]
    if max(sizes, default=0) > MEMBER or sum(sizes) > TOTAL:
        raise ConversionError("the archive inflates to too much")


def table(rows: list[list[str]]) -> str:
    """A Markdown table, the first row its header; columns that are empty in all rows are left out."""
    width = max(map(len, rows))
    rows = [r + [""] * (width - len(r)) for r in rows]
    keep = [i for i in range(width) if any(r[i].strip() for r in rows)] or list(range(width))
    lines = ["| " + " | ".join(r[i] for i in keep) + " |" for r in rows]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * len(keep)) + " |", *lines[1:]])


def merge_tables(markdown: str) -> str:
    """Tables that follow one another with equal headers become one."""
    is_table = lambda b: all(re.match(r"^\|.*\|\s*$", x) for x in b.split("\n") if x.strip()) and bool(b.strip())
    out: list[str] = []
    for block in markdown.split("\n\n"):
        rows = block.split("\n")
        if out and len(rows) > 1 and is_table(block) and is_table(out[-1]) and out[-1].split("\n")[0].strip() == rows[0].strip() and "\n" in out[-1]:
            out[-1] = "\n".join([out[-1], *rows[2:]])
        else:
            out.append(block)
    return "\n\n".join(out)


class _Markdown(HTMLParser):
    """Headings, paragraphs, lists, tables and preformatted text of a page; of its article or main element, if it has one."""

    SKIP = frozenset("script style noscript template nav header footer aside form button select iframe svg".split())
    BLOCK = frozenset("p div section article main ul ol li table tr blockquote pre figure figcaption h1 h2 h3 h4 h5 h6 body dl dt dd".split())

    def __init__(self, inside: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.inside, self.depth, self.skip = inside, 0, 0
        self.blocks: list[str] = []
        self.text: list[str] = []
        self.mark = ""
        self.rows: list[list[str]] | None = None
        self.cell: list[str] | None = None
        self.pre = False

    def flush(self) -> None:
        raw = "".join(self.text)
        body = raw.strip("\n") if self.pre else " ".join(raw.split())
        if body.strip():
            self.blocks.append(f"```\n{body}\n```" if self.pre else self.mark + body)
        self.text, self.mark = [], ""

    def end_cell(self) -> None:
        if self.cell is not None and self.rows is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(" ".join("".join(self.cell).split()))
        self.cell = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.SKIP:
            self.skip += 1
        if tag in ("td", "th", "tr"):
            self.end_cell()
        self.depth += tag == self.inside
        if tag in self.BLOCK and self.cell is None:
            self.flush()
        if tag == "table" and self.rows is None:
            self.rows = []
        elif tag == "tr" and self.rows is not None:
            self.rows.append([])
        elif tag in ("td", "th") and self.rows is not None:
            self.cell = []
        elif tag == "br":
            self.handle_data(" ")
        elif tag == "pre":
            self.pre = True
        if self.cell is None:
            self.mark = f"{'#' * int(tag[1])} " if re.fullmatch("h[1-6]", tag) else "- " if tag == "li" else "> " if tag == "blockquote" else self.mark

    def handle_endtag(self, tag: str) -> None:
        if tag in self.SKIP and self.skip:
            self.skip -= 1
        if tag in ("td", "th", "tr", "table"):
            self.end_cell()
        if tag == "table" and self.rows is not None:
            rows, self.rows, self.cell = [r for r in self.rows if any(r)], None, None
            if rows:
                self.blocks.append(table(rows))
        elif tag in self.BLOCK and self.cell is None:
            self.flush()
            self.pre = self.pre and tag != "pre"
        if tag == self.inside and self.depth:
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if not self.skip and (self.inside is None or self.depth):
            (self.text if self.cell is None else self.cell).append(data)


_ACT = ("eli-subdivision", "eli-container", "oj-ti-section-1")


def act_headings(page: str) -> str:
    """Marks of chapters, sections, articles and annexes in the pages of the official journal become headings."""
    def to(level: int, m: re.Match) -> str:
        text = " — ".join(" ".join(re.sub(r"<[^>]*>", " ", x).split()) for x in m.groups() if x)
        return f"<h{level}>{text}</h{level}>"

    title = r"\s*(?:<div class=\"eli-title\"[^>]*>\s*<p class=\"oj-{}\"[^>]*>(.*?)</p>\s*</div>)?"
    # an article below a section is one level deeper
    parts = re.split(r"(?=<div[^>]*\bid=\"cpt_)", page)
    for i, part in enumerate(parts):
        m = re.match(r"<div[^>]*\bid=\"(cpt_[IVXLCDM]+(?:\.sct_\d+)?)\"", part)
        deep = bool(m) and ".sct_" in m[1]
        part = re.sub(r"<p class=\"oj-ti-section-1\"[^>]*>(.*?)</p>" + title.format("ti-section-2"), lambda x, deep=deep: to(2 if deep else 1, x), part, flags=re.S)
        parts[i] = re.sub(r"<p class=\"oj-ti-art\"[^>]*>(.*?)</p>" + title.format("sti-art"), lambda x, deep=deep: to(3 if deep else 2, x), part, flags=re.S)
    page = re.sub(r"<p class=\"oj-doc-ti\"[^>]*>(.*?)</p>(?:\s*<p class=\"oj-doc-ti\"[^>]*>(.*?)</p>)?", lambda x: to(1, x), "".join(parts), flags=re.S)
    return re.sub(r"<p class=\"oj-ti-grseq-1\"[^>]*>(.*?)</p>", lambda x: to(2, x), page, flags=re.S)


#: Preprocessors of pages: name, whether it applies, what it does. The first that applies is used.
PREPROCESSORS: list[tuple[str, Callable[[str], bool], Callable[[str], str]]] = [("act headings", lambda page: any(x in page for x in _ACT), act_headings)]


def html_markdown(raw: bytes) -> str:
    page = raw.decode("utf-8", "replace")
    for _, applies, change in PREPROCESSORS:
        if applies(page):
            page = change(page)
            break
    low = page.lower()
    parser = _Markdown(next((t for t in ("article", "main") if f"<{t}" in low), None))
    parser.feed(page)
    parser.close()
    parser.flush()
    if not parser.blocks:
        raise ConversionError("the page has no text")
    return merge_tables("\n\n".join(parser.blocks))


def _relations(archive: zipfile.ZipFile, part: str) -> dict[str, tuple[str, str]]:
    """id -> (kind, target part) of a part's relationships; broken ones are left out."""
    folder, name = posixpath.split(part)
    path = posixpath.join(folder, "_rels", f"{name}.rels")
    if path not in archive.namelist():
        return {}
    out = {}
    for r in ElementTree.fromstring(archive.read(path)):
        target = r.get("Target") or ""
        full = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
        if r.get("TargetMode") != "External" and full in archive.namelist():
            out[r.get("Id") or ""] = ((r.get("Type") or "").rsplit("/", 1)[-1], full)
    return out


def docx_markdown(raw: bytes) -> str:
    """Paragraphs, headings, lists, tables, and a marker for each image that is referred to and large enough, once."""
    import hashlib

    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        guard(archive)
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{MAIN}body")
        relations = _relations(archive, "word/document.xml")
        blocks, seen = [], set()

        def text(e: ElementTree.Element) -> str:
            return "".join(x.text or "" if x.tag == f"{MAIN}t" else "\t" if x.tag == f"{MAIN}tab" else " " if x.tag == f"{MAIN}br" else "" for x in e.iter()).strip()

        for e in body if body is not None else []:
            if e.tag == f"{MAIN}tbl":
                blocks.append(table([[text(c).replace("\n", " ") for c in r.iter(f"{MAIN}tc")] for r in e.iter(f"{MAIN}tr")] or [[""]]))
            elif e.tag == f"{MAIN}p":
                style = e.find(f"{MAIN}pPr/{MAIN}pStyle")
                name = (style.get(f"{MAIN}val") or "") if style is not None else ""
                m = re.fullmatch(r"(?i)heading\s*([1-6])", name)
                mark = "#" * int(m[1]) + " " if m else "# " if name.lower() == "title" else "- " if e.find(f"{MAIN}pPr/{MAIN}numPr") is not None else ""
                if own := text(e):
                    blocks.append(mark + own)
            for blip in e.iter(f"{DRAWING}blip"):
                kind, part = relations.get(blip.get(f"{RELS}embed") or "", ("", ""))
                data = archive.read(part) if kind == "image" else b""
                key = hashlib.sha256(data).hexdigest()[:12]
                if len(data) >= IMAGE and key not in seen:
                    seen.add(key)
                    blocks.append(f"> [Figure, image {key}]")
        if not blocks:
            raise ConversionError("the document has no text")
        return merge_tables("\n\n".join(blocks))


def _numbers(cache: ElementTree.Element | None) -> list:
    """The points of a cache as a list as long as it says, with gaps."""
    if cache is None:
        return []
    count = cache.find(f"{CHART}ptCount")
    points = {int(p.get("idx") or 0): (p.findtext(f"{CHART}v") or "") for p in cache.iter(f"{CHART}pt")}
    n = int(count.get("val") or 0) if count is not None else max(points, default=-1) + 1
    return [points.get(i) for i in range(n)]


def parse_chart(root: ElementTree.Element) -> dict:
    """kind, stacked, title, categories and series (name, values) of a chart; several kinds are a combo, none that is known is other."""
    plots = [p for p in root.iter() if p.tag.startswith(CHART) and p.tag.endswith("Chart")]
    kinds = []
    for p in plots:
        kind = CHARTS.get(p.tag[len(CHART) : -len("Chart")], "other")
        direction = p.find(f"{CHART}barDir")
        kinds.append("column" if kind == "bar" and direction is not None and direction.get("val") == "col" else kind)
    series, categories = [], []
    for p in plots:
        for s in p.iter(f"{CHART}ser"):
            name = " ".join(x.text or "" for x in s.iterfind(f"{CHART}tx//{CHART}v"))
            value = s.find(f"{CHART}val") if s.find(f"{CHART}val") is not None else s.find(f"{CHART}yVal")
            numbers = _numbers(value.find(f".//{CHART}numCache")) if value is not None else []
            series.append({"name": name, "values": [None if v in (None, "") else float(v) for v in numbers]})
            cat = s.find(f"{CHART}cat")
            if cat is not None and not categories:
                cache = cat.find(f".//{CHART}strCache")
                categories = [v or "" for v in _numbers(cache if cache is not None else cat.find(f".//{CHART}numCache"))]
    grouping = [g.get("val") for p in plots for g in p.iterfind(f"{CHART}grouping")]
    title = root.find(f".//{CHART}title")
    return {
        "kind": kinds[0] if len(set(kinds)) == 1 else "combo" if kinds else "other", "stacked": any(g in ("stacked", "percentStacked") for g in grouping),
        "title": " ".join(t.text or "" for t in title.iter(f"{DRAWING}t")) if title is not None else "", "categories": categories, "series": series,
    }


def number(value: float | None, code: str | None = None) -> str:
    """A value as its format code has it: per cent, decimals with thousands; four digits that count without one."""
    if value is None:
        return ""
    digits = len(re.match(r"[0#]*", code.split(".", 1)[1])[0]) if code and "." in code else 0
    if code and "%" in code:
        return f"{value * 100:.{digits}f}%"
    return f"{value:,.{digits}f}" if code and re.search("[0#]", code) else f"{value:.4g}"


def chart_markdown(chart: dict, code: str | None = None) -> str | None:
    """The chart's title, a diagram where its series are whole and Mermaid has the kind, and a table; null without values."""
    series = [s for s in chart["series"] if any(v is not None for v in s["values"])]
    if not series:
        return None
    n = max(len(s["values"]) for s in series)
    labels = chart["categories"] or [str(i + 1) for i in range(n)]
    whole = all(len(s["values"]) == len(labels) and None not in s["values"] for s in series)
    quoted = lambda x: '"' + re.sub(r'["\n]', " ", x) + '"'
    diagram = None
    if whole and chart["kind"] in ("pie", "doughnut") and len(series) == 1 and min(series[0]["values"]) >= 0:
        diagram = "\n".join(["```mermaid", "pie showData", *(f"    {quoted(c)} : {v:.4g}" for c, v in zip(labels, series[0]["values"], strict=True)), "```"])
    elif whole and chart["kind"] in ("bar", "column", "line") and not (chart["stacked"] and len(series) > 1):
        word = "line" if chart["kind"] == "line" else "bar"
        diagram = "\n".join(["```mermaid", "xychart-beta", f"    x-axis [{', '.join(map(quoted, labels))}]", *(f"    {word} [{', '.join(f'{v:.4g}' for v in s['values'])}]" for s in series), "```"])
    rows = [["Category", *(s["name"] or f"Series {i + 1}" for i, s in enumerate(series))]]
    rows += [[c.replace("\n", " "), *(number(s["values"][i] if i < len(s["values"]) else None, code) for s in series)] for i, c in enumerate(labels)]
    return "\n\n".join(x for x in (f"**{chart['title']}**" if chart["title"] else None, diagram, table(rows)) if x)


def _cell(c: ElementTree.Element, strings: list[str], dates: set[int]) -> str:
    kind, value = c.get("t"), c.findtext(f"{SHEET}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{SHEET}t")).strip().replace("\n", " ")
    if value is None:
        return ""
    if kind == "s":
        return strings[int(value)].strip().replace("\n", " ")
    if kind == "b":
        return "TRUE" if value == "1" else "FALSE"
    if kind in ("str", "e"):
        return value.strip().replace("\n", " ")
    x = float(value)
    if int(c.get("s") or 0) in dates:
        t = dt.datetime(1899, 12, 30) + dt.timedelta(days=x)
        return t.date().isoformat() if x == int(x) else t.replace(microsecond=0).isoformat()
    return str(int(x)) if x == int(x) else repr(x)


def xlsx_markdown(raw: bytes) -> str:
    """A table a sheet, in the workbook's order, with hidden and empty sheets told, and the sheet's charts after it."""
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        guard(archive)
        names = archive.namelist()
        strings = ["".join(t.text or "" for t in si.iter(f"{SHEET}t")) for si in ElementTree.fromstring(archive.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        dates: set[int] = set()
        if "xl/styles.xml" in names:
            styles = ElementTree.fromstring(archive.read("xl/styles.xml"))
            own = {int(f.get("numFmtId") or 0) for f in styles.iter(f"{SHEET}numFmt") if re.search("[dmy]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode") or ""))}
            xfs = styles.find(f"{SHEET}cellXfs")
            dates = {i for i, x in enumerate(xfs if xfs is not None else []) if int(x.get("numFmtId") or 0) in own | set(range(14, 23))}
        relations, blocks = _relations(archive, "xl/workbook.xml"), []
        for s in ElementTree.fromstring(archive.read("xl/workbook.xml")).iter(f"{SHEET}sheet"):
            kind, part = relations.get(s.get(f"{RELS}id") or "", ("", ""))
            if kind != "worksheet":
                continue
            rows = []
            for r in ElementTree.fromstring(archive.read(part)).iter(f"{SHEET}row"):
                cells: dict[int, str] = {}
                for k, c in enumerate(r.iter(f"{SHEET}c")):
                    letters = re.match("[A-Z]*", c.get("r") or "")[0]
                    at = -1
                    for x in letters:
                        at = (at + 1) * 26 + ord(x) - 65
                    cells[at if letters else k] = _cell(c, strings, dates)
                rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
            hidden = " (hidden)" if s.get("state") in ("hidden", "veryHidden") else ""
            blocks += [f"## {s.get('name')}{hidden}", table(rows) if any(any(r) for r in rows) else "> [empty sheet]"]
            for kind, drawing in _relations(archive, part).values():
                for kind2, chart in _relations(archive, drawing).values() if kind == "drawing" else ():
                    made = chart_markdown(parse_chart(ElementTree.fromstring(archive.read(chart)))) if kind2 == "chart" else None
                    blocks += [made] if made else []
        if not blocks:
            raise ConversionError("the workbook has no sheet")
        return "\n\n".join(blocks)


#: Converters by extension: name, version, function. A new version has documents converted again.
CONVERTERS: dict[str, tuple[str, str, Callable[[bytes], str]]] = {"html": ("html", "1", html_markdown), "htm": ("html", "1", html_markdown), "docx": ("docx", "1", docx_markdown), "xlsx": ("xlsx", "1", xlsx_markdown)}


def converted(files: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """path, converter (name/version), markdown, error: one row a file, in Arrow batches; an error says why there is no text."""
    ship(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b[path_col], b[content_col], strict=True):
                name, version, convert = CONVERTERS.get(path.rsplit(".", 1)[-1].lower(), (None, None, None))
                if convert is None:
                    rows.append((path, None, None, "no converter"))
                    continue
                try:
                    rows.append((path, f"{name}/{version}", convert(bytes(content or b"")), None))
                except (ConversionError, zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError, RecursionError, OverflowError) as e:
                    rows.append((path, f"{name}/{version}", None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "converter", "markdown", "error"])

    return files.select(path_col, content_col).mapInPandas(run, "path string, converter string, markdown string, error string")


def figures_injected(text: str, figures: dict[str, str], model: str) -> str:
    """A document's figure markers replaced by their interpretations, from the last to the first; one without an interpretation stays."""
    for m in reversed(list(re.finditer(r"^> \[Figure, (.*?([0-9a-f]{12}))\]$", text, re.M))):
        if (made := figures.get(m[2])) is not None:
            block = f"> [Figure, {m[1]} — VLM interpretation ({model}); reconstruction, verify against original]\n\n{made}\n\n> [/VLM interpretation {m[2]}]"
            text = text[: m.start()] + block + text[m.end() :]
    return text
