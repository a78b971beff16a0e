"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. A word's score is the log-odds, learned from labelled pages, of being main text given the
elements it stands in (tag, class, id and role words, and whether it is outside the page's article or main element); class words count
apart for long prose, so that an article's own block with the class "tags" isn't taken for a list of tags. A tag costs the more the rarer
it is in main text. A linear scan finds the contiguous run with the largest sum, and within it the text of elements that score negative
(an advert in the article, comments) is left out; a word of a sentence stays, whatever the class of the inline element around it.

The labelled pages are written below: words that begin with c are main text, words that begin with x are not.

Cases: a null or empty html, or one without positive text, gives an empty text; unclosed elements end with the page, an unclosed tag,
comment or script reaches to its end; a null url or page_id is passed through; repeated rows each give a row, ties of runs go to the first;
an empty table gives no rows; time and memory are linear in the page, however long or ill-formed; other columns are not read.
"""

from __future__ import annotations

import functools
import html as entities
import math
import re
from collections import Counter
from collections.abc import Container, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tune

_C, _L = "<h1>c1 c2 c3</h1><p>" + "c4 " * 30 + "</p><p>c5 c6 <b>c7</b> <a href=#>c8</a> c9<br>c10</p>" + "<h2>c1</h2><p>" + "c4 " * 20 + "</p>", "<ul>" + "<li><a href=#>x1 x2</a></li>" * 6 + "</ul>"
_REST = "<blockquote><p>c1 c2 c3 c4</p></blockquote><ul><li>c1 c2 c3 c4</li><li>c1 c2 c3</li></ul><table><tr><td>c1 c2</td><td>c3</td></tr></table><figure><figcaption>c1 c2 c3</figcaption></figure><pre><code>c1 c2 c3</code></pre>"
_HEAD = "<head><title>x1 x2 x3</title></head>"
_NAV = f"<nav class='menu nav navbar navigation'>{_L}</nav>"
_ADS = "".join(f"<div class='{k}'>x1 x2 x3 x4 x5 x6</div>" for k in ("ad", "ads", "advert", "advertisement", "adverts", "banner", "promo", "promotion", "sponsored", "sponsor", "cookie", "cookies", "consent", "notice", "notices", "newsletter", "subscribe", "share", "sharing", "social", "related", "recommended", "popup", "modal", "breadcrumb", "breadcrumbs", "pagination", "sidebar", "widget", "menu", "footer", "topbar", "alert", "gdpr", "signup", "login", "search", "tags", "outbrain", "taboola", "disclaimer", "copyright"))
_COMMENTS = "".join(f"<div class='{k}'><p>x1 x2 x3 x4 x5 x6 x7</p><p>x1 x2 x3</p></div>" for k in ("comments", "comment", "comment list", "disqus", "replies", "reply", "respond", "discussion", "responses"))
_SIDE = f"<aside class='sidebar'><h3>x1 x2</h3>{_L}<p>x1 x2 x3</p></aside>"
_FOOT = "<footer class='footer'><p>x1 x2 x3 x4</p>" + _L + "</footer>"
_FORM = "<form><label>x1 x2</label><button>x3</button><select><option>x1</option></select></form>"
_TOP = f"<header class='header masthead'><div class='logo'>x1 x2</div>{_NAV}</header>"
_PROSE = "c4 c5 c6 c7 c8 " * 8
_LOUD = "x1 x2 x3 x4 x5 x6 " * 6
_OWN = "".join(f"<div class='{k}'><p>{_PROSE}</p></div>" for k in ("search", "tags", "share", "sharing", "social", "related", "recommended", "copyright", "alert", "widget", "login", "signup", "disclaimer"))
_ALIEN = "".join(f"<div class='{k}'><p>{_LOUD}</p></div>" for k in ("ad", "ads", "advert", "advertisement", "adverts", "banner", "promo", "promotion", "sponsored", "sponsor", "cookie", "cookies", "consent", "notice", "notices", "newsletter", "subscribe", "popup", "modal", "sidebar", "footer", "gdpr", "outbrain", "taboola", "comments", "comment", "disqus", "replies", "reply", "respond", "discussion", "responses", "menu", "nav"))
#: The labelled pages.
LABELLED = [
    f"{_HEAD}<body>{_TOP}<article>{_C}{_OWN}{_ALIEN}{_C}{_OWN}</article>{_ALIEN}{_FOOT}</body>",
    f"{_HEAD}<body>{_TOP}<div>{_C}{_OWN}{_C}</div>{_ALIEN}{_FOOT}</body>",
    f"{_HEAD}<body>{_TOP}{_ADS}<article>{_C}{_REST}{_ADS}</article>{_COMMENTS}{_SIDE}{_FORM}{_FOOT}</body>",
    f"{_HEAD}<body>{_NAV}<main>{_C}{_FORM}{_REST}{_COMMENTS}</main>{_SIDE}{_FOOT}</body>",
    f"{_HEAD}<body>{_NAV}<div>x1 x2 x3</div><article><header>{_C}</header>{_C}{_SIDE}{_C}</article><p>x1 x2 x3</p><section class='comments'><h3>x1</h3><article class='comment'><p>x1 x2 x3 x4 x5</p></article></section>{_FOOT}</body>",
    f"{_HEAD}<body><div id='nav'>{_L}</div><div class='content post entry article body text story main'>{_C}{_REST}</div><div id='comments'>{'<div><p>x1 x2 x3 x4</p></div>' * 3}</div><div id='footer'>x1 x2 x3</div></body>",
    f"{_HEAD}<body>{_ADS}<div class='content post entry'>{_C}{_C}{_ADS}{_C}</div>{_COMMENTS}{_FOOT}</body>",
    f"{_HEAD}<body>{_TOP}<div>{_C}{_REST}{_C}</div>{_FOOT}</body>",
    f"{_HEAD}<body><div role='navigation'>{_L}</div><div role='banner'>x1 x2</div><div role='main'>{_C}</div><div role='complementary'>x1 x2 x3</div><div role='contentinfo'>x1 x2 x3</div><dialog>x1 x2 x3</dialog><div role='alert'>x1 x2</div><div role='dialog'>x1 x2 x3</div><div role='search'>x1</div></body>",
]

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
#: Elements whose content is not markup, and those whose content is never text.
SILENT = {x: re.compile(rf"(?i)</{x}(?=[\s/>])[^>]*>?") for x in "script style noscript template textarea iframe object svg math canvas audio video noframes noembed".split()}
TAG_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
#: What follows a tag's name, to its end. A quote counts only after an equals sign; nothing is tried twice, so this takes one pass.
REST = re.compile(r"""((?>[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>""")
NAMES = re.compile(r"""(?i)(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
HIDDEN = re.compile(r"""(?i)(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""")
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
CONTAINERS = frozenset(("article", "main", "role=main"))
#: Words from which a block without many links is prose.
PROSE = 20


def features(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and the words of its class, id and role; classes are kept apart from tags by a dot."""
    return _features(tag, attributes) if len(attributes) <= 200 else _features.__wrapped__(tag, attributes)


@functools.lru_cache(4096)
def _features(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    if attributes:
        for m in NAMES.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "role":
                out.append(f"role={value.strip().lower()}")
            else:
                out += [f".{x}" for x in SPLIT.split(CAMEL.sub(" ", value).lower()) if x]
        if HIDDEN.search(attributes):
            out.append("hidden")
    return tuple(out)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', raw text, ''), ('start', name, attributes) and ('end', name, ''), in one pass. Comments and silent elements are left out."""
    at = seen = 0
    quoted = True
    while (i := page.find("<", seen)) >= 0:
        seen, after = i + 1, page[i + 1 : i + 2]
        if after in ("!", "?"):
            start, stop = ("<!--", "-->") if page.startswith("<!--", i) else ("<![CDATA[", "]]>") if page.startswith("<![CDATA[", i) else ("", ">")
            end = page.find(stop, i + 2)
            if i > at:
                yield "text", page[at:i], ""
            if start == "<![CDATA[":
                yield "text", entities.escape(page[i + 9 : end if end >= 0 else len(page)]), ""
            at = seen = len(page) if end < 0 else end + len(stop)
            continue
        closes = after == "/"
        m = TAG_NAME.match(page, i + 1 + closes)
        if not m and not closes:
            continue
        if i > at:
            yield "text", page[at:i], ""
        rest = REST.match(page, m.end()) if m and not closes and quoted else None
        if rest is None:
            # a quote that is never closed is none: from here on tags end at the next bracket
            quoted = quoted and (closes or not m)
            end = page.find(">", i)
            if end < 0:
                return
            attributes, end = page[m.end() if m else end : end], end + 1
        else:
            attributes, end = rest[1], rest.end()
        at = seen = end
        if not m:
            continue
        name = m[0].lower()
        if closes:
            yield "end", name, ""
        elif name not in SILENT:
            yield "start", name, attributes.strip().removesuffix("/")
        elif not (attributes.endswith("/") and name in ("svg", "math")):
            over = SILENT[name].search(page, end)
            at = seen = over.end() if over else len(page)
    if at < len(page):
        yield "text", page[at:], ""


def units(page: str, known: Container[str] | None = None) -> Iterator[tuple]:
    """('text', raw text, features of the open blocks, features of the open inline elements) and ('tag', name, is end, starts a block).
    Only known features are kept, if given, so that a deep page has no large sets."""
    none: frozenset[str] = frozenset()
    stack: list[tuple[str, frozenset[str], frozenset[str]]] = []
    blocks: list[int] = []  # places of open blocks in the stack
    open_: Counter[str] = Counter()

    def shut(to: int) -> None:
        for x in stack[to:]:
            open_[x[0]] -= 1
        del stack[to:]
        while blocks and blocks[-1] >= to:
            blocks.pop()

    for kind, value, attributes in tokens(page):
        if kind == "text":
            yield "text", value, *(stack[-1][1:] if stack else (none, none))
            continue
        is_block = value in BLOCK
        if kind == "end":
            if open_[value]:
                to = len(stack) - 1
                while stack[to][0] != value:
                    to -= 1
                shut(to)
            yield "tag", value, True, is_block
            continue
        if is_block and blocks and value != "body":
            # a block ends an open paragraph, with the inline elements left open in it; like items end one another
            nearest = stack[blocks[-1]][0]
            if nearest == "p" or (nearest == value and value in ("li", "dt", "dd", "td", "th", "tr", "option")):
                shut(blocks[-1])
        if value not in VOID:
            own = frozenset(f for f in features(value, attributes) if known is None or f in known or f == "hidden")
            outer, inline = stack[-1][1:] if stack else (none, none)
            if is_block:
                outer = outer if own <= outer else outer | own
                blocks.append(len(stack))
            else:
                inline = inline if own <= inline else inline | own
            stack.append((value, outer, inline))
            open_[value] += 1
        yield "tag", value, False, is_block


def contained(page_units: list[tuple]) -> bool:
    return any(u[0] == "text" and u[2] & CONTAINERS and u[1].strip() for u in page_units)


def prose(page_units: list[tuple]) -> list[bool]:
    """Of each unit, whether it is in a block of PROSE words or more, of which links have fewer than half."""
    out: list[bool] = []
    words = linked = 0
    for k, u in enumerate([*page_units, ("tag", "", True, True)]):
        if u[0] == "text":
            n = len(u[1].split())
            words += n
            linked += n if "a" in u[3] else 0
        elif u[3]:
            out += [words >= PROSE and 2 * linked < words] * (k - len(out))
            words = linked = 0
    return out


def seen(found: frozenset[str], has: bool) -> frozenset[str]:
    """The features of a word, with where it stands to the container; on a page without one, a linked list item is a menu's."""
    if has:
        return found if found & CONTAINERS else found | {"outside"}
    return found | {"li>a"} if "li" in found and "a" in found else found


@functools.lru_cache(1)
def weights() -> tuple[dict[str, float], dict[str, float]]:
    """Log-odds of features for words, and costs of tags, from the labelled pages. A class in prose has its own log-odds, marked by ~."""
    inside, outside, tag_in, tag_all = Counter(), Counter(), Counter(), Counter()
    for page in LABELLED:
        us = list(units(page))
        has, last = contained(us), False
        for u, long in zip(us, prose(us), strict=True):
            if u[0] == "text":
                found = seen(u[2] | u[3], has)
                found = [f"{f}~" if long and f[0] == "." else f for f in found]
                for w in u[1].split():
                    last = w[0] == "c"
                    (inside if last else outside).update(found)
            else:
                tag_all[u[1]] += 1
                tag_in[u[1]] += last
    word = {f: math.log((inside[f] + 0.5) / (outside[f] + 0.5)) for f in inside | outside}
    tag = {t: 0.05 - 0.5 * math.log((tag_in[t] + 0.5) / (n + 1)) for t, n in tag_all.items()}
    return word, {t: min(2.0, max(0.02, TAG_SHARE * x)) for t, x in tag.items()}


@functools.lru_cache(1)
def known() -> frozenset[str]:
    return frozenset(f.removesuffix("~") for f in weights()[0]) | CONTAINERS


#: A word's score without any known element, and the least and greatest score.
BASE, LEAST, MOST = 1.0, -4.0, 2.0
#: How much a tag counts beside a word: a paragraph of one word must not be lost to its own tags.
TAG_SHARE = 0.15
#: The least score of a piece of text.
DEEPEST = -8.0
#: Elements that say nothing about the text in them.
NEUTRAL = frozenset("html body div span section p b i em strong a br ul ol li h1 h2 h3 h4 h5 h6 header".split())


def word_score(found: frozenset[str], word: dict[str, float], has: bool, long: bool = False) -> float:
    """The strongest log-odds against, if any element speaks against; else the strongest for."""
    said = [word.get(f"{f}~", word.get(f)) if long and f[0] == "." else word.get(f) for f in seen(found, has) if f not in NEUTRAL]
    known = [x for x in said if x is not None]
    if "header" in found and not found & CONTAINERS and not has:
        known.append(-2.0)
    if "hidden" in found:
        return LEAST
    against = min(known, default=0.0)
    return max(LEAST, against) if against < -1.0 else min(MOST, max(0.3, BASE + max(known, default=0.0)))


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum, the first of equal ones; empty where no sum is positive."""
    best, a, b, total, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, a, b = total, start, i + 1
    return a, b


def extract(page: str | None) -> str:
    """The main text, blocks joined by a line feed."""
    if not page:
        return ""
    word, cost = weights()
    us = list(units(page, known()))
    has, longs = contained(us), prose(us)
    of: dict[tuple, float] = {}

    def rate(found: frozenset[str], long: bool) -> float:
        s = of.get((found, long))
        if s is None:
            s = of[found, long] = word_score(found, word, has, long)
        return s

    own: list[float] = []
    held: list[int] = []  # texts of a block whose inline elements alone speak against them
    plain = False
    for k, (u, long) in enumerate(zip(us, longs, strict=True)):
        s = 0.0
        if u[0] == "text":
            s = rate(u[2] | u[3], long)
            if u[1].strip():
                if s > 0:
                    plain = True
                elif "hidden" not in u[3] and rate(u[2] | {f for f in u[3] if f[0] != "."}, long) > 0:
                    held.append(k)
        own.append(s)
        if (u[0] == "tag" and u[3]) or k == len(us) - 1:
            for i in held if plain else ():
                own[i] = rate(us[i][2], longs[i])
            held, plain = [], False
    scores = []
    for u, s in zip(us, own, strict=True):
        if u[0] == "text":
            n = len(u[1].split())
            # what is left out anyway must not cut a page in two: it counts next to nothing in a container, and is bounded elsewhere
            scores.append(s * n if s >= 0 else -0.02 * n if u[2] & CONTAINERS else max(DEEPEST, s * n))
        else:
            scores.append(-cost.get(u[1], 0.5) * (0.5 if u[1] in ("br", "hr") else 1.0))
    a, b = best_run(scores)
    blocks, piece = [], []
    for u, s in zip(us[a:b], own[a:b], strict=True):
        if u[0] == "text":
            if s > 0:
                piece.append(entities.unescape(u[1]))
        elif u[3]:
            blocks.append("".join(piece))
            piece = []
        elif u[1] in ("br", "wbr", "img", "input"):
            piece.append(" " if u[1] == "br" else "")
    blocks.append("".join(piece))
    return "\n".join(x for x in (" ".join(p.split()) for p in blocks) if x)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    tune(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h.as_py()) for h in b["html"]]
            yield pa.RecordBatch.from_arrays([b["page_id"].cast(pa.int64()), b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
