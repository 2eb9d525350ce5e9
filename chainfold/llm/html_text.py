"""Main-text extraction from HTML by line-block distribution.

Markup is stripped into lines: every block element starts a new line; a
line's length is the text it adds outside links. Text of elements that never
carry an article (scripts, styles, menus, headers, footers, sidebars,
notices, adverts, forms, comments; by element, role, class or id) counts
nothing. Lengths are summed over sliding windows of ``WINDOW`` lines. A
region lies between the points where the sum leaves zero and dives back to
it, and is kept if the sum surges to ``SURGE`` characters in it; if none
does, the longest is kept, so a short text is not lost. Within the kept
regions all counted lines are joined in page order. Marks of an article
(``article`` or ``main``) are a check afterwards: if the kept lines of one
marked element have at least ``MARKED_SHARE`` of the text of the longest
unmarked run, unmarked lines go; else the marks are teasers or quotes and
mean nothing.

Character references are decoded, white space inside a block becomes one
space, ends are trimmed, blocks are joined by one space. Null, empty and
broken pages give what text they hold, at least the empty string; an element
that is never closed ends with its page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chainfold.llm import blocks as B

WINDOW = 3
SURGE = 80
MARKED_SHARE = 0.5

# Elements of the HTML standard by their role in a page.
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea select option title head".split())
ASIDE = frozenset("nav header footer aside form button menu dialog fieldset input label figcaption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
MARKS = re.compile(
    r"ads?|alerts?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|gdpr|header|masthead|menu|modal|nav|navbar|"
    r"navigation|newsletter|notices?|popup|promo\w*|related|replies|reply|share|sharing|sidebar|side|social|sponsor\w*|subscribe|"
    r"toolbar|widget|disclaimer|legal|copyright|login|signup|pagination|pager|tags"
)
# Words that say nothing of their own in a class or id; with any other word a mark means something else (side-by-side, legal-news).
NEUTRAL = frozenset(
    "a area article articles bar block body bottom box btn button card cell col column container content el element entry fixed floating form global "
    "grid group head holder icons inner item items js layer layout left line link links list main message middle module outer overlay page panel part "
    "policy post posts primary right row secondary section site slot small space sticky strip text the top unit user view wp wrap wrapper zone".split()
)
_PARTS = re.compile("[a-z]+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-hidden|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@dataclass
class Line:
    """One block's text: its characters outside links count towards the distribution; of furniture, none."""

    pieces: list[str] = field(default_factory=list)
    plain: int = 0
    linked: int = 0
    article: int = 0  # number of the outermost article element, 0 outside
    furniture: bool = False

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.pieces)).split())


def _is_aside(name: str, rest: str, inside: bool) -> bool:
    """Whether an element is page furniture; a header inside an article belongs to it."""
    if name in ASIDE and not (inside and name in ("header", "figcaption", "label")):
        return True
    if not rest.strip():
        return False
    for key, value in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "aria-hidden" and value.lower() == "true" or key == "hidden":
            return True
        if key in ("class", "id") and name not in ("html", "body", "article", "main"):
            for word in _CAMEL.sub("-", value).split():
                parts = _PARTS.findall(word.lower())
                marks = [bool(MARKS.fullmatch(p)) for p in parts]
                if any(marks) and all(m or p in NEUTRAL for m, p in zip(marks, parts, strict=True)):
                    return True
    return False


def page_lines(page: str) -> list[Line]:
    """The lines of a page; a block inside which furniture lies is cut there."""
    lines, line = [], Line()
    open_tags: list[tuple[str, bool, bool]] = []  # name, furniture, article
    open_names: Counter[str] = Counter()
    later: dict[str, re.Match | None] = {}  # the next match of a pattern that is looked for ahead
    furniture = articles = links = outermost = 0
    at, end = 0, len(page)

    def ahead(pattern: str) -> re.Match | None:
        held = later.get(pattern)
        if pattern not in later or (held and held.start() < at):
            later[pattern] = re.compile(pattern, re.I).search(page, at)
        return later[pattern]

    def close(k: int) -> None:
        nonlocal furniture, articles, links
        while len(open_tags) > k:
            name, aside, article = open_tags.pop()
            open_names[name] -= 1
            furniture -= aside
            articles -= article
            links -= name == "a"

    while at < end:
        found = _TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and furniture:
            if page[at:stop].strip() and not (lines and lines[-1].furniture):
                aside = Line(furniture=True)
                lines.append(aside)
        elif stop > at:
            text = page[at:stop]
            line.pieces.append(text)
            size = len(text.strip())
            line.plain += 0 if links else size
            line.linked += size if links else 0
            line.article = line.article or (outermost if articles and size else 0)
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name in RAW and not found["end"]:
            closing = ahead(rf"</{re.escape(name)}(?=[\s/>])[^>]*>")
            if name == "head":
                body = ahead(r"<body[\s>]")
                closing = min((m for m in (closing, body) if m), key=lambda m: m.start(), default=None)
                at = (closing.start() if closing[0].lower().startswith("<body") else closing.end()) if closing else at
            else:
                at = closing.end() if closing else end
            continue
        if name in BLOCK:
            if line.pieces:
                lines.append(line)
            line = Line()
        if found["end"]:
            if open_names[name] > 0:
                close(next(k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == name))
        elif name not in VOID and not found["rest"].rstrip().endswith("/"):
            aside, article = _is_aside(name, found["rest"], articles > 0), name in ("article", "main")
            if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and open_tags and open_tags[-1][0] == name:
                close(len(open_tags) - 1)
            open_tags.append((name, aside, article))
            open_names[name] += 1
            furniture += aside
            outermost += article and not articles
            articles += article
            links += name == "a"
    if line.pieces:
        lines.append(line)
    return [x for x in lines if x.plain or x.linked or x.furniture]


def regions_of(sizes: list[int]) -> list[tuple[int, int, int]]:
    """(first, end, surge) of the stretches between where the window's sum leaves zero and where it is back, cut to lines that count."""
    sums = [sum(sizes[i : i + WINDOW]) for i in range(len(sizes))]
    found, k = [], 0
    while k < len(sizes):
        end = k
        while end < len(sizes) and sums[end] > 0:
            end += 1
        counted = [i for i in range(k, min(end + WINDOW - 1, len(sizes))) if sizes[i]]
        if end > k and counted:
            found.append((counted[0], counted[-1] + 1, max(sums[k:end])))
        k = max(end, k + 1)
    return found


def main_text(page: str | None) -> str:
    """The article of a page; see the module text."""
    lines = page_lines(page or "")
    sizes = [0 if x.furniture or x.plain < x.linked else x.plain for x in lines]
    regions = regions_of(sizes)
    kept = [r for r in regions if r[2] >= SURGE]
    kept = kept or sorted(regions, key=lambda r: (-sum(sizes[r[0] : r[1]]), r[0]))[:1]
    body = [(x, n) for a, b, _ in kept for x, n in zip(lines[a:b], sizes[a:b], strict=True) if not x.furniture]
    longest = {True: 0, False: 0}
    for element, run in groupby(body, lambda b: b[0].article):
        longest[element > 0] = max(longest[element > 0], sum(n for _, n in run))
    only = longest[True] > 0 and longest[True] >= MARKED_SHARE * longest[False]
    return " ".join(t for x, _ in body if (x.article or not only) and (t := x.text()))


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with its HTML column replaced by the main text."""
    names = pages.columns
    place = names.index(html_col)
    others = [c for c in names if c not in (html_col, out_col)]
    schema = B.with_field(pages.select(*others).schema, out_col, T.StringType())

    def run(batches):
        for batch in batches:
            found = pa.array([main_text(p.as_py()) for p in batch.column(place)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(names.index(c)) for c in others] + [found], [*others, out_col])

    return pages.mapInArrow(run, schema)
