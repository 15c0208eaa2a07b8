"""Main text of HTML pages by the distribution of text over lines.

Markup is stripped so that every block element becomes a line. Lines in menus, headers, footers,
sidebars, notices, adverts, forms and comments, told by element, role, class or id, weigh nothing;
with an article (or main) element, so do lines outside of it, unless the text outside surges twice
as much. The weights of three lines in a row
are summed. Where that sum surges above a threshold the text begins, where it dives to nothing it
ends; all lines between, other than those left out by their element, are kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: Without article or main, a surge needs this many characters in a window, or this share of the
#: largest window if that is less.
SURGE_CHARS, SURGE_SHARE = 80, 0.25
#: An article or main element is not the story if windows outside it surge so many times as much.
OUTSIDE = 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?>\"[^\"]*\"|'[^']*'|[^\s>]*+))*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?", re.DOTALL
)
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp",
        "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
           "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s",
           "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
           "wbr", "img"}
_LEFT_OUT = {"head", "nav", "aside", "footer", "form", "button", "select", "menu", "dialog",
             "svg", "math", "canvas", "object", "audio", "video", "header", "fieldset"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
          "alert", "alertdialog", "menu", "menubar", "toolbar"}
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|adbox|adslot|sponsor|"
    r"sponsored|promo|promotion|banner|nav|navbar|navigation|menu|submenu|breadcrumbs?|sidebar|"
    r"footer|masthead|topbar|cookies?|consent|gdpr|notice|notification|popup|modal|overlay|"
    r"newsletter|subscribe|signup|login|search|share|sharing|social|related|recommended|"
    r"recommendations|comments?|commentlist|respond|disqus|repl(?:y|ies)|widget|toolbar|"
    r"pagination|pager|copyright|disclaimer|skip)(?:$|[\s_-])",
    re.IGNORECASE,
)
_HEADER_NAME = re.compile(r"(?:^|[\s_-])(?:header|site-header|page-header)(?:$|[\s_-])", re.I)
_ROOTS = {"html", "body", "main", "article"}
#: Elements whose id is an anchor of the article's own parts, but for those of a tool.
_PARTS = {"section", "h1", "h2", "h3", "h4", "h5", "h6", "p"}
_TOOLS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|sponsor|sponsored|promo|newsletter|subscribe|"
    r"signup|share|sharing|related|recommended|recommendations|comments?|commentlist|respond|"
    r"disqus|repl(?:y|ies)|cookies?|consent|widget|sidebar|footer)(?:$|[\s_-])",
    re.IGNORECASE,
)
_CLOSED_BY_NEXT = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}


def _is_left_out(tag: str, attributes: str, inside: bool, in_line: bool) -> bool:
    if tag in _LEFT_OUT:
        return tag != "header" or not inside
    if not attributes.strip():
        return False
    named = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        named.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    if "hidden" in named or named.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", named.get("style", ""), re.IGNORECASE):
        return True
    if tag == "html" or tag == "body" or tag == "main" or in_line and tag in _INLINE:
        return False  # words within a sentence belong to it
    if named.get("role", "").lower() in _ROLES:
        return True
    names, own = named.get("class", ""), named.get("id", "")
    if not (inside and tag in _PARTS) or _TOOLS.search(own):
        names = f"{names} {own}"
    if tag == "article":  # only comments come as articles of their own
        return bool(re.search(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies))(?:$|[\s_-])", names, re.I))
    return bool(_NAMES.search(names)) or (not inside and bool(_HEADER_NAME.search(names)))


def lines(page: str) -> tuple[list[tuple[str, int, bool]], bool]:
    """The page as (text, characters outside links, inside an article or main), and whether it
    has one. Lines that are left out have an empty text."""
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    plain = link = 0
    skipped, depth = "", 0  # element that is left out, and how often it is open in itself
    articles = mains = 0
    has_article = has_main = False

    def flush():
        nonlocal plain
        if text:
            line = " ".join("".join(text).split())
            if line:
                out.append((line, plain, articles > 0, mains > 0))
            text.clear()
        plain = 0

    def say(piece):
        nonlocal plain
        if piece and not skipped:
            piece = html.unescape(piece)
            text.append(piece)
            if not link:
                plain += len("".join(piece.split()))

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing, attributes = found[1] or found[4], found[3] or found[6] or ""
        if skipped and skipped in _CLOSED_BY_NEXT and tag not in _INLINE | _VOID:
            skipped, depth = "", 0  # its end tag may be missing
            flush()
            if closing:
                continue
        if not closing and tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        if skipped:
            if tag == skipped and tag not in _VOID:
                depth += -1 if closing else 1
                if not depth:
                    skipped = ""
                    out.append(("", 0, articles > 0, mains > 0))
            continue
        if tag not in _INLINE and tag != "br":
            flush()
        elif tag == "br":
            text.append(" ")
        if tag == "a":
            link = 0 if closing else 1
        elif tag not in _INLINE:
            link = 0 if tag not in _VOID else link
        if closing:
            if tag == "article":
                articles = max(0, articles - 1)
            elif tag == "main":
                mains = max(0, mains - 1)
            continue
        if tag not in _VOID and _is_left_out(
            tag, attributes, articles > 0, bool("".join(text).strip())
        ):
            flush()
            skipped, depth = tag, 1
            continue
        if tag == "article":
            articles, has_article = articles + 1, True
        elif tag == "main":
            mains, has_main = mains + 1, True
    flush()
    place = 2 if has_article else 3
    marked = has_article or has_main
    return [(line[0], line[1], marked and line[place]) for line in out], marked


def _window_sums(weights: list[int]) -> list[int]:
    """Sums of WINDOW lines in a row; the one with number i ends with line i."""
    sums, total = [], 0
    for i in range(len(weights) + WINDOW - 1):
        total += weights[i] if i < len(weights) else 0
        total -= weights[i - WINDOW] if i >= WINDOW else 0
        sums.append(total)
    return sums


def _surging(weights: list[int]) -> int:
    """Characters in windows above SURGE_CHARS; overlapping windows count each."""
    return sum(total for total in _window_sums(weights) if total > SURGE_CHARS)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found, marked = lines(page)
    if marked and not any(text and inside for text, _, inside in found):
        marked = False  # an empty article
    if marked and _surging([0 if inside else plain for _, plain, inside in found]) > (
        OUTSIDE * _surging([plain if inside else 0 for _, plain, inside in found])
    ):
        marked = False  # a teaser: the windows surge elsewhere
        found = [("", 0, False) if inside else (text, plain, False) for text, plain, inside in found]
    weights = [
        (len(text) if inside else 0) if marked else plain for text, plain, inside in found
    ]
    sums = _window_sums(weights)
    threshold = 0 if marked else min(SURGE_CHARS, SURGE_SHARE * max(sums, default=0))
    kept: list[str] = []
    i = 0
    while i < len(weights):
        if max(sums[i : i + WINDOW], default=0) <= threshold or not weights[i]:
            i += 1
            continue
        last = j = i  # the surge; now up to the dive
        while j < len(weights) and sums[j + WINDOW - 1] > 0:
            last = j if weights[j] else last
            j += 1
        last = next((k for k in range(min(j, len(weights) - 1), last - 1, -1) if weights[k]), last)
        first, after = i, last + 1
        if not marked:  # rows of links at the ends
            while first < last and 2 * weights[first] < len(found[first][0]):
                first += 1
            while last > first and 2 * weights[last] < len(found[last][0]):
                last -= 1
        kept += [found[k][0] for k in range(first, last + 1)
                 if found[k][0] and (not marked or found[k][2])]
        i = after
    return " ".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``; the whole html is read.

    Character references are decoded, white space in a block becomes one space, blocks are
    joined by one space. Null, empty and text-free pages give an empty text. Broken markup is
    read as browsers do: an unclosed comment or script hides the rest. Other columns are ignored.
    """
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
