"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of the page. Lines that page structure marks as
chrome (menus, forms, adverts, comments) count nothing. Text lengths are summed over sliding windows
of lines; at the first surge of the sum text begins, at its last dive text ends, and all lines between
are kept, short and linked ones too. Short lines next to either end belong to the text up to a line of links.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from vitrine.llm.arrays import map_texts

WINDOW = 3  # lines of a window
SURGE = 60  # characters of a window at which text begins

# fixed values: elements by what they do to the text
_SKIPPED = {
    "head", "script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "select", "textarea",
    "button", "nav", "aside", "dialog", "menu", "audio", "video", "title",
}
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
# fixed values: blocks that end an open paragraph or item of their kind
_CLOSES_P = _BLOCKS - {"body", "html", "td", "th", "tr", "li", "option"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# fixed values: words of a class, id or role that name chrome, and words that may stand beside them
_NAMES = (
    r"(?:ads?|advert[a-z0-9]*|adsense|banner|sponsor[a-z0-9]*|promo[a-z0-9]*|nav|navbar|navigation|menu[a-z0-9]*|breadcrumbs?|sidebar|side-?bar"
    r"|widget[a-z0-9]*|footer|masthead|topbar|toolbar|cookies?[a-z0-9]*|consent|gdpr|notices?|notification|alert|popup|modal|overlay"
    r"|newsletter|subscribe|signup|login|comments?|commentlist|disqus|respond|repl(?:y|ies)|share|sharing|social|related|recommend[a-z0-9]*"
    r"|pagination|pager|tags?|taglist|skip-?link|search[a-z0-9]*|form|complementary|contentinfo|toc)"
)
_BESIDE = (
    r"(?:main|top|bottom|left|right|site|page|global|primary|secondary|posts?|entry|articles?|wrapper|wrap|container|inner|outer"
    r"|list|items?|section|box|block|area|bar|links?|buttons?|row|sticky|mobile|desktop|body|header|title|user|image|text)"
)
# whole names only: each word between hyphens names chrome or may stand beside such a word
_CHROME = re.compile(
    rf"(?:^|(?<=\s))(?:{_BESIDE}[_-]+)*+{_NAMES}(?:[_-]+(?:{_NAMES}|{_BESIDE}))*(?:[_-]+\d+)?(?:$|(?=\s))", re.IGNORECASE
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|(?=<)|\Z)", re.DOTALL
)
# names of reader comments: chrome however much text they hold
_READERS = re.compile(
    rf"(?:^|(?<=\s))(?:(?:{_BESIDE}|user|reader)[_-]+)*+(?:comments?|commentlist|disqus|respond|repl(?:y|ies))"
    rf"(?:[_-]+(?:{_NAMES}|{_BESIDE}|thread|content|meta))*(?:[_-]+\d+)?(?:$|(?=\s))",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"']++)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
# names that inside an article may mark a remark of its own, if they stand on a paragraph
_REMARK = re.compile(r"(?:^|\s)(?:alert|notices?|notification)(?:[_-][a-z]+)*(?:$|\s)", re.IGNORECASE)
_WHITE = re.compile(r"\s+")


class Line(NamedTuple):
    text: str
    linked: int  # characters inside links
    chrome: bool
    region: int  # the outermost article or main element around it, counted from 1; 0 outside
    wrapper: int  # the innermost form or element of a chrome name around it, counted from 1


class _Open(NamedTuple):
    tag: str
    chrome: bool
    region: int
    wrapper: int


_PAGE = _Open("", False, 0, 0)
_NEVER = ("html", "body", "main")


def _attributes(text: str) -> dict[str, str]:
    """Names in lower case; the first of a repeated one counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _is_chrome(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    if tag in _SKIPPED or (tag == "footer") or (tag == "header" and not inside):
        return True
    if tag in _NEVER or not attributes:
        return False
    if any(_READERS.search(attributes.get(a, "")) for a in ("class", "id")):
        return True
    if tag == "article":
        return False
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NO_DISPLAY.search(attributes.get("style", "")))
    )


def _is_wrapper(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Forms and elements of a chrome name: chrome unless they hold most of the page."""
    if tag in _NEVER or tag == "article":
        return False
    if tag == "form":
        return True
    names = [attributes.get(a, "") for a in ("class", "id", "role")]
    if inside and tag == "p" and _REMARK.search(names[0]):
        return False
    return any(n and _CHROME.search(n) for n in names)


def lines(page: str) -> list[Line]:
    """Blocks of a page in order: white space made single, character references decoded.

    A form or an element of a chrome name that holds most of the text outside links is no chrome, unless
    an article outside of it has text.
    """
    found, around = _blocks(page)
    if len(around) == 1:
        return found
    held = [0] * len(around)
    for x in found:
        held[x.wrapper] += _weight(x)
    for w in range(len(around) - 1, 0, -1):  # what is opened later lies inside or beside
        held[around[w]] += held[w]
    whole = held[0]
    if any(x.region and not x.wrapper and _weight(x) for x in found):
        whole = 2 * whole + 1
    chrome = [False] * len(around)
    for w in range(1, len(around)):
        chrome[w] = chrome[around[w]] or 2 * held[w] <= whole
    return [x._replace(chrome=x.chrome or chrome[x.wrapper]) for x in found]


def _blocks(page: str) -> tuple[list[Line], list[int]]:
    """The blocks, and for every wrapper the one around it (0: none)."""
    out: list[Line] = []
    around = [0]
    parts: list[str] = []
    linked = links = regions = at = 0
    stack: list[_Open] = []
    opened: Counter[str] = Counter()

    def flush() -> None:
        nonlocal linked
        text = _WHITE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            top = stack[-1] if stack else _PAGE
            out.append(Line(text, min(linked, len(text)), top.chrome, top.region, top.wrapper))
        parts.clear()
        linked = 0

    def pop() -> None:
        opened[stack.pop().tag] -= 1

    end = len(page)
    while at < end:
        m = _TAG.search(page, at)
        chunk = page[at : m.start()] if m else page[at:]
        if chunk:
            parts.append(chunk)
            if links:
                linked += len(chunk)
        if not m:
            break
        at = m.end() if m.end() > m.start() else m.start() + 1
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in _BLOCKS:
                flush()
            if opened[tag]:  # then what is searched is closed, too
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag)
                if any(s.chrome or s.wrapper for s in stack[depth:]) or tag not in _BLOCKS:
                    _part(stack, depth, parts, flush)
                while len(stack) > depth:
                    pop()
            continue
        if tag in _BLOCKS or tag == "br":
            flush()
        if tag in _VOID or m[3].endswith("/"):
            continue
        if stack and stack[-1].tag in ({"p"} if tag in _CLOSES_P else _SIBLINGS.get(tag, ())):
            pop()  # its end tag was left out
        top = stack[-1] if stack else _PAGE
        region = top.region
        if not region and tag in ("article", "main"):
            regions += 1
            region = regions
        attributes = _attributes(m[3]) if m[3] else {}
        chrome = top.chrome or _is_chrome(tag, attributes, top.region > 0)
        wrapper = 0 if tag == "main" else top.wrapper
        if not chrome and _is_wrapper(tag, attributes, top.region > 0):
            around.append(wrapper)
            wrapper = len(around) - 1
        changed = chrome != top.chrome or wrapper != top.wrapper
        if changed:
            flush()
        if tag == "a":
            links += 1
            continue
        if tag in _BLOCKS or changed or tag in _RAW:
            stack.append(_Open(tag, chrome, region, wrapper))
            opened[tag] += 1
        if tag in _RAW:  # its content is no markup
            close = re.compile(rf"</{tag}\b", re.IGNORECASE).search(page, at)
            at = close.start() if close else end
    flush()
    return out, around


def _part(stack: list[_Open], depth: int, parts: list[str], flush) -> None:
    """Text of an inline element that is chrome ends with it."""
    before = stack[depth - 1] if depth else _PAGE
    if (stack[-1].chrome, stack[-1].wrapper) != (before.chrome, before.wrapper) and parts:
        flush()


def _weight(line: Line) -> int:
    """Characters that count as text: none in chrome, and none where most of a line is links."""
    if line.chrome or 2 * line.linked > len(line.text):
        return 0
    return len(line.text)


def _believed(found: list[Line]) -> tuple[list[Line], bool]:
    """The lines of the page's articles, and true; or the lines outside of them where these are the text.

    An article or main element is believed unless the text outside weighs more than four times as much:
    then it is a teaser. Of several articles those that weigh a fourth of the largest are the text.
    """
    weights: dict[int, int] = {}
    for x in found:
        weights[x.region] = weights.get(x.region, 0) + _weight(x)
    outside = weights.pop(0, 0)
    best = max(weights.values(), default=0)
    if not best:
        return found, False
    if outside > 4 * best:
        return [x for x in found if not x.region], False
    return [x for x in found if x.region and 4 * weights[x.region] >= best], True


def main_text(page: str) -> str:
    """The kept lines of a page, joined by line feeds."""
    found, marked = _believed(lines(page))
    own = [x for x in found if not x.chrome]
    weights = [_weight(x) for x in own]
    n = len(own)
    if not sum(weights):
        return ""
    sums = [sum(weights[max(0, i - WINDOW + 1) : i + 1]) for i in range(n)]
    # where the page itself marks its article any text is a surge, elsewhere it takes some length
    surge = 1 if marked else min(SURGE, max(sums))
    # a line belongs to the text between a surge and the dive after it
    high = [i for i in range(n) if max(sums[i : i + WINDOW]) >= surge and (weights[i] or own[i].region)]
    first, last = high[0], high[-1]
    if not marked:  # short lines around it go with the text, up to the next line of links
        while first and weights[first - 1]:
            first -= 1
        while last + 1 < n and weights[last + 1]:
            last += 1
    return "\n".join(x.text for x in own[first : last + 1])


def extract_text(pages: DataFrame, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The id columns, text and n_chars (code points) for every page.

    A null or empty page, or one without text, gives empty text. Broken markup is read leniently to
    its end. Rows are independent: repeated rows give repeated results, an empty table an empty one.
    Other columns are ignored.
    """

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [main_text(page.as_py() or "") for page in batch.column(batch.num_columns - 1)]
        return [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]

    return map_texts(pages, list(id_cols), html_col, "text string, n_chars long", work)
