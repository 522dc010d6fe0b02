"""Main text of web pages by tree scoring.

A page is read into a tree of block elements; inline markup only splits
nothing.  Every text block gives its element points for length and commas;
the points rise to the ancestors, each step keeping less, and an element's
sum is discounted by the share of its text inside links.  The best element
and its siblings that score close to it are the article; every block in them
that is no page furniture is kept, in page order.
"""

from __future__ import annotations

import html as entities
import collections
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "page_id bigint, url string, text string, n_chars bigint, n_blocks int, container string"

_NODE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_PARTS = re.compile(r"[a-z]+|\d+")
_COMMAS = re.compile("[,،、，]")

# Elements that end a line of text; all others are inline.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol
    optgroup option p pre section select summary table tbody td tfoot th thead tr ul""".split())
# Content that is never shown as text and holds no elements.
RAW = frozenset("script style title textarea noscript template xmp iframe noembed noframes svg math".split())
# Page furniture by element.
JUNK_TAGS = frozenset("nav footer aside form button select dialog menu fieldset".split())
JUNK_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alert alertdialog menu
    menubar form toolbar tablist""".split())
# Page furniture by a word of class or id.
JUNK_WORDS = frozenset("""ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo
    promotion promoted banner sidebar side menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar
    footer cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe
    subscription signup login search form comment comments commentlist commentary disqus reply replies respond
    reactions discussion social share sharing sharebar related recommended recommendations teaser teasers widget
    toolbar pagination pager copyright legal disclaimer skip hidden""".split())
HEAD_WORDS = frozenset(("header", "masthead"))
GOOD_WORDS = frozenset("article content entry main post story text body blog page".split())
CLOSES = {  # an opening tag that ends an open element of these
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl table tbody thead tfoot menu dir".split())
SEMANTIC, NAMED, RISE, SIBLING = 25.0, 10.0, 0.5, 0.2


class Element:
    __slots__ = ("tag", "parent", "junk", "good", "points", "chars", "links", "order", "article", "kept")

    def __init__(self, tag, parent, junk=False, good=0.0):
        self.tag, self.parent, self.junk, self.good = tag, parent, junk, good
        self.points = self.chars = self.links = 0
        self.order = 0
        # whether it is, or lies in, an article; whether it belongs to the result
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.kept = False


def _words(attributes: str) -> tuple[frozenset[str], dict[str, str]]:
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    words = set()
    for name in names:
        parts = _NAME_PARTS.findall(name)
        if not {"has", "with", "no", "without"} & set(parts):
            words.update(parts)
    return frozenset(words), found


def _opened(tag: str, attributes: str, parent: Element) -> Element:
    inside = parent.article
    words, found = _words(attributes) if attributes.strip() else (frozenset(), {})
    junk = parent.junk or tag in JUNK_TAGS or (tag == "header" and not inside)
    if found and not junk and tag not in ("html", "body"):
        bad = words & JUNK_WORDS
        if inside:
            bad -= HEAD_WORDS
        if tag in ("article", "main"):
            bad -= {"side", "page", "notice", "legal", "header", "form", "text"}
        style = found.get("style", "").replace(" ", "").lower()
        junk = (bool(bad) or found.get("role", "").lower() in JUNK_ROLES
                or "display:none" in style or "visibility:hidden" in style
                or found.get("aria-hidden", "").lower() == "true")
        junk = junk or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) is not None
    good = SEMANTIC if tag in ("article", "main") else NAMED if words & GOOD_WORDS and tag not in ("html", "body") else 0.0
    return Element(tag, parent, junk, good)


def _up(element: Element | None) -> Iterator[Element]:
    while element is not None:
        yield element
        element = element.parent


def text_blocks(page: str) -> tuple[list[tuple[Element, str]], list[Element]]:
    """(blocks outside page furniture with their element, all elements)."""
    root = Element("#page", None)
    elements, blocks = [root], []
    here, in_link = root, 0
    is_open = collections.Counter()  # tags of ``here`` and around it
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text and not here.junk:
                blocks.append((here, text))
                here.chars += len(text)
                here.links += min(len(text), linked)
        parts, linked = [], 0

    def leave(element: Element) -> None:
        """Close everything up to ``element`` and itself."""
        nonlocal here
        stop = element.parent
        while here is not stop:
            is_open[here.tag] -= 1
            here = here.parent

    at, end = 0, len(page)
    while at < end:
        m = _NODE.search(page, at)
        stop = m.start() if m else end
        if stop > at and not here.junk:
            raw = page[at:stop]
            parts.append(raw)
            if in_link:
                linked += len(raw)
        if not m:
            break
        at = m.end()
        if m.lastindex is None:
            continue
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        tag = tag.lower()
        if tag in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = shut.end() if shut else end
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
        elif tag in ("br", "img", "input", "wbr"):
            if tag != "wbr":
                parts.append(" ")
        elif tag in BLOCK:
            flush()
            in_link = 0
            if closing:
                if is_open[tag] > 0:
                    leave(next(e for e in _up(here) if e.tag == tag))
                continue
            if tag == "hr":
                continue
            if here.tag == "p":
                leave(here)
            for old in CLOSES.get(tag, ()):
                found = next((e for e in _until(here, LISTS) if e.tag == old), None) if is_open[old] > 0 else None
                if found is not None:
                    leave(found)
            if tag in ("html", "body") and is_open[tag] > 0:
                continue
            here = _opened(tag, attributes, here)
            is_open[tag] += 1
            here.order = len(elements)
            elements.append(here)
    flush()
    return blocks, elements


def _until(element: Element, stop: frozenset[str]) -> Iterator[Element]:
    for e in _up(element):
        if e.tag in stop:
            return
        yield e


def main_text(page: str | None) -> tuple[str, int, str]:
    """(article text, number of blocks, tag of the best element)."""
    if not page:
        return "", 0, ""
    blocks, elements = text_blocks(page)
    if not blocks:
        return "", 0, ""
    for element, text in blocks:
        points = min(len(text) / 100, 3.0) + len(_COMMAS.findall(text)) + (len(text) >= 25)
        # a paragraph's points go to what holds it
        holder = element.parent if element.tag in ("p", "li", "td", "pre", "h1", "h2", "h3", "h4", "h5", "h6") else element
        (holder if holder is not None else element).points += points
    for element in reversed(elements):  # children come after their parents
        if element.parent is not None:
            element.parent.chars += element.chars
            element.parent.links += element.links
            element.parent.points += RISE * element.points

    def score(e: Element) -> float:
        return (e.points + e.good) * (1 - e.links / e.chars) if e.chars else 0.0

    best = max((e for e in elements if not e.junk and e.chars), key=lambda e: (score(e), -e.order))
    # the outermost article around the best element is the article
    for e in _up(best):
        if e.tag in ("article", "main"):
            best = e
    top, kept = score(best), {best}
    if best.tag not in ("article", "main") and best.parent is not None and best.tag not in ("body", "html", "#page"):
        kept |= {e for e in elements if e.parent is best.parent and not e.junk and score(e) >= max(SIBLING * top, 1.0)}
        if best.parent is not None:
            loose = [b for b in blocks if b[0].parent is best.parent and b[0].tag == "p" and b[0].links * 4 < b[0].chars]
            kept |= {b[0] for b in loose}
    elif best.tag in ("article", "main"):
        kept |= {e for e in elements if e.parent is best.parent and e.tag == best.tag and not e.junk
                 and score(e) >= SIBLING * top}
    for e in elements:
        e.kept = e in kept or (e.parent is not None and e.parent.kept)
    out = [text for e, text in blocks if e.kept]
    return "\n".join(out), len(out), best.tag


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, container`` of every row.

    A null or empty page, or one without text outside furniture, has the empty
    text; text without markup is one block; unclosed elements, comments and
    scripts end with the page; a null ``page_id`` or ``url`` stays null;
    repeated rows stay repeated; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([f[0] for f in found], pa.string()),
                     pa.array([len(f[0]) for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()),
                     pa.array([f[2] for f in found], pa.string())],
                    [x.split()[0] for x in SCHEMA.split(", ")])

    return pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"),
                        F.col("html").cast("string")).mapInArrow(run, SCHEMA)
