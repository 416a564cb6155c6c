"""Main text of web pages by line-block distribution.

Markup is stripped to lines (one for each block element); lines inside menus, headers, footers, sidebars, notices,
adverts, forms and comments are struck out first, by element and by class, id or role. The text lengths (link text does
not count) are summed over windows of WINDOW lines. The surge point is the first line of the first window, the dive point
the last line of the last window, whose sum is at least the threshold, a fraction of WINDOW lines of median length; blank
edges and link lists there are trimmed. Text lines and headings next to the surge and text lines next to the dive belong
to it, however short. Lines inside <article> or <main> weigh
their full length and LEAST more; the mark is a bonus, for it may stand around teasers or comments only.

A class, id or role strikes a block by the noun that it ends in: site-footer and ad-slot do (slot is a mere container),
share-price and menu-history do not, nor do names with article, post, entry or story.

The page is read once from start to end. Scripts, styles and the like run to their end tag; a script, style, title or text
area without one runs to the end of the page, other such elements without one, and comments without an end, are read as
mere tags. Where quotation marks in a tag are not closed up to the end of the page, tags end at the next > from there on.

Defined results: a null or empty page has an empty text; an unclosed menu ends where the article begins; repeated rows each
get their result; very long pages take time in proportion to their length.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from statistics import median

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import small_batches, table

WINDOW = 3
#: Of a window of typical lines, and the least sum, in code points.
FRACTION, LEAST = 0.15, 25
# Element names and the words of class, id and role.
RAW = "script style title textarea"
HIDDEN = RAW + " noscript template svg math iframe object canvas audio video select button datalist"
STRUCK = "nav header footer aside form dialog menu head"
BLOCKS = "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul"
STRUCK_WORDS = "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted cookie cookies consent gdpr notice alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe signup login search toolbar pagination pager widget toc skip complementary contentinfo"
CONTAINERS = "area bar block body bottom box cell column container content group holder inner item items left link links list outer panel region right row section slot space top unit view wrap wrapper zone"
STORY_WORDS = "article post entry story"
VOID = "area base br col embed hr img input link meta source track wbr"

_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>")
_OTHER = re.compile(r"<[/!?][^>]*+>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_STRUCK, _BLOCKS, _VOID, _HIDDEN, _RAW = set(STRUCK.split()), set(BLOCKS.split()), set(VOID.split()), set(HIDDEN.split()), set(RAW.split())
_WORDS, _CONTAINERS, _STORY = set(STRUCK_WORDS.split()), set(CONTAINERS.split()), set(STORY_WORDS.split())
_ENDS = {name: re.compile(rf"</{name}\b[^>]*+>", re.I) for name in _HIDDEN}
_INLINE, _WALLS = set("p b i em strong span".split()), set("article main div section nav footer aside header".split())
_HEADS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _names_furniture(name: str) -> bool:
    """Whether a class, id or role says menu, advert and so on: by its last word that is not a mere container."""
    words = _WORD.findall(_CAMEL.sub(" ", name).lower())
    if _STORY.intersection(words):
        return False
    while len(words) > 1 and words[-1] in _CONTAINERS:
        words.pop()
    return bool(words) and words[-1] in _WORDS


def _struck(name: str, attributes: str) -> bool:
    if name in _STRUCK:
        return True
    if name in ("body", "html", "main", "article") or "=" not in attributes:
        return False
    return any(_names_furniture(x) for found in _NAMES.findall(attributes) for x in "".join(found).split())


def tags(page: str):
    """(start, end, closing, name, attributes) of every tag; hidden elements and comments are one nameless tag each."""
    at, pattern, endless, last = 0, _TAG, set(), page.rfind(">")
    while 0 <= (start := page.find("<", at)) < last:
        at = start + 1
        if page.startswith(("<!--", "<![CDATA["), start):
            mark = "-->" if page[start + 2] == "-" else "]]>"
            end = page.find(mark, start) if mark not in endless else -1
            if end >= 0:
                at = end + 3
                yield start, at, False, "", ""
                continue
            endless.add(mark)
        m = pattern.match(page, start)
        if m is None and pattern is _TAG and page[at : at + 2].strip("/")[:1].isalpha() and _PLAIN.match(page, start):
            pattern = _PLAIN
            m = pattern.match(page, start)
        if m is None:
            if m := _OTHER.match(page, start):
                at = m.end()
                yield start, at, False, "", ""
            continue
        at, name = m.end(), m[2].lower()
        if name in _HIDDEN and not m[1] and not m[3].endswith("/"):
            end = _ENDS[name].search(page, at) if name not in endless else None
            if end is None:
                endless.add(name)
            if end is not None or name in _RAW:
                at = end.end() if end is not None else len(page)
                yield start, at, False, "", ""
                continue
        yield start, at, bool(m[1]), name, m[3]


def lines(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, code points outside links, in an article element, heading) of every line that is not struck out."""
    out: list[tuple[str, int, bool, bool]] = []
    stack: list[str] = []
    where: dict[str, list[int]] = defaultdict(list)  # the places of each name in the stack
    walls: list[int] = []  # the places of elements that a stray inline end tag does not close
    parts: list[tuple[str, bool]] = []
    struck = link = article = 0  # struck: depth of the stack at which the struck element stands, 0 none
    head = False
    at = 0

    def close() -> None:
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                linked = " ".join("".join(p for p, a in parts if a).split())
                out.append((text, len(text) - len(linked), article > 0, head))
            parts.clear()

    for start, end, closing, name, attributes in tags(page):
        if start > at and not struck:
            parts.append((html.unescape(page[at:start]), link > 0))
        at = end
        if not name:
            continue
        if name in _BLOCKS:
            close()
        if closing:
            if where[name]:
                if name in _INLINE and walls and walls[-1] > where[name][-1]:
                    continue
                while stack:
                    top = stack.pop()
                    where[top].pop()
                    if walls and walls[-1] == len(stack):
                        walls.pop()
                    if top == "a":
                        link = max(0, link - 1)
                    elif top in ("article", "main"):
                        article -= 1
                    elif top in _HEADS:
                        head = False
                    if struck and len(stack) < struck:
                        struck = 0
                    if top == name:
                        break
            continue
        if name in _VOID or attributes.endswith("/"):
            continue
        if name in ("article", "main"):
            struck = 0 if struck and stack[struck - 1] in ("nav", "header", "menu", "head") else struck  # an unclosed menu
            article += 1
        if name == "body" and struck and stack[struck - 1] == "head":
            struck = 0
        if name == "p" and stack and stack[-1] == "p":
            stack.pop()
            where["p"].pop()
        where[name].append(len(stack))
        if name in _WALLS:
            walls.append(len(stack))
        stack.append(name)
        if name == "a":
            link += 1
        elif name in _HEADS:
            head = True
        if not struck and _struck(name, attributes):
            struck = len(stack)
    if not struck:
        parts.append((html.unescape(page[at:]), link > 0))
    close()
    return out


def main_text(page: str | None) -> str:
    found = lines(page or "")
    weights = [len(t) + LEAST if inside else size if size * 2 >= len(t) else 0 for t, size, inside, _ in found]
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    if not sums or not max(sums):
        return ""
    typical = median([w for w in weights if w >= LEAST] or [0])
    least = min(max(LEAST, FRACTION * WINDOW * typical), max(sums))
    dense = [i for i, s in enumerate(sums) if s >= least]
    surge, dive = dense[0], min(dense[-1] + WINDOW, len(found)) - 1
    small = min(LEAST, max(weights))
    while surge < dive and weights[surge] < small:
        surge += 1
    while dive > surge and weights[dive] < small:
        dive -= 1
    # text around belongs to it, up to a link list or the edge of an article
    while surge and (found[surge - 1][3] or (weights[surge - 1] and found[surge - 1][2] == found[surge][2])):
        surge -= 1
    while dive + 1 < len(found) and weights[dive + 1] and found[dive + 1][2] == found[dive][2]:
        dive += 1
    return " ".join(t for t, *_ in found[surge : dive + 1])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages without the html, with text and n_chars."""

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(main_text, na_action=None)

    small_batches(pages.sparkSession)
    rest = [F.col(f"`{c}`") for c in pages.columns if c not in (html_col, "text", "n_chars")]
    return pages.select(*rest, F.coalesce(text(F.col(html_col)), F.lit("")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
