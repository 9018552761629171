"""Main text of HTML pages (operator 9).

A page becomes a flat list of text blocks in page order.  A block has its word
count and link density, those of its neighbours, whether it is a heading,
whether it stands in an article element or in an element for something else
(``ASIDE_ELEMENTS``), and whether it stands in a box whose class, id or role
has one of ``ASIDE_NAMES``.  A decision tree, trained on the small labelled
table below, says which blocks are the article.  An element's kind outweighs
the words; a box's name does not: long running text in a named box is kept.

The html, body, main and article elements are never boxes by their names (an
article inside another one, as reader comments are marked, may be), and no
element is something else, by its name or its kind, that contains the article: the main
element, or the longest article element that has no such name itself, or, without any,
``MOST`` of the page's running words (a form or dialog around the page, a header
that holds it).  A nav, footer, aside or menu element never contains it.  A name after no, with, has and the like does not count, nor
does a header of an article, nor an id whose last word is something else.

Defined results: null, empty and text-free pages give an empty text; unclosed
and stray tags are tolerated; a comment, script, style or textarea without an
end runs to the end of the page, another element that is skipped (button, svg,
...) to the next block-level tag; a tag without an end is dropped; a page of any length is read whole, in time
that grows with its length; equal pages give equal texts; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.models import Tree, fit_tree

# element names (fixed values)
BLOCK_ELEMENTS = frozenset((
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead tr ul").split())
SKIPPED_ELEMENTS = frozenset("script style noscript template title svg math iframe object textarea select button head".split())
#: skipped elements whose content is text up to their end, whatever stands in it
RAW_ELEMENTS = frozenset("script style textarea".split())
ARTICLE_ELEMENTS = frozenset("article main".split())
ASIDE_ELEMENTS = frozenset("nav header footer aside form dialog menu fieldset".split())
#: of these the ones that never contain the article
APART_ELEMENTS = frozenset("nav footer aside menu".split())
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: parts of class and id names that say what does not belong to an article
ASIDE_NAMES = frozenset((
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disclaimer discussion feedback footer header login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification overlay pagination popup promo promotion recommended related replies reply respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget").split())
#: elements that no class or id makes an aside
PAGE_ELEMENTS = frozenset("html body main article".split())
#: a name after one of these says what there is or is not, not what the element is
QUALIFIERS = frozenset("no not non without with has have hide show".split())
#: names of an article: its header is not the page's
ARTICLE_NAMES = frozenset("article post entry story content".split())
#: words at the end of an id that leave open what it names
GENERIC_NAMES = frozenset((
    "area articles author bar block body bottom box button buttons column container content form inner item items left link "
    "links list main meta outer panel posts primary right secondary section slot stories text top widgets wrap wrapper").split())
#: share of a page's running words, without an article element, that only the article's surroundings hold
MOST = 0.9

# a quote counts only as the start of an attribute's value
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+)>", re.S)
#: what a tag that never ends, at the end of a page, starts with
_OPEN_TAG = re.compile(r"<[a-zA-Z/!?]")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[_\-:]+")


#: what holds no tags, before a tag that is looked for
_OPAQUE = r"<!--.*?(?:-->|\Z)|<(script|style|textarea)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>]|\Z)|\Z)|"
_FLAGS = re.S | re.I
# the options of an unclosed select are no text of the page
_BLOCK_TAG = re.compile(_OPAQUE + rf"(?P<tag></?(?:{'|'.join(sorted(BLOCK_ELEMENTS - {'option'}))})(?=[\s/>]))", _FLAGS)
_SKIPPED_TAGS = {
    name: re.compile(_OPAQUE + rf"(?P<end></{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z))|(?P<tag><{name}(?=[\s/>])[^>]*>)", _FLAGS)
    for name in SKIPPED_ELEMENTS - RAW_ELEMENTS}
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", _FLAGS) for name in RAW_ELEMENTS}


def _ends(page: str, name: str) -> dict[int, int]:
    """Where the elements of a name end, by where they start; unclosed ones are not in it."""
    starts: list[int] = []
    ends = {}
    for m in _SKIPPED_TAGS[name].finditer(page):
        if m["tag"] and not m["tag"].endswith("/>"):
            starts.append(m.start())
        elif m["end"] and starts:
            ends[starts.pop()] = m.end()
    return ends


def _after_unclosed(page: str, at: int) -> int:
    """The next block-level tag."""
    return next((m.start() for m in _BLOCK_TAG.finditer(page, at) if m["tag"]), len(page))


class Block(NamedTuple):
    text: str
    link_words: int
    heading: bool
    in_article: bool
    in_aside: bool
    named: bool


def _is_aside(name: str, in_article: bool) -> bool:
    return name in ASIDE_ELEMENTS and not (name == "header" and in_article)


def _is_named(attributes: str, in_article: bool) -> bool:
    """Whether a class, id or role says that an element does not belong to an article."""
    for kind, *values in _NAMED.findall(attributes) if "=" in attributes else ():
        for name in "".join(values).lower().split():
            parts = [x for x in _PARTS.split(name) if x and not x.isdigit()]
            if kind.lower() == "id":  # an anchor is named by its last word
                while parts and parts[-1] in GENERIC_NAMES:
                    parts.pop()
                if parts and parts[-1] not in ASIDE_NAMES:
                    continue
            of_article = in_article or not ARTICLE_NAMES.isdisjoint(parts)
            for before, part in zip(["", *parts], parts):
                if part in ASIDE_NAMES and before not in QUALIFIERS and not (part == "header" and of_article):
                    return True
    return False


class _Part(NamedTuple):
    """A block, the innermost box around it (-1: none) and its outermost article element."""
    block: Block
    box: int
    article: int | None


class _Box(NamedTuple):
    """An element for something else by its kind (``aside``, ``apart``) or its name, in the box ``parent`` (-1: none)."""
    parent: int
    aside: bool
    apart: bool
    named: bool


def _suspects(parts: list[_Part], boxes: list[_Box], mains: list[int], articles: dict[int, int]) -> list[tuple[bool, bool]]:
    """For every box, whether it or a box around it that does not contain the article is
    an aside, and whether one is named.  ``mains`` and ``articles`` give the box around them."""
    apart = [False] * len(boxes)
    for i, box in enumerate(boxes):
        apart[i] = box.apart or box.parent >= 0 and apart[box.parent]
    words = [0 if p.box >= 0 and apart[p.box] else max(0, len(p.block.text.split()) - p.block.link_words) for p in parts]
    around = [False] * len(boxes)
    if not mains and articles:
        length = dict.fromkeys(articles, 0)
        for p, n in zip(parts, words):
            if p.article in length:
                length[p.article] += n
        mains = [articles[max(length, key=length.get)]]  # the first of the longest
    if mains:
        for at in mains:
            while at >= 0 and not around[at]:
                around[at] = True
                at = boxes[at].parent
    else:
        held, most = [0] * len(boxes), MOST * sum(words)
        for p, n in zip(parts, words):
            if p.box >= 0:
                held[p.box] += n
        for at in range(len(boxes) - 1, -1, -1):
            around[at] = held[at] > most
            if boxes[at].parent >= 0:
                held[boxes[at].parent] += held[at]
    found: list[tuple[bool, bool]] = []
    for at, box in enumerate(boxes):
        aside, named = found[box.parent] if box.parent >= 0 else (False, False)
        other = box.apart or not around[at]
        found.append((aside or other and box.aside, named or other and box.named))
    return found


def blocks(page: str) -> list[Block]:
    """Text blocks of a page, without scripts, styles and comments."""
    found: list[_Part] = []
    pieces: list[str] = []
    links: list[str] = []
    open_elements: list[tuple[str, bool, bool, bool]] = []  # name, makes an article, is apart, a box
    articles = aparts = anchors = 0
    open_articles: list[int] = []  # article elements, main not counted
    open_boxes: list[int] = []
    boxes: list[_Box] = []
    mains: list[int] = []  # the box around each main element
    candidates: dict[int, int] = {}  # article elements that may be the article, and the box around each
    n_articles = 0
    ends: dict[str, dict[int, int]] = {}
    heading = False

    def close_block() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            block = Block(text, len(html.unescape(" ".join(links)).split()), heading, articles > 0, False, False)
            found.append(_Part(block, open_boxes[-1] if open_boxes else -1, open_articles[0] if open_articles else None))
        pieces.clear()
        links.clear()

    def leave(place: int) -> None:
        nonlocal articles, aparts
        for name, article, apart, box in open_elements[place:]:
            articles -= article
            aparts -= apart
            if box:
                open_boxes.pop()
            if name == "article":
                open_articles.pop()
        del open_elements[place:]

    def add(text: str) -> None:
        if text:
            pieces.append(text)
            if anchors:
                links.append(text)

    at, size = 0, len(page)
    last_end = page.rfind(">")  # no tag ends behind it
    while at <= last_end:
        m = _TOKEN.search(page, at)
        if not m:
            break
        add(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if page.startswith("<![CDATA[", m.start()):
                add(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        closing = m[1] == "/"
        if name in SKIPPED_ELEMENTS:
            if not closing and not m[3].endswith("/"):
                if name in RAW_ELEMENTS:
                    end = _RAW_END[name].search(page, at)
                    at = end.end() if end else size
                else:
                    if name not in ends:
                        ends[name] = _ends(page, name)
                    end_of = ends[name].get(m.start())
                    if end_of:
                        at = max(at, end_of)
                    elif name != "head":  # an unclosed head: go on inside it
                        at = _after_unclosed(page, at)
            if name in BLOCK_ELEMENTS:
                close_block()
            else:
                add(" ")
            continue
        if name == "a":
            anchors = 0 if closing else 1
        elif name == "br":
            add(" ")
        opening = not closing and name not in VOID_ELEMENTS
        aside = opening and _is_aside(name, articles > 0)
        named = opening and _is_named(m[3], articles > 0)
        named_box = named and (name not in PAGE_ELEMENTS or name == "article" and bool(open_articles))
        box = aside or named_box
        if name not in BLOCK_ELEMENTS and not box:
            if closing and any(e[0] == name for e in open_elements):
                pass
            else:
                continue
        close_block()
        anchors = 0
        heading = not closing and name in ("h1", "h2", "h3", "h4", "h5", "h6")
        if closing:
            places = [i for i, e in enumerate(open_elements) if e[0] == name]
            if places:
                leave(places[-1])
            continue
        if open_elements and open_elements[-1][0] == "p":  # a block ends an open paragraph
            leave(len(open_elements) - 1)
        if opening and (box or name in ARTICLE_ELEMENTS or name in ("div", "section", "ul", "ol", "table")):
            if name == "main" and not aparts:
                mains.append(open_boxes[-1] if open_boxes else -1)
            elif name == "article":
                if not (aparts or named or open_articles):
                    candidates[n_articles] = open_boxes[-1] if open_boxes else -1
                open_articles.append(n_articles)
                n_articles += 1
            apart = aside and name in APART_ELEMENTS
            if box:
                boxes.append(_Box(open_boxes[-1] if open_boxes else -1, aside, apart, named_box))
                open_boxes.append(len(boxes) - 1)
            open_elements.append((name, name in ARTICLE_ELEMENTS, apart, box))
            articles += name in ARTICLE_ELEMENTS
            aparts += apart
    rest = page[at:]
    unended = _OPEN_TAG.search(rest)
    add(rest[:unended.start()] if unended else rest)
    close_block()
    suspect = _suspects(found, boxes, mains, candidates)
    return [p.block._replace(in_aside=suspect[p.box][0], named=suspect[p.box][1]) if p.box >= 0 else p.block for p in found]




# -- tree ------------------------------------------------------------------

#: features of a block, in the order of the table's columns
FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after",
            "heading", "in_article", "in_aside", "named")

#: labelled blocks: features, then whether the block belongs to the article
LABELLED = (
    # articles that are marked as such
    (45, 0.0, 9, 0.0, 60, 0.0, 0, 1, 0, 0, 1), (3, 0.0, 60, 0.0, 40, 0.0, 0, 1, 0, 0, 1),
    (9, 0.0, 7, 0.0, 45, 0.0, 1, 1, 0, 0, 1), (120, 0.02, 45, 0.0, 3, 0.0, 0, 1, 0, 0, 1),
    (1, 0.0, 30, 0.0, 8, 0.0, 0, 1, 0, 0, 1), (12, 0.4, 80, 0.0, 80, 0.0, 0, 1, 0, 0, 1),
    (25, 0.1, 25, 0.0, 0, 0.0, 0, 1, 0, 0, 1), (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 0, 1),
    (8, 1.0, 50, 0.0, 50, 0.0, 0, 1, 0, 0, 1), (400, 0.01, 6, 1.0, 12, 0.0, 0, 1, 0, 0, 1),
    # what stands in an article element and does not belong to it
    (11, 0.0, 45, 0.0, 60, 0.0, 0, 1, 1, 0, 0), (40, 0.0, 60, 0.0, 35, 0.0, 0, 1, 1, 0, 0),
    (90, 0.0, 30, 0.0, 20, 0.0, 0, 1, 1, 0, 0), (5, 1.0, 60, 0.0, 5, 1.0, 0, 1, 1, 0, 0),
    (3, 0.0, 45, 0.0, 12, 0.0, 1, 1, 1, 0, 0), (180, 0.0, 45, 0.0, 60, 0.0, 0, 1, 1, 0, 0),
    # menus, footers, sidebars, adverts, forms, reader comments
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 1, 0, 0), (1, 1.0, 1, 1.0, 9, 0.0, 0, 0, 1, 0, 0),
    (12, 0.0, 1, 1.0, 9, 0.0, 0, 0, 1, 0, 0), (14, 0.0, 60, 0.0, 0, 0.0, 0, 0, 1, 0, 0),
    (60, 0.0, 14, 0.0, 40, 0.0, 0, 0, 1, 0, 0), (35, 0.0, 35, 0.0, 28, 0.0, 0, 0, 1, 0, 0),
    (4, 0.0, 30, 0.2, 12, 0.5, 1, 0, 1, 0, 0), (150, 0.0, 20, 0.0, 20, 0.0, 0, 0, 1, 0, 0),
    (20, 0.5, 10, 0.5, 10, 0.5, 0, 0, 1, 0, 0), (6, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0),
    # pages without an article element: long running text and what joins it
    (55, 0.0, 8, 0.0, 70, 0.0, 0, 0, 0, 0, 1), (30, 0.05, 55, 0.0, 42, 0.0, 0, 0, 0, 0, 1),
    (18, 0.0, 2, 0.0, 25, 0.0, 0, 0, 0, 0, 1), (7, 0.0, 3, 1.0, 55, 0.0, 1, 0, 0, 0, 1),
    (200, 0.03, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (5, 0.0, 60, 0.0, 40, 0.0, 0, 0, 0, 0, 1),
    (3, 0.0, 25, 0.0, 90, 0.0, 0, 0, 0, 0, 1), (12, 0.0, 0, 0.0, 14, 0.0, 0, 0, 0, 0, 1),
    (8, 0.0, 40, 0.0, 2, 0.0, 0, 0, 0, 0, 1), (16, 0.2, 30, 0.0, 30, 0.0, 0, 0, 0, 0, 1),
    # pages without an article element: lists of links and short scraps
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (9, 0.9, 4, 1.0, 8, 0.8, 0, 0, 0, 0, 0),
    (4, 0.75, 60, 0.0, 3, 1.0, 0, 0, 0, 0, 0), (30, 0.8, 12, 1.0, 20, 0.9, 0, 0, 0, 0, 0),
    (2, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 0), (3, 0.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0, 0),
    (6, 0.5, 3, 1.0, 4, 0.5, 0, 0, 0, 0, 0), (15, 0.6, 50, 0.0, 10, 1.0, 0, 0, 0, 0, 0),
    (2, 1.0, 0, 0.0, 40, 0.0, 0, 0, 0, 0, 0), (5, 1.0, 60, 0.0, 45, 0.0, 0, 0, 0, 0, 0),
    (12, 0.9, 40, 0.0, 40, 0.0, 0, 0, 0, 0, 0), (7, 1.0, 30, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    # running text beside lists of links
    (45, 0.0, 60, 0.0, 3, 1.0, 0, 1, 0, 0, 1), (30, 0.0, 40, 0.0, 2, 1.0, 0, 1, 0, 0, 1),
    (7, 0.0, 3, 1.0, 5, 1.0, 1, 1, 0, 0, 1), (60, 0.05, 1, 1.0, 1, 1.0, 0, 1, 0, 0, 1),
    (8, 1.0, 50, 0.0, 20, 0.0, 0, 1, 0, 0, 1), (12, 0.9, 30, 0.0, 30, 0.0, 0, 1, 0, 0, 1),
    (50, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0, 0, 1), (90, 0.0, 3, 1.0, 1, 1.0, 0, 0, 0, 0, 1),
    (35, 0.1, 40, 0.0, 4, 0.9, 0, 0, 0, 0, 1), (22, 0.0, 50, 0.0, 3, 0.7, 0, 0, 0, 0, 1),
    (5, 1.0, 60, 0.0, 70, 0.0, 0, 0, 0, 0, 0), (9, 0.8, 80, 0.0, 90, 0.0, 0, 0, 0, 0, 0),
    (6, 1.0, 90, 0.0, 40, 0.0, 0, 1, 0, 0, 1), (3, 0.0, 1, 1.0, 40, 0.0, 1, 1, 0, 0, 1),
    (2, 0.0, 5, 1.0, 30, 0.0, 0, 1, 0, 0, 1), (4, 0.0, 2, 1.0, 5, 1.0, 0, 1, 0, 0, 1),
    (1, 0.0, 40, 0.0, 4, 1.0, 0, 1, 0, 0, 1), (3, 0.0, 80, 0.0, 1, 1.0, 0, 1, 0, 0, 1),
    (3, 0.0, 1, 1.0, 12, 1.0, 1, 1, 0, 0, 1), (2, 0.0, 2, 0.5, 6, 0.8, 0, 1, 0, 0, 1),
    (9, 0.0, 1, 0.0, 3, 0.0, 0, 1, 0, 0, 1), (25, 0.0, 2, 0.0, 2, 0.0, 0, 1, 0, 0, 1),
    (20, 0.0, 1, 1.0, 4, 1.0, 0, 1, 0, 0, 1), (20, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 0, 1),
    (4, 0.0, 1, 1.0, 2, 0.0, 1, 1, 0, 0, 1), (3, 0.0, 2, 1.0, 1, 1.0, 0, 1, 0, 0, 1),
    (2, 0.0, 0, 0.0, 60, 0.0, 1, 0, 0, 0, 1), (3, 0.0, 2, 1.0, 70, 0.0, 1, 0, 0, 0, 1),
    # menus inside an article: nothing but links, beside nothing but links
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0, 0), (2, 1.0, 2, 1.0, 1, 1.0, 0, 1, 0, 0, 0), (3, 1.0, 1, 1.0, 2, 1.0, 0, 1, 0, 0, 0),
    (5, 1.0, 4, 1.0, 6, 1.0, 0, 1, 0, 0, 0), (1, 1.0, 60, 0.0, 1, 1.0, 0, 1, 0, 0, 0), (2, 1.0, 45, 0.0, 3, 1.0, 0, 1, 0, 0, 0),
    (4, 1.0, 7, 0.0, 2, 1.0, 0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 45, 0.0, 0, 1, 0, 0, 0), (2, 1.0, 4, 1.0, 80, 0.0, 0, 1, 0, 0, 0),
    (3, 1.0, 2, 1.0, 9, 0.0, 0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 0, 0.0, 0, 1, 0, 0, 0), (2, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0, 0),
    # boxes named for something else: short, or alone
    (4, 0.0, 90, 0.0, 90, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 70, 0.0, 80, 0.0, 0, 0, 0, 1, 0),
    (7, 0.0, 60, 0.0, 95, 0.0, 0, 1, 0, 1, 0), (9, 0.0, 50, 0.0, 50, 0.0, 0, 0, 0, 1, 0),
    (5, 1.0, 30, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (4, 1.0, 3, 0.0, 50, 0.0, 0, 1, 0, 1, 0),
    (60, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 1, 0), (60, 0.0, 14, 0.0, 40, 0.0, 0, 0, 0, 1, 0),
    (50, 0.0, 2, 0.0, 45, 0.0, 0, 0, 0, 1, 0), (70, 0.0, 12, 0.0, 3, 0.0, 0, 0, 0, 1, 0),
    (20, 0.05, 30, 0.0, 30, 0.0, 0, 0, 0, 1, 0), (30, 0.1, 50, 0.0, 50, 0.0, 0, 1, 0, 1, 0),
    (12, 0.05, 50, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (75, 0.0, 4, 0.0, 30, 0.0, 0, 0, 0, 1, 0),
    (6, 0.0, 60, 0.0, 20, 0.0, 1, 0, 0, 1, 0), (5, 0.0, 5, 1.0, 30, 0.0, 1, 0, 0, 1, 0),
    (9, 0.0, 24, 0.0, 1, 0.0, 0, 1, 0, 1, 0), (11, 0.0, 45, 0.0, 60, 0.0, 0, 1, 0, 1, 0),
    (25, 0.0, 45, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (5, 1.0, 60, 0.0, 5, 1.0, 0, 1, 0, 1, 0),
    (3, 0.0, 45, 0.0, 12, 0.0, 1, 1, 0, 1, 0), (2, 0.0, 80, 0.0, 3, 1.0, 1, 0, 0, 1, 0),
    (4, 0.0, 1, 1.0, 3, 0.0, 0, 0, 0, 1, 0), (13, 0.0, 3, 0.0, 1, 0.0, 0, 0, 0, 1, 0),
    (35, 0.0, 2, 0.0, 1, 1.0, 0, 0, 0, 1, 0), (60, 0.0, 2, 0.0, 2, 0.5, 0, 0, 0, 1, 0),
    (30, 0.0, 1, 1.0, 45, 0.0, 0, 0, 0, 1, 0), (14, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (20, 0.5, 10, 0.5, 10, 0.5, 0, 0, 0, 1, 0), (6, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (45, 0.0, 12, 0.0, 90, 0.0, 0, 0, 0, 1, 0), (35, 0.0, 35, 0.0, 28, 0.0, 0, 0, 0, 1, 0),
    (90, 0.8, 10, 1.0, 12, 1.0, 0, 0, 0, 1, 0), (120, 0.6, 60, 0.0, 40, 0.0, 0, 1, 0, 1, 0),
    (16, 0.0, 70, 0.0, 80, 0.0, 0, 0, 0, 1, 0), (8, 0.0, 90, 0.0, 2, 0.0, 0, 0, 0, 1, 0),
    # boxes named for something else that hold long running text, and its headings
    (90, 0.0, 60, 0.0, 45, 0.0, 0, 1, 0, 1, 1), (180, 0.0, 45, 0.0, 60, 0.0, 0, 1, 0, 1, 1),
    (150, 0.0, 20, 0.0, 20, 0.0, 0, 0, 0, 1, 1), (85, 0.05, 0, 0.0, 30, 0.0, 0, 0, 0, 1, 1),
    (300, 0.02, 6, 1.0, 12, 0.0, 0, 0, 0, 1, 1), (100, 0.1, 3, 0.0, 0, 0.0, 0, 0, 0, 1, 1),
    (50, 0.0, 55, 0.0, 60, 0.0, 0, 0, 0, 1, 1), (45, 0.02, 50, 0.0, 48, 0.0, 0, 0, 0, 1, 1),
    (60, 0.0, 70, 0.0, 42, 0.0, 0, 1, 0, 1, 1), (48, 0.0, 65, 0.0, 55, 0.0, 0, 1, 0, 1, 1),
    (90, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0, 1, 1), (85, 0.05, 3, 1.0, 3, 1.0, 0, 0, 0, 1, 1),
    (200, 0.03, 1, 1.0, 1, 1.0, 0, 1, 0, 1, 1), (55, 0.0, 48, 0.0, 70, 0.0, 0, 0, 0, 1, 1),
    (6, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0, 1, 1), (8, 0.0, 70, 0.0, 85, 0.0, 1, 1, 0, 1, 1),
)


def trained_tree() -> Tree:
    table = np.array(LABELLED, dtype=float)
    return fit_tree(table[:, :-1], table[:, -1], depth=8)


def main_text(page: str, tree: Tree) -> str:
    """The article's blocks, one a line."""
    found = blocks(page)
    words = [0, *(len(b.text.split()) for b in found), 0]
    density = [0.0, *(min(1.0, b.link_words / max(n, 1)) for b, n in zip(found, words[1:])), 0.0]
    kept = []
    for i, b in enumerate(found, 1):
        row = (words[i], density[i], words[i - 1], density[i - 1], words[i + 1], density[i + 1],
               b.heading, b.in_article, b.in_aside, b.named)
        if tree(row) > 0.5:
            kept.append(b.text)
    return "\n".join(kept)


def text_of(page: Column) -> Column:
    """Main text of an HTML column."""
    tree = trained_tree()

    @F.pandas_udf("string")
    def extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in pages:
            yield pd.Series([main_text(p, tree) for p in part], dtype=object)

    return extracted(F.coalesce(page.cast("string"), F.lit("")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page."""
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("bigint")))
