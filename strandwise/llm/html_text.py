"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines in a block, the least characters of a block that make a surge, and how often a character within the article counts.
WINDOW, SURGE, RAISED = 3, 80, 3
#: Elements whose content is never text, elements outside the main text, names of classes and ids that mark
#: such parts, names that may stand beside those in one class, marks that don't count as the last part of another name, words
#: that make a name one of a layout, and elements that don't break lines.
SILENT = "script style noscript template iframe svg math canvas object select textarea button title head audio video".split()
ASIDE = "nav header footer aside form menu dialog".split()
MARKS = "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies disclaimer footer header masthead menu nav navbar navigation contentinfo complementary newsletter notice popup promo promoted related reply replies share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
PLAIN = "area articles bar block body bottom box button buttons col column consent container content desktop fixed form global group icons inner item items left link links list mobile outer page panel posts primary right row secondary section signup site slot sticky stories text top unit wrap wrapper".split()
WEAK = "header masthead reply replies".split()
LAYOUT = "with without has no".split()
INLINE = "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
#: Elements that end by themselves: they don't hold others open.
LOOSE = "p li dt dd tr td th option thead tbody tfoot colgroup".split()
#: Elements within running text: they are no containers of their own.
FLOW = "h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure figcaption table caption address hgroup body html".split()

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^<>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_SETS = {name: frozenset(values) for name, values in {"silent": SILENT, "aside": ASIDE, "marks": MARKS, "plain": PLAIN, "weak": WEAK, "layout": LAYOUT, "inline": INLINE, "void": VOID, "loose": LOOSE, "flow": LOOSE + FLOW}.items()}


def _marked(attributes: str) -> bool:
    """Whether a class, id or role names a part outside the main text: a whole name whose parts are all in MARKS or PLAIN, one
    of them in MARKS, as comment-list; or whose last part is in MARKS and not WEAK, as reader-comments, but not with-sidebar."""
    for found in _ATTRIBUTE.finditer(attributes):
        if found[1].lower() not in ("class", "id", "role"):
            continue
        for name in (found[2] or found[3] or found[4] or "").lower().split():
            parts = [x for x in re.split(r"[_-]+|[0-9]+", name) if x]
            if any(x in _SETS["marks"] for x in parts):
                if all(x in _SETS["marks"] or x in _SETS["plain"] for x in parts):
                    return True
                if parts[-1] in _SETS["marks"] and parts[-1] not in _SETS["weak"] and not any(x in _SETS["layout"] for x in parts):
                    return True
    return False


class Line(NamedTuple):
    """Text between block elements, without markup. linked: its characters within links; outside: within an element that is
    never main text; marks: numbers of the elements around it whose class, id or role marks them so; listed: in a list item;
    place: number of the container around it: of the article, if it is in one, else of the nearest element that isn't LOOSE, a
    heading, a list or the like."""

    text: str
    linked: int
    outside: bool
    marks: tuple[int, ...]
    article: bool
    listed: bool
    place: int = 0


def lines(page: str) -> list[Line]:
    """The lines of a page. A header within an article counts as article. An element ends with its own end or with that of the one around it."""
    out: list[Line] = []
    stack: list[tuple[str, bool, tuple[int, ...], bool, int, bool]] = []  # name, outside, marks, article, place, listed
    opened: Counter[str] = Counter()  # how many elements of a name are on the stack
    text: list[str] = []
    linked, link, at, end, marked, places = 0, False, 0, len(page), 0, 0
    endless: set[str] = set()  # silent elements that have no end further on
    hidden: list | None = None  # a marked inline element: name, open elements of that name, pieces and linked characters before it, blocks around it

    def flush():
        nonlocal linked
        if hidden:
            del text[hidden[2] :]
            linked, hidden[2:4] = hidden[3], (0, 0)
        joined = _SPACE.sub(" ", html.unescape("".join(text))).strip() if text else ""
        if joined:
            _, outside, marks, article, place, listed = stack[-1] if stack else ("", False, (), False, 0, False)
            out.append(Line(joined, linked, outside, marks, article, listed, place))
        text.clear()
        linked = 0

    while at < end:
        found = _TOKEN.search(page, at)
        piece = page[at : found.start() if found else end]
        if piece:
            text.append(piece)
            linked += len(piece) if link else 0
        if not found:
            break
        at = found.end()
        close, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if name == "br":
            text.append(" ")
            continue
        if name == "a":
            link = not close
        if name in _SETS["silent"] and not close:
            if name in ("head", "title"):
                flush()
            if not attributes.endswith("/"):
                stop = None if name in endless else re.compile(rf"</{name}\s*>", re.I).search(page, at)
                body = re.compile(r"<body\b", re.I).search(page, at) if name in ("head", "title") and not stop and name not in endless else None
                if not stop:
                    endless.add(name)
                if stop:
                    at = stop.end()
                elif body:
                    at = body.start()
                elif name in ("script", "style", "template", "noscript"):
                    at = end
            continue
        if name in _SETS["inline"]:
            if name in _SETS["void"]:
                continue
            if hidden and name == hidden[0]:
                hidden[1] += -1 if close else 1
                if not hidden[1]:
                    del text[hidden[2] :]
                    linked, hidden = hidden[3], None
            elif not hidden and not close and name != "a" and _marked(attributes):
                hidden = [name, 1, len(text), linked, len(stack)]
            continue
        flush()
        if name in _SETS["void"]:
            continue
        if close:
            while opened[name]:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == name:
                    break
        elif not attributes.endswith("/"):
            while stack and stack[-1][0] in _SETS["loose"] and name in ("p", stack[-1][0], "article", "main", "nav", "footer", "aside", "section", "div"):
                opened[stack.pop()[0]] -= 1
            top = stack[-1] if stack else ("", False, (), False, 0, False)
            article = top[3] or name in ("article", "main")
            marks = top[2]
            if name not in ("body", "html", "article", "main") and _marked(attributes):
                marked += 1
                marks = (*marks, marked)
            if article != top[3] or not article and name not in _SETS["flow"]:
                places += 1
                place = places
            else:
                place = top[4]
            stack.append((name, top[1] or (name in _SETS["aside"] and not (name == "header" and top[3])), marks, article, place, top[5] or name == "li"))
            opened[name] += 1
        if hidden and len(stack) < hidden[4]:
            hidden = None
    flush()
    return out


def candidates(found: list[Line]) -> list[Line]:
    """Lines that no element excludes. A mark doesn't count if without it fewer than SURGE characters would be left and the
    element holds more than half of the page's text: then it is a name for the page, not for a part beside the text."""
    found = [x for x in found if not x.outside]
    left = [x for x in found if not x.marks]
    if sum(len(x.text) for x in left) >= SURGE or any(x.article for x in left):
        return left
    held: dict[int, int] = {}
    for x in found:
        for m in x.marks:
            held[m] = held.get(m, 0) + len(x.text)
    void = {m for m, n in held.items() if 2 * n > sum(len(x.text) for x in found)}
    return [x for x in found if void.issuperset(x.marks)]


def blocks(sizes: np.ndarray) -> np.ndarray:
    """The line-block distribution: at each line, the characters of it and the next WINDOW - 1 lines."""
    return np.convolve(sizes, np.ones(WINDOW, np.int64))[WINDOW - 1 :] if len(sizes) else sizes


def line_sizes(found: list[Line]) -> tuple[np.ndarray, np.ndarray]:
    """What each line counts in the distribution, and whether it may stand in a part although it counts nothing.

    Lines that are mostly links count nothing. Article and main elements are evidence if they hold half of the text or more:
    each character in them counts RAISED times (not in link lists), and lines outside them count only where the blocks of the
    lines outside surge as high as the article's blocks are on average.
    """
    length = np.array([len(x.text) for x in found])
    links, article, listed = (np.array([f(x) for x in found], bool) for f in (lambda x: 2 * x.linked > len(x.text), lambda x: x.article, lambda x: x.listed))
    if 2 * length[article].sum() < length.sum() or not article.any():
        return np.where(links, 0, length), np.ones(len(found), bool)
    outside = blocks(np.where(article | links, 0, length))
    height = np.array([outside[max(0, i - WINDOW + 1) : i + 1].max() for i in range(len(found))])
    high = height >= max(SURGE, blocks(np.where(article, length, 0))[article].mean())
    own = np.where(links & listed, 0, RAISED * length)
    return np.where(article, own, np.where(high & ~links, length, 0)), article


def main_parts(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Parts (start, end) of the lines. The distribution falls to 0 between regions. A region with a surge, a block of SURGE or
    more, is a part from its first surge to the dive behind its last one, where the block that ends there falls under SURGE,
    but without lines of size 0 at its edges. If no region has a surge, that of the highest block is the part."""
    ahead = blocks(sizes)
    behind = blocks(sizes[::-1])[::-1]
    used = np.flatnonzero(sizes)
    if not len(used):
        return []
    cut = np.flatnonzero(np.diff(used) > WINDOW)
    regions = [(int(used[a]), int(used[b]) + 1) for a, b in zip([0, *(cut + 1)], [*cut, len(used) - 1], strict=True)]
    out = []
    for a, b in regions:
        rise, fall = np.flatnonzero(ahead[a:b] >= SURGE), np.flatnonzero(behind[a:b] >= SURGE)
        if len(rise):
            inside = used[(used >= a + rise[0]) & (used <= a + fall[-1])]
            out.append((int(inside[0]), int(inside[-1]) + 1))
    return out or [max(regions, key=lambda r: ahead[r[0] : r[1]].max())]


def to_containers(parts: list[tuple[int, int]], sizes: np.ndarray, places: list[int]) -> list[tuple[int, int]]:
    """Parts that go on, within their region, while the lines beside them that count are in a container that the part has SURGE
    characters in: a surge finds a part, and where its region or its container ends the part ends, not where a block happens to fall.
    Parts that meet are one."""
    used = np.flatnonzero(sizes).tolist()
    out: list[tuple[int, int]] = []
    for a, b in parts:
        held: Counter[int] = Counter()
        for i in range(a, b):
            held[places[i]] += int(sizes[i])
        inside = {place for place, n in held.items() if n >= min(SURGE, max(held.values()))}
        at, to = bisect_left(used, a), bisect_left(used, b) - 1
        while at and used[at] - used[at - 1] <= WINDOW and places[used[at - 1]] in inside:
            at -= 1
        while to + 1 < len(used) and used[to + 1] - used[to] <= WINDOW and places[used[to + 1]] in inside:
            to += 1
        a, b = used[at], used[to] + 1
        while out and a <= out[-1][1]:
            first, last = out.pop()
            a, b = min(a, first), max(b, last)
        out.append((a, b))
    return out


def main_text(page: str | None) -> str:
    """The main text of one page: the lines between the surge and dive points of its line-block distribution, up to the ends of
    their containers, joined by a newline. Null, empty and markup-only pages have none; lines that repeat are all kept."""
    found = candidates(lines(page or ""))
    if not found:
        return ""
    sizes, stays = line_sizes(found)
    parts = to_containers(main_parts(sizes), sizes, [x.place for x in found])
    return "\n".join(found[i].text for a, b in parts for i in range(a, b) if sizes[i] or stays[i])


def extract_text(pages: DataFrame) -> DataFrame:
    """pages (html, any other columns) with text and n_chars added (columns of these names are replaced).

    Null, empty and markup-only pages have an empty text; rows that repeat have each their own, equal one. Each page is taken
    whole and alone, however long; nothing is shuffled. An empty table gives no rows.
    """

    @F.pandas_udf("string")
    def run(page: pd.Series) -> pd.Series:
        return page.map(main_text)

    out = pages.drop("text", "n_chars").withColumn("text", run(F.coalesce(pages["html"].cast("string"), F.lit(""))))
    return out.withColumn("n_chars", F.length("text").cast("long"))
