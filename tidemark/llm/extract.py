"""The main text of web pages, by the distribution of text over blocks of lines.

Markup is stripped to lines: every block element and line break ends a line, inline elements do not. A
line that lies in a menu, footer, notice, advert, script or style sheet, or that is mostly links, counts as
empty, and so does a block without text. Elements named like a header, sidebar, form, comment section and so on (class,
id or role), and ``form``, ``aside``, ``dialog`` and ``header`` elements, are boilerplate as well, unless all articles of the page
lie in them or most of its text does (for these elements, ``SURGE`` characters at least): those are wrappers.
A ``header`` within an article belongs to the article, with its title. A name counts whole or if all its parts are
such names (``footer-menu``), so ``has-sidebar`` or ``entry-header`` say nothing.

The text lengths of ``WINDOW`` lines at a time are then summed. Where the sums surge from nothing to text a
stretch begins, where they dive to nothing it ends. The main run goes from the first to the last stretch in which
``WINDOW`` lines have ``SURGE`` characters (or as many as any on the page), with all that lies between them, short
paragraphs too. A shorter stretch before or after it is taken in if at most ``NEAR`` empty lines part them, as adverts do;
what lies further off goes, however it is marked up. An article or main element is a hint: if at least half of the
text of the run lies in such elements, the main text goes from the first line in one to the last, wherever these lie.
Lines are joined in page order; nothing else is dropped.

Null html counts as empty and gives an empty text. Unclosed and misplaced tags, comments and pages cut
off in the middle are read as far as they go. Time grows in proportion to the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ready_for_python

WINDOW, SURGE, NEAR, LINKS = 3, 86, 4, 0.6

# Elements whose content is no text of the page.
_RAW = frozenset("script style noscript template textarea iframe svg math canvas object title select".split())
_UNSEEN = frozenset("script style noscript template".split())  # take no place, so words on both sides may be one
_BOILERPLATE = frozenset("nav footer menu button head".split())
# Elements that are boilerplate unless they are wrappers.
_MAY_WRAP = frozenset("form aside dialog header".split())
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}  # keeps places, which str.lower does not
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input".split()
)
_PLACE = frozenset("article main".split())
# Words in class, id or role of an element that is none of the main text.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation "
    "menu breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe signup login search comment comments discussion replies respond social share sharing related recommended "
    "widget pagination pager copyright disclaimer toolbar complementary contentinfo form".split()
)
_OF_PLACE = frozenset("ad ads advert adverts advertisement comment comments discussion replies related recommended".split())
# Parts of a name that say where or as what it stands, and nothing without one of the names.
_BESIDE = frozenset("site global primary secondary top bottom left right area box block slot unit list links posts buttons container section".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(r"""</?([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


@dataclass
class Line:
    text: str
    linked: int  # characters of links
    kept: bool
    placed: bool  # in an article or main element


@dataclass
class Mark:
    """An element that is named like boilerplate."""

    parent: int  # the mark around it, or -1
    apart: bool  # named like an advert, comments or links to other pages, which are never around the main text
    placed: bool  # in an article or main element
    tag: bool  # by its tag, not by its name
    text: int = 0  # characters in it
    around: bool = False  # an article or main element lies in it


def _names(attributes: str) -> set[str]:
    """The names of boilerplate in class, id or role."""
    found = set()
    for values in _NAMED.findall(attributes):
        for value in "".join(values).split():
            parts = {x.lower() for x in _PART.findall(value)}
            if parts <= _NAMES | _BESIDE:
                found |= parts & _NAMES
    return found


def _is_boilerplate(name: str, attributes: str) -> bool:
    """By its tag or style alone, or as an article that is an advert or a comment."""
    if name in _BOILERPLATE:
        return True
    if not attributes or name in ("html", "body"):
        return False
    if name in _PLACE:
        return not _names(attributes).isdisjoint(_OF_PLACE)
    return bool(_HIDDEN.search(attributes))


def _drop_marked(lines: list[Line], marks: list[Mark], in_marks: list[int], free_place: bool) -> None:
    """Sets the lines in marked elements to not kept, but for those in wrappers."""
    texts = [len(x.text) if x.kept and (x.placed or x.linked <= LINKS * len(x.text)) else 0 for x in lines]
    for n, i in zip(texts, in_marks, strict=True):
        if i >= 0:
            marks[i].text += n
    for mark in reversed(marks):
        if mark.parent >= 0:
            marks[mark.parent].text += mark.text
            marks[mark.parent].around |= mark.around
    total = sum(texts)
    placed = sum(n for n, x in zip(texts, lines, strict=True) if x.placed)
    free = any(n and x.placed and i < 0 for n, x, i in zip(texts, lines, in_marks, strict=True))
    dropped: list[bool] = []
    by_tag: list[bool] = []
    for mark in marks:
        whole = placed if mark.placed else total
        most = mark.text >= whole if mark.apart else 2 * mark.text > whole
        most = most and not (mark.tag and mark.text < SURGE)
        wraps = (mark.around and not free_place) or (most and (mark.placed or not free))
        by_tag.append((mark.parent >= 0 and by_tag[mark.parent]) or (mark.tag and not wraps))
        dropped.append((mark.parent >= 0 and dropped[mark.parent]) or not wraps)
    out = [i >= 0 and dropped[i] for i in in_marks]
    if all(gone or not n for gone, n in zip(out, texts, strict=True)):
        out = [i >= 0 and by_tag[i] for i in in_marks]  # names must be wrong where they leave nothing
    for line, gone in zip(lines, out, strict=True):
        line.kept = line.kept and not gone


def lines_of(page: str) -> list[Line]:
    """The lines of a page, also those that count as empty."""
    lines: list[Line] = []
    run: list[str] = []
    linked = 0
    open_tags: list[tuple[str, bool, bool, int]] = []  # name, whether it is boilerplate, whether it is marked, lines before it
    n_open: Counter = Counter()
    last_close: dict[str, int] = {}
    skipped = links = places = 0  # how many open elements are boilerplate, links, articles
    marks: list[Mark] = []
    in_marks: list[int] = []  # of each line
    mark, free_place = -1, False  # the innermost that is open; whether an article lies in none

    def end_line() -> None:
        nonlocal run, linked
        text = " ".join("".join(run).split())
        if text:
            lines.append(Line(text, linked, not skipped, places > 0))
            in_marks.append(mark)
        run, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        text = entities.unescape(text)
        run.append(text)
        if links:
            linked += len(text.strip())

    def pop() -> None:
        nonlocal skipped, links, places, mark
        name, boiler, marked, _ = open_tags.pop()
        n_open[name] -= 1
        if marked:
            mark = marks[mark].parent
        skipped -= boiler
        links -= name == "a"
        places -= name in _PLACE

    def closed_later(name: str, at: int) -> bool:
        if name not in last_close:
            last_close[name] = lowered.rfind(f"</{name}")
        return last_close[name] >= at

    at, last = 0, page.rfind(">")
    lowered = page.lower()
    if len(lowered) != len(page):  # a dotted capital I becomes two characters
        lowered = page.translate(_LOWER)
    while at < len(page):
        tag = page.find("<", at)
        if tag < 0:
            add(page[at:])
            break
        if tag > at:
            add(page[at:tag])
        after = page[tag + 1 : tag + 2]
        if after in ("!", "?"):
            if page.startswith("<!--", tag):
                end = page.find("-->", tag + 4)
                at = len(page) if end < 0 else end + 3
            else:
                end = page.find(">", tag)
                at = len(page) if end < 0 else end + 1
            continue
        closing = after == "/"
        if not (page[tag + 2 : tag + 3] if closing else after).isalpha():
            add("<")
            at = tag + 1
            continue
        if tag > last:
            break  # cut off inside a tag
        found = _TAG.match(page, tag) or _LOOSE_TAG.match(page, tag)
        if not found:
            add("<")
            at = tag + 1
            continue
        name, attributes, at = found[1].lower(), found[2], found.end()
        if name not in _INLINE and name not in _UNSEEN:
            end_line()
        if closing:
            if n_open[name]:
                while open_tags[-1][0] != name:
                    pop()
                if name not in _INLINE and open_tags[-1][3] == len(lines):
                    lines.append(Line("", 0, False, places > 0))
                    in_marks.append(mark)
                pop()
            continue
        if name in _RAW and not attributes.endswith("/"):
            end = lowered.find(f"</{name}", at) if closed_later(name, at) else -1
            close = -1 if end < 0 else page.find(">", end)
            at = len(page) if close < 0 else close + 1
            continue
        if name in _VOID or attributes.endswith("/"):
            continue
        if name in _PLACE:
            # Boilerplate that is never closed ends where the article begins.
            while (skipped or mark >= 0) and open_tags and not closed_later(open_tags[-1][0], at):
                pop()
        if name not in _INLINE and any(x[0] == "p" for x in open_tags[-3:]):
            while any(x[0] == "p" for x in open_tags[-3:]):
                pop()
        for implied in _CLOSES.get(name, ()):
            if open_tags and open_tags[-1][0] == implied:
                pop()
        boiler = _is_boilerplate(name, attributes)
        names = _names(attributes) if attributes and name not in _PLACE and name not in ("html", "body") else set()
        by_tag = name in _MAY_WRAP and not (name == "header" and places)
        if names or by_tag:
            marks.append(Mark(mark, not names.isdisjoint(_OF_PLACE), places > 0, by_tag))
            mark = len(marks) - 1
        elif name in _PLACE and not boiler and not skipped:
            if mark >= 0:
                marks[mark].around = True
            free_place = free_place or mark < 0
        open_tags.append((name, boiler, bool(names) or by_tag, len(lines)))
        n_open[name] += 1
        skipped += boiler
        links += name == "a"
        places += name in _PLACE
    end_line()
    _drop_marked(lines, marks, in_marks, free_place)
    return lines


def main_text(page: str, window: int = WINDOW, surge: int = SURGE, near: int = NEAR) -> str:
    lines = lines_of(page)
    sizes = np.array(
        [len(x.text) if x.kept and (x.placed or x.linked <= LINKS * len(x.text)) else 0 for x in lines], dtype=np.int64
    )
    if not sizes.any():
        return ""
    sums = np.convolve(sizes, np.ones(window, dtype=np.int64))[: len(sizes)]  # of a line and those before it
    full = np.concatenate([[False], sums > 0, [False]])
    begins, ends = np.flatnonzero(full[1:] & ~full[:-1]), np.flatnonzero(full[:-1] & ~full[1:])  # surges and dives
    peaks = np.array([sums[a:b].max() for a, b in zip(begins, ends, strict=True)])
    high = np.flatnonzero(peaks >= min(surge, int(peaks.max())))
    # Stretches from their first to their last line with text.
    last_text = np.array([a + np.flatnonzero(sizes[a:b])[-1] for a, b in zip(begins, ends, strict=True)])
    low, up = high[0], high[-1]
    placed = np.array([x.placed for x in lines])
    in_run = np.zeros(len(sizes), dtype=bool)
    for i in high:
        in_run[begins[i] : ends[i]] = True
    if 2 * sizes[in_run & placed].sum() >= sizes[in_run].sum():
        held = np.flatnonzero(placed & (sizes > 0))
        first, last = held[0], held[-1] + 1
    else:
        while low > 0 and begins[low] - last_text[low - 1] - 1 <= near:
            low -= 1
        while up + 1 < len(begins) and begins[up + 1] - last_text[up] - 1 <= near:
            up += 1
        first, last = begins[low], last_text[up] + 1
    return " ".join(x.text for x, n in zip(lines[first:last], sizes[first:last], strict=True) if n)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: its id and url, the main text and its number of characters."""
    ready_for_python(pages.sparkSession)

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    found = pages.select(F.col(id_col), F.col(url_col), texts(F.coalesce(F.col(html_col), F.lit(""))).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
