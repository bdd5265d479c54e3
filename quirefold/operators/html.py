"""HTML papers: verses by element id, with emphasis spans, and the floater rule.

A paper is a list of events; blocks are cut out of it by their ids, and what a block
says comes from passes over its own events, one for each rule of the format.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spans import Spans, collapse
from .tex import MarkupError, _rows, parsed

FILE = re.compile(r"Paper(\d{3,})\.html$")
#: The ids that name titles, sections and verses, and how titles are numbered.
_ID = re.compile(r"U(?P<paper>\d+)_(?P<section>\d+)_(?P<verse>\d+)(?P<floater>[A-Z]*)")
_TITLE_NUMBER = re.compile(r"Paper\s+\d+\.\s+")
_SECTION_NUMBER = re.compile(r"(?:(?P<first>\d+)\.\s+and\s+(?P<second>\d+)|\d+|[IVXLCDM]+)\.\s+(?P<title>.*)")
_OPENER = re.compile(r"(?:[A-Z]+\b ?)+")
BLOCKS = {"h1", "h2", "h3", "p"}


class Event(NamedTuple):
    """A start tag (+), an end tag (-) or text (empty sign)."""

    sign: str
    tag: str = ""
    text: str = ""
    id: str = ""
    classes: tuple[str, ...] = ()


class _Events(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[Event] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = dict(attrs)
        self.found.append(Event("+", tag, "", given.get("id") or "", tuple((given.get("class") or "").split())))

    def handle_endtag(self, tag: str) -> None:
        self.found.append(Event("-", tag))

    def handle_data(self, data: str) -> None:
        self.found.append(Event("", "", data))

    def updatepos(self, i: int, j: int) -> int:
        """Lines aren't counted, as no event tells its place."""
        return j


def events(src: str) -> list[Event]:
    reader = _Events()
    reader.feed(src)
    reader.close()
    return reader.found


def blocks(found: list[Event], paper: int) -> Iterator[tuple[str, re.Match, list[Event]]]:
    """(tag, id, inner events) of each block whose id belongs to the paper; an unclosed one is left out."""
    at = 0
    while at < len(found):
        e, at = found[at], at + 1
        m = _ID.fullmatch(e.id) if e.sign == "+" and e.tag in ("h1", "h2", "p") else None
        if m is None or int(m["paper"]) != paper:
            continue
        plain = m["verse"] == "0" and not m["floater"]
        if e.tag == "h1" and not (plain and m["section"] == "0") or e.tag == "h2" and not plain:
            continue
        begin, depth = at, 1
        while at < len(found) and depth:
            if found[at].tag in BLOCKS:
                depth += 1 if found[at].sign == "+" else -1
            at += 1
        if depth:
            return
        yield e.tag, m, found[begin : at - 1]


def shown(inner: list[Event], cited: bool) -> Iterator[Event]:
    """Without dot leaders and, if ``cited``, without small print before the first text."""
    at, started = 0, False
    while at < len(inner):
        e, at = inner[at], at + 1
        if e.sign == "+" and (e.tag == "span" and "dot" in e.classes or e.tag == "small" and cited and not started):
            depth = 1
            while at < len(inner) and depth:
                if inner[at].tag == e.tag:
                    depth += 1 if inner[at].sign == "+" else -1
                at += 1
            continue
        started = started or not e.sign and bool(e.text)
        yield e


def capitals(inner: Iterable[Event]) -> Iterator[Event]:
    """Small caps as capitals; any end of a span ends them."""
    caps = 0
    for e in inner:
        if e.tag == "span":
            caps = caps + ("scaps" in e.classes) if e.sign == "+" else max(0, caps - 1)
        elif not e.sign and caps:
            e = e._replace(text=e.text.upper())
        yield e


def marks(inner: Iterable[Event]) -> Iterator[Event]:
    """Raised numbers behind a caret, other raised text as it is."""
    held: list[Event] | None = None
    for e in inner:
        if e.tag == "sup" and e.sign == "+":
            yield from held or ()
            held = []
        elif e.tag == "sup" and held is not None:
            raised = "".join(x.text for x in held if not x.sign)
            yield from [Event("", text="^")] * raised.isdigit()
            yield from held
            held = None
        elif held is not None:
            held.append(e)
        else:
            yield e
    yield from held or ()


def spoken(inner: list[Event], cited: bool) -> tuple[str, Spans]:
    """A block's composed, collapsed text and its emphasis."""
    pieces, size, opened, spans = [], 0, [], []
    told, tags = shown(inner, cited), {e.tag for e in inner}
    if "span" in tags:
        told = capitals(told)
    if "sup" in tags:
        told = marks(told)
    for e in told:
        if not e.sign:
            pieces.append(e.text)
            size += len(e.text)
        elif e.tag == "em":
            if e.sign == "+":
                opened.append(size)
            elif opened:
                spans.append((opened.pop(), size))
    return collapse(unicodedata.normalize("NFC", "".join(pieces)), [x for x in spans if x[0] < x[1]])


def extract(src: str, number: int) -> dict:
    """Header, sections and verses of one paper; raises MarkupError."""
    title, sections, verses = None, [], []
    for tag, m, inner in blocks(events(src), number):
        text, spans = spoken(inner, tag == "p")
        section, verse = int(m["section"]), int(m["verse"])
        if tag == "h1":
            title = _TITLE_NUMBER.sub("", text, count=1) if _TITLE_NUMBER.match(text) else text
        elif tag == "p":
            text = plain_opener(text) if (section, verse) == (0, 1) else text
            verses.append(dict(section=section, verse=verse, text=text, italics=_rows(spans), macros_seen=[], floater=bool(m["floater"]), ord=len(verses)))
        else:
            n = _SECTION_NUMBER.match(text)
            pair = (int(n["first"]), int(n["second"])) if n and n["first"] else None
            if pair and section != pair[1]:
                raise MarkupError(f"combined section id {section} disagrees with title {text!r}")
            named = n["title"].strip() if n else text
            sections += [dict(n=k, title=named, combined=pair is not None, combined_with=sum(pair) - k if pair else None) for k in pair or (section,)]
    return dict(title=title, subtitle=None, author=None, sections=sections, verses=verses)


def plain_opener(text: str) -> str:
    """The run of capitals that opens a paper, as a sentence is written: first word capitalized, the rest lower case."""
    m = _OPENER.match(text)
    if m is None:
        return text
    first, gap, rest = m[0].partition(" ")
    return first.capitalize() + gap + rest.lower() + text[m.end() :]


def html_papers(files: DataFrame) -> DataFrame:
    """One row per (path, src) file, schema PAPER, before the floater rule."""
    return parsed(files, extract, FILE)


def drop_floaters(verses: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Floating paragraphs go where a plain one has the same key; without one they stay."""
    keys = keys or ["paper", "section", "verse"]
    plain = F.bool_or(~F.col("floater")).over(Window.partitionBy(*keys))
    return verses.withColumn("__plain", plain).where(~(F.col("floater") & F.col("__plain"))).drop("__plain")
