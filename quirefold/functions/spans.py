"""Half-open spans over text, and texts rewritten together with their spans."""

from __future__ import annotations

import re
import unicodedata
from itertools import accumulate

#: Fixed value: every character that counts as white space, for Java, Python (as ``str.isspace`` has it) and (with braces) RE2 alike.
SPACE = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
#: Glyphs that normalization replaces, with the names under which they are counted.
SUSPICIOUS = {"\u00a0": "NBSP", "\u202f": "NARROW_NBSP", "\u2009": "THIN_SPACE", "\u02bc": "MODIFIER_APOSTROPHE"}
GLYPHS = str.maketrans({"\u02bc": "\u2019", "\u00a0": " ", "\u202f": " ", "\u2009": " "})

_typed = re.compile(r"-{2,3}|[~$]")
_typeset = {"---": "\u2014", "--": "\u2013", "~": " ", "$": ""}

Spans = list[tuple[int, int]]


def merge(spans: Spans) -> Spans:
    """Sorted spans with those that touch or overlap joined."""
    out: Spans = []
    for s, e in sorted(spans):
        if out and out[-1][1] >= s:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _typed_places(text: str, places: list[int]) -> dict[int, int]:
    """Where each of the sorted places lands in the typeset text; one within a match lands where its replacement begins."""
    out, shift, matches = {}, 0, _typed.finditer(text)
    m = next(matches, None)
    for p in places:
        while m is not None and m.end() <= p:
            shift += len(_typeset[m[0]]) - (m.end() - m.start())
            m = next(matches, None)
        out[p] = (m.start() if m is not None and m.start() < p else p) + shift
    return out


def _collapsed_places(text: str, places: list[int], most: int) -> dict[int, int]:
    """Where each of the sorted places lands in the collapsed text of length ``most``: behind what the text before it keeps."""
    out, done, size, blank = {}, 0, 0, True
    for p in places:
        piece, done = text[done:p], p
        if blank:
            piece = piece.lstrip()
        if piece:
            kept = " ".join(piece.split())
            blank = piece[-1].isspace()
            size += len(kept) + (bool(kept) and piece[0].isspace()) + blank
        out[p] = min(size, most)
    return out


def _places(text: str, spans: Spans) -> list[int]:
    return sorted({min(max(p, 0), len(text)) for x in spans for p in x})


def _moved(spans: Spans, end: int, where: dict[int, int]) -> Spans:
    """Spans moved to where their places land; those that vanish go, those that now touch join."""
    moved = ((where[min(max(s, 0), end)], where[min(max(e, 0), end)]) for s, e in spans)
    return merge([x for x in moved if x[0] < x[1]])


def collapse(text: str, spans: Spans) -> tuple[str, Spans]:
    """White-space runs become one space, none at the ends.

    Of a run that becomes a space, the first character lands before it and further ones
    behind it.  Only the spans' own places are followed.
    """
    out = " ".join(text.split())
    return out, _moved(spans, len(text), _collapsed_places(text, _places(text, spans), len(out))) if spans else []


def typeset(text: str, spans: Spans) -> tuple[str, Spans]:
    """Typed dashes, ties and math marks as printed, then collapsed."""
    printed = text
    for typed, sign in _typeset.items():
        printed = printed.replace(typed, sign)
    out = " ".join(printed.split())
    if not spans:
        return out, []
    first = _typed_places(text, _places(text, spans))
    second = _collapsed_places(printed, sorted(set(first.values())), len(out))
    return out, _moved(spans, len(text), {p: second[w] for p, w in first.items()})


def normalize(text: str, spans: Spans) -> tuple[str, Spans]:
    """Composed characters, plain glyphs, collapsed white space; spans index the composed text."""
    return collapse(unicodedata.normalize("NFC", text).translate(GLYPHS), spans)


class Runs:
    """Text built from runs that are italic or not; spans come from the runs' sizes."""

    def __init__(self) -> None:
        self.runs: list[tuple[str, bool]] = []

    def add(self, text: str, italic: bool = False) -> None:
        if text:
            self.runs.append((text, italic))

    def text(self) -> str:
        return "".join(t for t, _ in self.runs)

    def spans(self) -> Spans:
        ends = list(accumulate(len(t) for t, _ in self.runs))
        return merge([(e - len(t), e) for (t, italic), e in zip(self.runs, ends, strict=True) if italic])
