"""Column functions: built-ins wherever they exist, one Arrow function for composed text with spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SPANS
from . import spans as sp
from .edits import edits

#: Types as objects: a type written as text needs a session, which importing this module must not.
_SPANS = T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))
_CLEAN = T.StructType([T.StructField("text", T.StringType()), T.StructField("italics", _SPANS)])
_CHANGES = T.ArrayType(T.StructType([T.StructField("tag", T.StringType()), *(T.StructField(c, T.IntegerType()) for c in ("i1", "i2", "j1", "j2")), *(T.StructField(c, T.StringType()) for c in ("before", "left", "right", "after"))]))


def _ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def is_loose(c: Column) -> Column:
    """Whether collapsing white space changes a text; null for null.

    Spaces are looked for byte by byte, which is many times faster than a pattern.
    """
    other = F.when(_ascii(c), c.rlike("[\\t-\\r\\x1c-\\x1f]")).otherwise(c.rlike(sp.SPACE.replace("\\x20", "\\x1f")))
    return c.contains("  ") | c.startswith(" ") | c.endswith(" ") | other


def collapse(c: Column) -> Column:
    """White-space runs as one space, trimmed; text without any to collapse stays as it is."""
    return F.when(is_loose(c), F.trim(F.regexp_replace(c, f"{sp.SPACE}+", " "))).otherwise(c)


def typeset(c: Column) -> Column:
    """Typed dashes, ties and math marks as printed, then collapsed."""
    for old, new in (("---", "\u2014"), ("--", "\u2013"), ("~", " "), ("$", "")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return collapse(c)


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonically composed text; Spark has no built-in for it."""
    return s.str.normalize("NFC")


def plain_glyphs(c: Column) -> Column:
    for glyph, plain in sp.GLYPHS.items():
        c = F.replace(c, F.lit(chr(glyph)), F.lit(plain))
    return c


#: Code points that composition leaves alone in any text made of them: none is a mark, none is part of a longer composition.
COMPOSED = "\\x{0}-\\x{2ff}\\x{400}-\\x{482}\\x{48a}-\\x{52f}\\x{2002}-\\x{206f}\\x{20a0}-\\x{20bf}\\x{3041}-\\x{3096}\\x{30a1}-\\x{30fa}\\x{4e00}-\\x{9fff}"


def is_composed(c: Column) -> Column:
    """Whether a text is surely composed already, told in the JVM; null is.

    ASCII is told by its sizes.  Letters up to U+02FF, all composed, go first: a class of one range is passed over many times faster than one of many.
    """
    rest = F.regexp_replace(c, "[\\x{0}-\\x{2ff}]+", "")
    return F.when(_ascii(c), True).otherwise(F.coalesce(~rest.rlike(f"[^{COMPOSED}]"), F.lit(True)))


def normalize(c: Column) -> Column:
    """Composed, plain glyphs, collapsed: the text compared between editions.

    Only text that may not be composed yet goes to Python, the rest as a null.
    """
    return collapse(plain_glyphs(F.coalesce(nfc(F.when(~is_composed(c), c)), c)))


def collapse_spans(text: Column, spans: Column) -> Column:
    """Spans of ``text`` where collapsing its white space moves them, JVM-side: those that vanish go, those that touch join.

    A place moves to as many characters as what lies before it keeps.
    """
    size = F.length(collapse(text))
    before = lambda p: F.length(F.regexp_replace(F.regexp_replace(F.substring(text, F.lit(1), p), f"^{sp.SPACE}+", ""), f"{sp.SPACE}+", " "))
    inside = lambda p: F.greatest(F.least(p, F.length(text)), F.lit(0))
    return _moved(spans, lambda p: F.least(before(inside(p)), size))


def _moved(spans: Column, to: Callable[[Column], Column]) -> Column:
    moved = F.transform(spans, lambda x: F.struct(to(x["s"]).cast("int").alias("s"), to(x["e"]).cast("int").alias("e")))
    return merge_spans(F.filter(moved, lambda x: x["s"] < x["e"]))


def _collapsed(text: Column, italics: Column) -> Column:
    """struct(text, italics) with white space collapsed; places are looked for only where it changes the text."""
    none = F.expr(f"cast(array() as {SPANS})")
    inside = lambda p: F.greatest(F.least(p, F.length(text)), F.lit(0))
    spans = F.when(is_loose(text), collapse_spans(text, italics)).otherwise(_moved(italics, inside))
    return F.struct(collapse(text).alias("text"), F.when(text.isNotNull() & (F.size(italics) > 0), spans).otherwise(none).alias("italics"))


@F.pandas_udf(_CLEAN)
def _normalized(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for text, places in batches:
        rows = []
        for t, it in zip(text, places, strict=True):
            if t is None:
                rows.append((None, []))
                continue
            at = [int(p) for p in (it or "").split()]
            t, it = sp.normalize(t, list(zip(at[::2], at[1::2], strict=True)))
            rows.append((t, [{"s": s, "e": e} for s, e in it]))
        yield pd.DataFrame(rows, columns=["text", "italics"])


def normalize_spans(text: Column, italics: Column) -> Column:
    """Normalized text with its spans; null text is null, null spans are none.

    Spans go to Python as text: Spark tells the size of a batch anew at each row, and for
    a column of arrays that takes as long as the batch has rows so far.
    """
    return _normalized(text, F.array_join(F.transform(italics, lambda x: F.concat_ws(" ", x["s"].cast("string"), x["e"].cast("string"))), " "))


def normalize_both(text: Column, italics: Column, needed: Column) -> Column:
    """struct(text, italics) as ``normalize_spans`` gives it where ``needed``, null elsewhere; composed text stays in the JVM, with its spans."""
    # text that isn't needed is null from here on, so nothing is looked for in it
    text = F.when(needed, text)
    composed = is_composed(text)
    mixed = normalize_spans(F.when(~composed, text), F.when(~composed, italics))
    # an array of one, so that the glyphs are replaced once
    own = F.transform(F.array(plain_glyphs(text)), lambda t: _collapsed(t, italics))[0]
    return F.when(needed & composed, own).when(needed, mixed)


#: Pattern: any of the suspicious glyphs.
ODD_GLYPHS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in sp.SUSPICIOUS) + "]"


def suspicious(c: Column) -> Column:
    """map of glyph name to count, only those that occur."""
    pairs = [F.struct(F.lit(name).alias("key"), (F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))).alias("value")) for ch, name in sp.SUSPICIOUS.items()]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda x: x["value"] > 0))


def merge_spans(c: Column) -> Column:
    """Touching or overlapping spans joined, JVM-side."""
    empty = F.expr(f"cast(array() as {SPANS})")

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["e"] >= x["s"]), joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(c), empty, step)


def shift_spans(c: Column, by: Column) -> Column:
    return F.transform(c, lambda x: F.struct((x["s"] + by).cast("int").alias("s"), (x["e"] + by).cast("int").alias("e")))


@F.pandas_udf(_CHANGES)
def changes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Character edits from a to b with 20 characters of context; use on differing rows only."""
    out = []
    for x, y in zip(a, b, strict=True):
        if x is None or y is None:
            out.append(None)
            continue
        out.append([dict(tag=t, i1=i1, i2=i2, j1=j1, j2=j2, before=x[max(0, i1 - 20) : i1], left=x[i1:i2], right=y[j1:j2], after=x[i2 : i2 + 20]) for t, i1, i2, j1, j2 in edits(x, y)])
    return pd.Series(out)


def half_even(c: Column) -> Column:
    """Rounded to an integer, halves to even."""
    return F.rint(c).cast("int")


#: Marks the lines that open a list right behind a verse marker and lack the paragraph mark.
LIST_OPENERS = r"(?m)^(?![ \t]*\\pc\b)(?=.*\\vs.*\\ublistelem\{1\.\})"


def mark_list_openers(c: Column) -> tuple[Column, Column]:
    """(text with the paragraph mark put before each list opener, how many were put)."""
    return F.regexp_replace(c, LIST_OPENERS, r"\\pc "), F.regexp_count(c, F.lit(LIST_OPENERS))
