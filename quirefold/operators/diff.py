"""Comparison of two editions: keyed full outer joins, an allow-list, and mismatches as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.files import headers_of, sections_of, verses_of
from ..sources.scratch import stored

MISMATCH = ["paper", "kind", "section", "verse", "detail", "left", "right"]
KEY = ["paper", "section", "verse"]


def _mismatch(df: DataFrame, kind: str, detail, section="section", verse="verse", left=None, right=None) -> DataFrame:
    as_col = lambda x, t: F.lit(None).cast(t) if x is None else (F.col(x) if isinstance(x, str) else x).cast(t)
    return df.select("paper", F.lit(kind).alias("kind"), as_col(section, "int").alias("section"), as_col(verse, "int").alias("verse"), F.lit(detail).alias("detail") if isinstance(detail, str) else detail.alias("detail"), as_col(left, "string").alias("left"), as_col(right, "string").alias("right"))


def remap_combined(verses: DataFrame, sections: DataFrame) -> DataFrame:
    """Verses under either number of a combined section go under the higher one."""
    to = sections.where("combined and combined_with is not null").groupBy("paper", F.col("n").alias("section")).agg(F.max(F.greatest("n", "combined_with")).alias("__to"))
    return verses.join(to, ["paper", "section"], "left").withColumn("section", F.coalesce("__to", "section")).drop("__to").select(verses.columns)


def remapped(papers: DataFrame) -> DataFrame:
    """The verses of papers as ``remap_combined`` gives them; where each paper has one row its own sections are enough, and no verse is moved."""
    verses = verses_of(papers)
    if not papers.groupBy("paper").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return remap_combined(verses, sections_of(papers))
    pairs = F.filter("sections", lambda s: s["combined"] & s["combined_with"].isNotNull()).alias("__pairs")
    own = papers.select("paper", pairs, F.explode("verses").alias("v")).select("paper", "__pairs", "v.*")
    to = F.array_max(F.transform(F.filter("__pairs", lambda s: s["n"] == F.col("section")), lambda s: F.greatest(s["n"], s["combined_with"])))
    return own.withColumn("section", F.coalesce(to, "section")).select(verses.columns)


def last_wins(verses: DataFrame, order: str = "ord", keys: list[str] | None = None) -> DataFrame:
    """The last row of each key, with ``repeats``: how many rows before it had the key."""
    keys = keys or KEY
    rest = [c for c in verses.columns if c not in keys]
    return verses.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__v"), (F.count("*") - 1).alias("repeats")).select(*keys, "__v.*", "repeats")


def compare_verses(left: DataFrame, right: DataFrame, deviations: DataFrame) -> DataFrame:
    """One row per key of either side with ``status``: only_left, only_right, text, italic, same; and skip.

    Sides must have one row per key.  Spans are compared only where texts agree.  Sides
    that are equal as they are need no normalizing; ``nl`` and ``nr`` hold the normalized
    sides of the others.
    """
    both = left.select(*KEY, F.struct("text", "italics").alias("l")).join(right.select(*KEY, F.struct("text", "italics").alias("r")), KEY, "full_outer")
    marked = both.join(deviations.select(*KEY, "skip", "ignore_italics"), KEY, "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("skip", "ignore_italics")]
    equal = F.col("l.text").eqNullSafe(F.col("r.text")) & F.col("l.italics").eqNullSafe(F.col("r.italics")) & F.col("l").isNotNull() & F.col("r").isNotNull()
    clean = lambda c: tx.normalize_both(F.col(f"{c}.text"), F.col(f"{c}.italics"), ~F.col("__equal") & F.col(c).isNotNull())
    n = marked.select(*KEY, "l", "r", *flags, equal.alias("__equal")).withColumn("nl", clean("l")).withColumn("nr", clean("r"))
    status = (
        F.when(F.col("r").isNull(), "only_left")
        .when(F.col("l").isNull(), "only_right")
        .when(F.col("__equal"), "same")
        .when(~F.col("nl.text").eqNullSafe(F.col("nr.text")), "text")
        .when(~F.col("ignore_italics") & ~F.col("nl.italics").eqNullSafe(F.col("nr.italics")), "italic")
        .otherwise("same")
    )
    return n.select(*KEY, "skip", status.alias("status"), "nl", "nr", F.col("l.text").alias("left_raw"), F.col("r.text").alias("right_raw"))


def reported(compared: DataFrame) -> DataFrame:
    """``compare_verses``' rows with the texts that something is said of, the others null: normalized ones of findings, raw ones that hold an odd glyph."""
    found = F.expr("not skip and status <> 'same'")
    odd = lambda c: F.when(F.expr("not skip and status not in ('only_left', 'only_right')") & F.col(c).rlike(tx.ODD_GLYPHS), F.col(c))
    return compared.select(*KEY, "skip", "status", F.when(found, F.col("nl")).alias("nl"), F.when(found, F.col("nr")).alias("nr"), odd("left_raw").alias("left_raw"), odd("right_raw").alias("right_raw"))


def compare_titles(left: DataFrame, right: DataFrame) -> DataFrame:
    """PAPER_TITLE mismatches: titles as they are, none counts as empty."""
    j = left.select("paper", F.coalesce("title", F.lit("")).alias("a")).join(right.select("paper", F.coalesce("title", F.lit("")).alias("b")), "paper").where("a <> b")
    return _mismatch(j, "PAPER_TITLE", "paper titles differ", None, None, "a", "b")


def compare_sections(left: DataFrame, right: DataFrame) -> DataFrame:
    """SECTION_TITLE mismatches: a missing side, or normalized titles that differ; a repeated number's last title holds."""
    side = lambda df, c: df.groupBy("paper", "n").agg(F.max_by("title", "pos").alias(c), F.lit(True).alias(f"has_{c}"))
    j = side(left, "a").join(side(right, "b"), ["paper", "n"], "full_outer")
    detail = F.when(F.col("has_a").isNull(), "missing on the left").when(F.col("has_b").isNull(), "missing on the right").otherwise("titles differ")
    # normalize what differs as it is
    bad = F.col("has_a").isNull() | F.col("has_b").isNull() | ~tx.normalize(F.col("a")).eqNullSafe(tx.normalize(F.col("b")))
    return _mismatch(j.where(~F.col("a").eqNullSafe(F.col("b")) | F.col("has_a").isNull() | F.col("has_b").isNull()).where(bad).withColumn("section", F.col("n")), "SECTION_TITLE", detail, verse=None, left="a", right="b")


def mismatches(left_heads: DataFrame, right_heads: DataFrame, left_sections: DataFrame, right_sections: DataFrame, left_keyed: DataFrame, right_keyed: DataFrame, compared: DataFrame) -> DataFrame:
    """The bag of all findings, schema MISMATCH."""
    out = compare_titles(left_heads, right_heads).unionByName(compare_sections(left_sections, right_sections))
    for keyed, side in ((left_keyed, "left"), (right_keyed, "right")):
        repeated = keyed.where("repeats > 0").withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
        out = out.unionByName(_mismatch(repeated, "STRUCT", f"duplicate key on the {side}"))
    told = compared.where("not skip and status <> 'same'")
    kind = F.when(F.col("status") == "text", "TEXT").when(F.col("status") == "italic", "ITALIC").otherwise("STRUCT")
    rows = told.select("paper", kind.alias("kind"), "section", "verse", F.col("status").alias("detail"), F.col("nl.text").alias("left"), F.col("nr.text").alias("right"))
    return out.unionByName(rows)


def glyph_log(compared: DataFrame) -> DataFrame:
    """(paper, section, verse, side, glyph, n) of suspicious glyphs in common verses that aren't skipped."""
    common = compared.where("not skip and status not in ('only_left', 'only_right')")
    sides = common.select(*KEY, F.explode(F.array(F.struct(F.lit("left").alias("side"), F.col("left_raw").alias("t")), F.struct(F.lit("right").alias("side"), F.col("right_raw").alias("t")))).alias("x"))
    return sides.select(*KEY, "x.side", F.explode(tx.suspicious(F.col("x.t"))).alias("glyph", "n"))


def text_changes(compared: DataFrame) -> DataFrame:
    """Character edits of the differing verses only."""
    rows = compared.where("not skip and status = 'text'")
    return rows.select(*KEY, F.explode(tx.changes(F.col("nl.text"), F.col("nr.text"))).alias("c")).select(*KEY, "c.*")


class Comparison:
    """All tables of one comparison of extracted papers (schema PAPER on both sides).

    What is parsed and what is compared is written once to the shared folder, as several tables are made of it.
    Of what was compared, only texts that are reported are written (``reported``).
    """

    def __init__(self, left: DataFrame, right: DataFrame, deviations: DataFrame) -> None:
        from .html import drop_floaters

        self._seen = {side: Observation(f"{side}-papers") for side in ("left", "right")}
        left, right = (stored(df.observe(self._seen[side], F.count("*").alias("papers"), F.count_if(F.col("error").isNotNull()).alias("broken"), F.sum(F.size("verses")).alias("verses")), f"{side}-papers") for side, df in (("left", left), ("right", right)))
        self.left_heads, self.right_heads = headers_of(left), headers_of(right)
        self.left_sections, self.right_sections = sections_of(left), sections_of(right)
        self.left_verses = remapped(left)
        self.right_verses = drop_floaters(verses_of(right))
        self.left_keyed, self.right_keyed = last_wins(self.left_verses), last_wins(self.right_verses)
        self.compared = stored(reported(compare_verses(self.left_keyed, self.right_keyed, deviations)), "compared")
        self.mismatches = mismatches(self.left_heads, self.right_heads, self.left_sections, self.right_sections, self.left_keyed, self.right_keyed, self.compared)

    def observed(self) -> dict[str, dict[str, int]]:
        """Papers, papers that couldn't be parsed and verses of each side, as counted while they were written."""
        return {side: {k: v or 0 for k, v in seen.get.items()} for side, seen in self._seen.items()}

    def errors(self) -> DataFrame:
        """Papers that couldn't be parsed, by side."""
        side = lambda df, s: df.where("error is not null").select("paper", F.lit(s).alias("side"), "error")
        return side(self.left_heads, "left").unionByName(side(self.right_heads, "right"))

    def limited(self, kind: str, n: int = 50) -> DataFrame:
        """The first n findings of a kind in each paper, for reports."""
        w = Window.partitionBy("paper").orderBy("section", "verse")
        return self.mismatches.where(F.col("kind") == kind).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")
