"""Checks of the checker: recounts, determinism, mutants, samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .html import html_papers
from .tex import tex_papers


def recount(tex_files: DataFrame, html_files: DataFrame, tex: DataFrame, html: DataFrame) -> DataFrame:
    """Verses extracted against independent counts by pattern; ``ok`` if they agree.

    The markup may hold more verses than markers (poetic lines), the other side
    exactly its distinct ids, floaters dropped.
    """
    number = F.regexp_extract("path", r"(\d{3,})\.\w+$", 1).cast("int").alias("paper")
    marks = tex_files.select(number, F.regexp_count("src", F.lit(r"\\vs p\d+ \d+:\d+")).alias("markers"))
    ids = html_files.select(number, F.explode(F.regexp_extract_all("src", F.lit(r'<p[^>]*\bid="U(\d+_\d+_\d+)[A-Z]*"'), F.lit(1))).alias("id"))
    # only the paper's own ids
    ids = ids.where(F.split("id", "_")[0].cast("int") == F.col("paper")).groupBy("paper").agg(F.countDistinct("id").alias("ids"))
    size = lambda df, c, *more: df.groupBy("paper").agg(F.count("*").alias(c), *more)
    keys = F.countDistinct("section", "verse").alias("keys")
    out = marks.join(size(tex, "tex_verses"), "paper", "left").join(ids, "paper", "left").join(size(html, "html_verses", keys), "paper", "left").na.fill(0)
    # a verse extracted twice doesn't make up for one that was lost
    return out.withColumn("ok", (F.col("tex_verses") >= F.col("markers")) & (F.col("html_verses") == F.col("ids")) & (F.col("keys") == F.col("ids"))).drop("keys")


def digest(df: DataFrame) -> str:
    """A digest of all rows, whatever their order: row digests are added up in groups by their first byte."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    number = lambda at: F.sum(F.conv(F.substring("d", at, 14), 16, 10).cast("long").cast("decimal(38,0)"))
    # each task adds up its own rows, so that only sums are moved
    part = df.select(row.alias("d")).groupBy(F.substring("d", 1, 2).alias("p")).agg(number(3).alias("a"), number(17).alias("b"))
    return part.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "p", "a", "b"))), ""), 256)).first()[0]


def verse_totals(verses: DataFrame) -> DataFrame:
    """One row: how many verses there are, and how many spans they hold together."""
    return verses.agg(F.count("*").alias("verses"), F.coalesce(F.sum(F.size("italics")), F.lit(0)).alias("spans"))


def paper_digests(verses: DataFrame) -> DataFrame:
    """(paper, verses, digest): a digest of each paper over those of its sections, and of those over their verses.

    A verse is told by its key, text and spans; within a section verses go by number and
    digest.  Two runs' tables differ in exactly the papers that differ.
    """
    spans = F.array_join(F.transform("italics", lambda x: F.concat_ws("-", x["s"].cast("string"), x["e"].cast("string"))), " ")
    each = verses.select("paper", "section", "verse", F.sha2(F.concat_ws("|", "paper", "section", "verse", "text", spans), 256).alias("d"))
    joined = lambda *by: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*by, "d"))), lambda x: x["d"]), ""), 256)
    sections = each.groupBy("paper", "section").agg(F.count("*").alias("n"), joined("verse").alias("d"))
    return sections.groupBy("paper").agg(F.sum("n").alias("verses"), joined("section").alias("digest"))


def changed_papers(before: DataFrame, after: DataFrame) -> DataFrame:
    """(paper, change) of the papers whose digests differ between two runs: changed, gone or new."""
    both = before.select("paper", F.col("digest").alias("a")).join(after.select("paper", F.col("digest").alias("b")), "paper", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("paper", F.when(F.col("b").isNull(), "gone").when(F.col("a").isNull(), "new").otherwise("changed").alias("change"))


def deterministic(make: Callable[[], DataFrame]) -> bool:
    """Whether two runs give the same rows."""
    return digest(make()) == digest(make())


#: Deliberate damage to a paper's source: name, side, what is matched (once a paper), what replaces it.
DAMAGE = [
    ("double_word", "tex", r"(?s)(\\vs p\d+ \d+:\d+ (?:\\pc )?)([\p{L}\p{N}]+)", "$1$2 $2"),
    ("lose_verse", "tex", r"(?m)^\\vs p\d+ [^\n]*$", ""),
    ("shift_number", "tex", r"(\\vs p\d+ \d+:\d+)", "$17"),
    ("comma_to_dot", "tex", r"(\\vs p\d+ \d+:\d+ [^,\n]*),", "$1."),
    ("lose_sentence", "tex", r"(\\vs p\d+ \d+:\d+ [^.\n]*\.) [^.\n]+\.", "$1"),
    ("mark_word", "tex", r"(?s)(\\vs p\d+ \d+:\d+ (?:\\pc )?)([\p{L}\p{N}]+)", "$1\\\\bibemph{$2}"),
    ("cut_letter", "html", r"(?s)(<p id=\"U\d+_\d+_\d+\">(?:<small>[^<]*</small>)?[\p{L}\p{N}]*)[\p{L}\p{N}]", "$1"),
    ("unmark_word", "html", r"(?s)<em>(.*?)</em>", "$1"),
]


def mutation_check(tex_files: DataFrame, html_files: DataFrame) -> DataFrame:
    """(paper, mutant, caught): each damage that applies to a paper must change what the comparison finds there.

    Only papers whose two sides agree undamaged are judged.  All papers and mutants are
    extracted and compared in one job; a mutant is a source like any other.
    """

    def damaged(name: str, pattern: str, new: str) -> Column:
        # once: what comes before the first match, the match replaced, and the rest as it was; null where nothing matches
        found = F.regexp_extract("src", pattern, 0)
        at = F.regexp_instr("src", F.lit(pattern))
        text = F.concat(F.expr("substring(src, 1, greatest(__at - 1, 0))"), F.regexp_replace("__found", pattern, new), F.expr("substring(src, __at + char_length(__found))"))
        return files.withColumns({"__at": at, "__found": found}).where("__at > 0").select(F.lit(name).alias("mutant"), "path", text.alias("src"))

    # a verse is known by its digest, so that papers meet by 32 bytes a verse; each source is parsed once
    verse = lambda v: F.unhex(F.sha2(F.to_json(F.struct(v["section"].alias("s"), v["verse"].alias("v"), v["text"].alias("t"), v["italics"].alias("i"))), 256))
    none = F.array(F.unhex(F.sha2(F.lit("none"), 256)))
    sides = {}
    for side, source, parse in (("tex", tex_files, tex_papers), ("html", html_files, html_papers)):
        files = stored(source.select("path", "src"), f"{side}-files")
        made = files.select(F.lit("").alias("mutant"), "path", "src")
        for name, own, pattern, new in DAMAGE:
            if own == side:
                made = made.unionByName(damaged(name, pattern, new))
        papers = parse(made.select(F.concat_ws("/", "mutant", "path").alias("path"), "src"))
        verses = papers.select(F.regexp_extract("path", r"^(\w*)/", 1).alias("mutant"), "paper", F.when(F.size("verses") > 0, F.transform("verses", verse)).otherwise(none).alias("v"))
        sides[side] = stored(verses.groupBy("mutant", "paper").agg(F.sha2(F.array_join(F.transform(F.sort_array(F.flatten(F.collect_list("v"))), F.hex), ""), 256).alias("all")), f"{side}-digests")
    both = sides["tex"].select("paper", "mutant", F.col("all").alias("left")), sides["html"].select("paper", "mutant", F.col("all").alias("right"))
    plain = both[0].where("mutant = ''").drop("mutant").join(both[1].where("mutant = ''").drop("mutant"), "paper").where("left = right")
    found = [both[k].where("mutant <> ''").toDF("paper", "mutant", "damaged").join(plain.select("paper", F.col(side).alias("other")), "paper") for k, side in ((0, "right"), (1, "left"))]
    return found[0].unionByName(found[1]).select("paper", "mutant", (~F.col("damaged").eqNullSafe(F.col("other"))).alias("caught"))


def sample_keys(verses: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n verse keys drawn by a seeded hash, in key order; the same rows on every run and partitioning."""
    keys = verses.select("paper", "section", "verse").distinct()
    return keys.orderBy(F.md5(F.concat_ws(":", F.lit(seed), "paper", "section", "verse")), "paper", "section", "verse").limit(n).orderBy("paper", "section", "verse")


def spot_check(left: DataFrame, right: DataFrame, n: int = 20, seed: int = 42, *, sample: DataFrame | None = None) -> DataFrame:
    """Both sides' texts of sampled verses, at most 300 characters, for a reader; of ``sample``'s verses, if it was drawn before."""
    keys = ["paper", "section", "verse"]
    # the sample has n rows, so it's sent to both sides, and only its verses' texts are moved
    s = F.broadcast(stored(sample_keys(left, n, seed), "sample") if sample is None else sample)
    show = lambda df, c: df.join(s, keys, "left_semi").groupBy(*keys).agg(F.first(F.substring("text", 1, 300)).alias(c))
    out = s.join(show(left, "left_text"), keys, "left").join(show(right, "right_text"), keys, "left")
    return out.na.fill("(missing)").orderBy(*keys)
