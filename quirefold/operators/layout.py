"""Page geometry: lines rebuilt from word boxes, and findings on columns, orphans and gaps.

Input tables: words (schema WORD), native lines (doc, page, ord, text, box), text
layouts (doc, page, n_lines, line_no, line).  What belongs to a page is grouped or
windowed by page; what runs on over the pages of a document is added up by ranges of
its lines (``ordered.running``), so a document of any length is dealt out to many
tasks.  Nothing leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.suffixes import endings
from ..functions.text import half_even
from ..sources.scratch import stored
from .ordered import running

# Fixed values of the page design.
BODY = (9.6, 10.3)
BODY_WIDE = 10.6
SPLIT = 231.0
MIDDLE = 240.0
BAND = (50, 660)
MARGIN_Y = 625
FLUSH, PARAGRAPH_GAP = 6.0, 16
GUTTER, GUTTER_WORDS = 4.0, 3
FULL_BOTTOM, NORMAL_TOP, LINE_PT = 623.0, 67.0, 11
UNEVEN = 5


def is_body(h: Column, high: float = BODY[1]) -> Column:
    return (h > BODY[0]) & (h < high)


def _texts(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: w["text"]), " ")


def _in_band(words: DataFrame) -> DataFrame:
    """Words with text between the head and the foot of a page, and their rounded baseline."""
    return words.where(F.trim("text") != "").withColumn("y", half_even(F.col("yMax"))).where(F.col("y").between(BAND[0] + 1, BAND[1] - 1))


def _apart(x_max: Column, x_min: Column, next_min: Column, next_max: Column) -> Column:
    """Whether the gutter lies between a word and the next of its line."""
    return F.coalesce((next_min - x_max > 12) & (x_min < MIDDLE) & (next_max > 245), F.lit(False))


def _across(gapped: Column) -> Column:
    """Whether a line of ``x_min`` to ``x_max`` is a title: across both columns, within their outer edges, without a gap at the gutter."""
    return (F.col("x_min") < 220) & (F.col("x_max") > 260) & ~gapped & (F.col("x_min") > 80) & (F.col("x_max") < 390)


def page_lines(words: DataFrame) -> DataFrame:
    """Words of equal rounded baseline as lines, with both column sides and what titles are told by."""
    ok = _in_band(words)
    seq = F.struct("flow", "block", "line", "word")
    w = F.struct("xMin", seq.alias("seq"), "xMax", (F.col("yMax") - F.col("yMin")).alias("h"), "text")
    lines = ok.groupBy("doc", "page", "y").agg(F.array_sort(F.collect_list(w)).alias("ws"), F.min(seq).alias("first"), F.min("xMin").alias("x_min"), F.max("xMax").alias("x_max"))
    n = F.size("ws")
    gaps = F.zip_with(F.slice("ws", 1, n - 1), F.slice("ws", 2, n), lambda a, b: _apart(a["xMax"], a["xMin"], b["xMin"], b["xMax"]))
    across = _across(F.exists(gaps, lambda g: g))
    left, right = F.filter("ws", lambda x: x["xMin"] < SPLIT), F.filter("ws", lambda x: x["xMin"] > SPLIT)
    return lines.select("doc", "page", "y", "first", "ws", "x_min", "x_max", across.alias("is_title"), left.alias("left"), right.alias("right"))


def column_ends(words: DataFrame, texts: bool = True) -> DataFrame:
    """(doc, section, page, l, r): the last line of either column (y, text), of the sections that have both on a page.

    A page's lines are gathered up to its next title; only what a run of lines ends with,
    not the lines, is put in order over a document's pages.  Without ``texts`` they are empty.
    """
    title = F.col("is_title") & (F.col("x_max") - F.col("x_min") > 100)
    body = lambda side: F.when(F.exists(side, lambda x: is_body(x["h"])) & ~title, F.struct("y", (_texts(F.col(side)) if texts else F.lit("")).alias("text")))
    page = Window.partitionBy("doc", "page").orderBy("y").rowsBetween(Window.unboundedPreceding, 0)
    lines = page_lines(words).select("doc", "page", "y", title.alias("title"), body("left").alias("l"), body("right").alias("r"))
    runs = lines.withColumn("place", F.sum(F.col("title").cast("int")).over(page)).groupBy("doc", "page", "place").agg(F.count(F.when(F.col("title"), 1)).alias("titles"), F.max("l").alias("l"), F.max("r").alias("r"))
    both = F.expr("l is not null and r is not null")
    ends = runs.select("doc", "page", "place", "titles", F.when(both, F.col("l")).alias("l"), F.when(both, F.col("r")).alias("r"))
    return running(stored(ends, "ends"), ["doc"], ["page", "place"], sums={"section": F.col("titles")}).where("l is not null").select("doc", "section", "page", "l", "r")


def unbalanced(words: DataFrame, texts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(columns of a section that end apart on a page, pages with text past the bottom margin); without ``texts`` theirs are empty."""
    ends = column_ends(words, texts)
    diff = F.abs(F.col("l.y") - F.col("r.y"))
    apart = ends.where(diff > UNEVEN).select("doc", "section", "page", diff.alias("diff"), F.col("l.y").alias("left_y"), F.col("l.text").alias("left_text"), F.col("r.y").alias("right_y"), F.col("r.text").alias("right_text"))
    low = F.greatest("l.y", "r.y")
    over = ends.where(low > MARGIN_Y).groupBy("doc", "page").agg(F.min_by(low, "section").alias("y")).withColumn("over", F.col("y") - MARGIN_Y)
    return apart, over


def margins(lines: DataFrame) -> DataFrame:
    """(doc, parity, side, margin): the most common rounded left edge of body text; ties go to the first seen."""
    edge = lambda side: half_even(F.array_min(F.transform(F.filter(side, lambda x: is_body(x["h"])), lambda x: x["xMin"])))
    sides = lines.select("doc", "page", "first", (F.col("page") % 2).alias("parity"), F.explode(F.array(F.struct(F.lit("left").alias("side"), edge("left").alias("x")), F.struct(F.lit("right").alias("side"), edge("right").alias("x")))).alias("e")).select("doc", "page", "first", "parity", "e.*").where("x is not null")
    counts = sides.groupBy("doc", "parity", "side", "x").agg(F.count("*").alias("n"), F.min(F.struct("page", "first")).alias("seen"))
    best = Window.partitionBy("doc", "parity", "side").orderBy(F.desc("n"), "seen")
    return counts.withColumn("__n", F.row_number().over(best)).where("__n = 1").select("doc", "parity", "side", F.col("x").alias("margin"))


def orphans(words: DataFrame) -> DataFrame:
    """Flush single lines at a column's top with a paragraph gap below; single-column pages are left out.

    A column's first two lines are found where its page is; only first lines with a gap below
    them meet the margins, with the edges of the page's body words, which tell whether it has two columns.
    """
    lines = page_lines(words)
    m = margins(lines)
    pivot = m.groupBy("doc", "parity").agg(F.max(F.when(F.col("side") == "left", F.col("margin"))).alias("left_m"), F.max(F.when(F.col("side") == "right", F.col("margin"))).alias("right_m"))
    own = lambda c: F.filter(c, lambda x: is_body(x["h"]))
    line = lambda c: F.when(~F.col("is_title") & (F.size(own(c)) > 0), F.struct("y", F.array_min(F.transform(own(c), lambda w: w["xMin"])).alias("x"), _texts(own(c)).alias("text")))
    edges = F.transform(own("ws"), lambda w: F.struct(w["xMin"].alias("a"), w["xMax"].alias("b")))
    cells = lines.select("doc", "page", line("left").alias("left"), line("right").alias("right"), edges.alias("edges"))
    tops = lambda c: F.slice(F.array_sort(F.collect_list(c)), 1, 2).alias(c)
    pages = cells.groupBy("doc", "page").agg(tops("left"), tops("right"), F.flatten(F.collect_list("edges")).alias("edges"))
    column = lambda c: F.struct(F.lit(c).alias("side"), F.try_element_at(c, F.lit(1)).alias("top"), (F.try_element_at(c, F.lit(2))["y"] - F.try_element_at(c, F.lit(1))["y"]).alias("gap"))
    top = pages.select("doc", "page", "edges", F.explode(F.filter(F.array(*[column(c) for c in ("left", "right")]), lambda e: e["gap"] > PARAGRAPH_GAP)).alias("e"))
    known = top.select("doc", "page", "edges", (F.col("page") % 2).alias("parity"), "e.*").join(pivot, ["doc", "parity"], "left")
    probe = F.col("right_m") - GUTTER
    cover = F.when(probe.isNotNull(), F.size(F.filter("edges", lambda x: (x["a"] <= F.col("right_m") - GUTTER) & (x["b"] >= F.col("right_m") - GUTTER)))).otherwise(0)
    flush = F.when(F.col("side") == "left", F.col("left_m")).otherwise(F.col("right_m"))
    return known.where((cover < GUTTER_WORDS) & (F.abs(F.col("top.x") - flush) <= FLUSH)).select("doc", "page", "side", F.col("top.y").alias("y"), "gap", F.col("top.text").alias("text"))


def page_summary(words: DataFrame) -> DataFrame:
    """(doc, page, header, has_header, max_body, first, n_lines) for every page that has a word."""
    ok = words.where(F.trim("text") != "").withColumn("text", F.trim("text")).withColumn("h", F.col("yMax") - F.col("yMin")).withColumn("y", half_even(F.col("yMax")))
    ordered = lambda when: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("xMin", "flow", "block", "line", "word", "text")))), lambda w: w["text"]), " ")
    head = ok.where("yMax <= 50").groupBy("doc", "page").agg(ordered(F.lit(True)).alias("header"))
    lines = ok.where("yMax > 50 and yMax < 640").groupBy("doc", "page", "y").agg(F.max("h").alias("h"), ordered(F.lit(True)).alias("text"))
    body = lines.groupBy("doc", "page").agg(
        F.coalesce(F.max(F.when(is_body(F.col("h"), BODY_WIDE), F.col("y"))), F.max("y")).alias("max_body"),
        F.min(F.when(F.col("h") > 8.0, F.struct("y", "h", "text"))).alias("first"),
        F.count("*").alias("n_lines"),
    )
    out = head.join(body, ["doc", "page"], "full_outer")
    return out.select("doc", "page", F.coalesce("header", F.lit("")).alias("header"), F.col("header").isNotNull().alias("has_header"), F.coalesce("max_body", F.lit(0)).alias("max_body"), "first", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def section_top_gaps(words: DataFrame) -> DataFrame:
    """Numbered section titles at a page's top, with the room left on the page before and above the title.

    A page without a word is an empty page before; the first page has none before it.
    """
    # each page tells the next how far its body goes
    told = page_summary(words).select("doc", "page", "max_body", F.struct("has_header", "header", "first").alias("own"))
    both = told.select("doc", F.explode(F.array(F.struct("page", "own", F.lit(None).cast("int").alias("before")), F.struct((F.col("page") + 1).alias("page"), F.lit(None).cast(told.schema["own"].dataType).alias("own"), F.col("max_body").alias("before")))).alias("x")).select("doc", "x.*")
    met = both.groupBy("doc", "page").agg(F.first("own", ignorenulls=True).alias("own"), F.max("before").alias("before")).where("own is not null")
    pages = met.select("doc", "page", "own.*", F.coalesce("before", F.when(F.col("page") > 1, 0)).alias("before"))
    number = r"^\s*(\d+(?:\s+and\s+\d+)?)\.\s+\S"
    hit = pages.where(F.col("has_header") & (F.col("first.h") > 12.0) & (F.col("first.h") < 14.5) & F.col("first.text").rlike(number))
    gap = F.when(F.col("before").isNotNull(), FULL_BOTTOM - F.col("before")).otherwise(0.0)
    top = F.col("first.y") - NORMAL_TOP
    paper = F.regexp_extract("header", r"(\d+):(\d+)\.(\d+)", 1)
    return hit.select("doc", "page", F.when(paper != "", paper).otherwise("?").alias("paper"), F.regexp_extract("first.text", number, 1).alias("section"), gap.alias("bottom_gap"), (gap / LINE_PT).alias("bottom_lines"), F.col("first.y").alias("title_y"), top.alias("top_gap"), (top > UNEVEN).alias("flagged"), F.substring(F.regexp_replace("first.text", r"^\s*\d+(?:\s+and\s+\d+)?\.\s*", ""), 1, 36).alias("title"))


def column_blocks(lines: DataFrame, *, body: Column | None = None) -> DataFrame:
    """Blocks between spanning lines whose columns end apart, with the last two lines of each side."""
    body = (F.col("yMax") > 100) & (F.col("yMin") < 615) if body is None else body
    order = Window.partitionBy("doc", "page").orderBy("yMin", "ord")
    span = (F.col("xMin") < MIDDLE) & (F.col("xMax") > MIDDLE)
    numbered = lines.where(body).withColumn("k", F.row_number().over(order)).withColumn("span", span).withColumn("block", F.sum(span.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    side = F.when(F.col("span"), None).when(F.col("xMax") < MIDDLE, "left").when(F.col("xMin") > MIDDLE, "right")
    sided = numbered.withColumn("side", side).where("side is not null")
    ends = sided.groupBy("doc", "page", "block", "side").agg(F.max(F.struct("yMax", (-F.col("k")).alias("k"), "text")).alias("end"), F.array_sort(F.collect_list(F.struct("k", "text"))).alias("all"))
    get = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    pairs = ends.groupBy("doc", "page", "block").agg(get("left", "end").alias("l"), get("right", "end").alias("r"), get("left", "all").alias("la"), get("right", "all").alias("ra")).where("l is not null and r is not null")
    diff = F.abs(F.col("l.yMax") - F.col("r.yMax"))
    tail = lambda c: F.transform(F.slice(c, F.greatest(F.size(c) - 1, F.lit(1)), F.lit(2)), lambda x: x["text"])
    return pairs.where(diff > float(UNEVEN)).select("doc", "page", "block", diff.alias("diff"), F.col("l.yMax").alias("left_y"), F.col("l.text").alias("left_text"), F.col("r.yMax").alias("right_y"), F.col("r.text").alias("right_text"), tail("la").alias("left_tail"), tail("ra").alias("right_tail"))


def first_uneven(lines: DataFrame, *, pages: int = 16) -> DataFrame:
    """The first uneven block of each document, by the stricter body band.

    Pages are looked through in ranges, each twice as long as the one before: a document
    whose block is found is left out of the next, and the search ends when none is open.
    The page's bounds are filters on ``lines``; of a table in the order of pages, later
    ranges aren't read.
    """
    ends = stored(lines.groupBy("doc").agg(F.max("page").alias("last")), "last-pages")
    last = ends.agg(F.max("last")).first()[0] or 0
    low, found = 0, None
    while low < last or found is None:
        part = lines.where((F.col("page") > low) & (F.col("page") <= low + pages))
        part = part if found is None else part.join(found.select("doc"), "doc", "left_anti")
        hits = column_blocks(part, body=(F.col("yMax") > 100) & (F.col("yMax") < 610))
        first = hits.groupBy("doc").agg(F.min_by(F.struct(*[c for c in hits.columns if c != "doc"]), F.struct("page", "block")).alias("x")).select("doc", "x.*")
        found = stored(first if found is None else found.unionByName(first), "first-uneven")
        low, pages = low + pages, 2 * pages
        if low < last and ends.where(F.col("last") > low).join(found.select("doc"), "doc", "left_anti").isEmpty():
            break
    return found


def text_blocks(lines: DataFrame) -> DataFrame:
    """Uneven blocks of two-column text layouts: characters 1-43 and from 49 on, the gutter at 45-47."""
    inner = lines.where((F.col("n_lines") >= 6) & (F.col("line_no") >= 2) & (F.col("line_no") < F.col("n_lines") - 2))
    span = F.trim(F.substring("line", 45, 3)) != ""
    order = Window.partitionBy("doc", "page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    cells = inner.withColumn("span", span).withColumn("block", F.sum(span.cast("int")).over(order)).where(~F.col("span"))
    left, right = F.trim(F.substring("line", 1, 43)), F.trim(F.expr("substring(line, 49)"))
    last = lambda c: F.max(F.when((c != "") & ~c.rlike(r"^\d+$"), F.struct("line_no", c.alias("text"))))
    ends = cells.groupBy("doc", "page", "block").agg(last(left).alias("l"), last(right).alias("r"))
    return ends.where("l.line_no <> r.line_no").select("doc", "page", "block", F.col("l.line_no").alias("left_line"), F.col("l.text").alias("left_text"), F.col("r.line_no").alias("right_line"), F.col("r.text").alias("right_text"), F.abs(F.col("l.line_no") - F.col("r.line_no")).alias("diff"))


#: Characters of targets, all together, up to which they are broadcast as a trie; beyond, tails join.
TRIE_CHARS = 4_000_000


def ends_with(lines: DataFrame, targets: DataFrame) -> DataFrame:
    """Lines that end in a target: a row for each match, with ``target``.

    Targets of up to TRIE_CHARS characters together are broadcast as a trie of reversed
    strings: a line is walked from its end for as long as some target goes on, and only
    matches leave the walk.  More targets are joined: a target is known by its last 1, 2,
    4, 8 ... characters, as many as it has, so a line meets it under one such tail, of
    which it has as many as its length has binary digits.
    """
    own = targets.select("target").where("target <> ''").distinct()
    size = own.agg(F.sum(F.length("target"))).first()[0] or 0
    if size <= TRIE_CHARS:
        shared = lines.sparkSession.sparkContext.broadcast([r[0] for r in own.toLocalIterator()])
        return lines.withColumn("target", F.explode(endings(F.col("text"), lambda: shared.value)))
    tail = lambda c: F.pow(F.lit(2), F.floor(F.log2(F.length(c)))).cast("int")
    known = own.select("target", F.right("target", tail("target")).alias("__tail"))
    powers = F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.length("text"))).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int"))
    tails = lines.where("text <> ''").withColumn("__tail", F.explode(F.transform(powers, lambda n: F.right(F.col("text"), n))))
    return tails.join(known, "__tail").where(F.col("text").endswith(F.col("target"))).drop("__tail")


def probe(words: DataFrame, low: float, high: float) -> DataFrame:
    """Words with text whose baseline lies strictly between ``low`` and ``high``, as (doc, page, text, xMin, xMax, yMax), for a look at one band."""
    return words.where((F.trim("text") != "") & (F.col("yMax") > low) & (F.col("yMax") < high)).select("doc", "page", F.trim("text").alias("text"), "xMin", "xMax", "yMax")


def probe_lines(lines: DataFrame, page: int) -> DataFrame:
    """The native lines of one page of each document with their boxes, top to bottom."""
    return lines.where(F.col("page") == page).select("doc", "ord", "yMax", "xMin", "xMax", "text")


#: The first paper of each part.
PARTS = [(1, 1, 31), (2, 32, 56), (3, 57, 119), (4, 120, 196)]


def part_of(papers: DataFrame) -> DataFrame:
    """Papers with the part they belong to; the foreword (0) has none."""
    parts = papers.sparkSession.createDataFrame(PARTS, "part int, first int, last int")
    return papers.join(F.broadcast(parts), F.col("paper").between(F.col("first"), F.col("last")), "left").drop("first", "last")


def section_runs(words: DataFrame, **more: Column) -> DataFrame:
    """(doc, page, y, section): the lines of each document with the number of titles up to them; titles themselves are left out, page ends change nothing.

    ``more`` are columns made of a line as ``page_lines`` gives it; only these are written with its place, not its words,
    and lines are made once, before their ranges are drawn.
    """
    title = F.col("is_title") & (F.col("x_max") - F.col("x_min") > 100)
    lines = page_lines(words).select("doc", "page", "y", title.alias("title"), *[c.alias(n) for n, c in more.items()])
    return running(stored(lines, "lines"), ["doc"], ["page", "y"], sums={"section": F.col("title").cast("int")}).where(~F.col("title")).drop("title")


def titled_lines(words: DataFrame) -> DataFrame:
    """(doc, page, y, title): the lines of ``page_lines``, whether each is a section's title, and no words.

    A word is held against the next of its line by a window, so that no line is put together.
    """
    line = Window.partitionBy("doc", "page", "y").orderBy("xMin", "flow", "block", "line", "word", "xMax")
    ok = _in_band(words).select("doc", "page", "y", "xMin", "xMax", _apart(F.col("xMax"), F.col("xMin"), F.lead("xMin").over(line), F.lead("xMax").over(line)).alias("gap"))
    lines = ok.groupBy("doc", "page", "y").agg(F.max("gap").alias("gapped"), F.min("xMin").alias("x_min"), F.max("xMax").alias("x_max"))
    return lines.select("doc", "page", "y", (_across(F.col("gapped")) & (F.col("x_max") - F.col("x_min") > 100)).alias("title"))


def section_counts(words: DataFrame) -> DataFrame:
    """(doc, section, page, lines): how many lines of ``section_runs`` each section has on each page that it has some on.

    Lines are counted up to the next title of their page; only these counts, not the lines,
    are put in order over a document's pages.
    """
    page = Window.partitionBy("doc", "page").orderBy("y").rowsBetween(Window.unboundedPreceding, 0)
    place = F.sum(F.coalesce(F.col("title").cast("int"), F.lit(0))).over(page)
    runs = titled_lines(words).withColumn("place", place).groupBy("doc", "page", "place").agg(F.count(F.when(~F.col("title"), 1)).alias("lines"), F.count(F.when(F.col("title"), 1)).alias("titles"))
    return running(stored(runs, "sections"), ["doc"], ["page", "place"], sums={"section": F.col("titles")}).where("lines > 0").select("doc", "section", "page", "lines")


def section_pages(words: DataFrame) -> DataFrame:
    """(doc, section, page, lines, is_last): the pages that each section has lines on, and whether it ends there."""
    per = section_counts(words)
    last = per.groupBy("doc", "section").agg(F.max("page").alias("last"))
    return per.join(last, ["doc", "section"]).select(*per.columns, (F.col("last") == F.col("page")).alias("is_last"))


def finding_totals(findings: dict[str, DataFrame]) -> DataFrame:
    """(kind, n): how many rows each table of findings has."""
    counts = [df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n")) for kind, df in findings.items()]
    return reduce(DataFrame.unionAll, counts)


def page_marks(marks: DataFrame) -> DataFrame:
    """(doc, page, first, last, shown): first and last mark of each page; odd pages show the last, even ones the first."""
    m = F.struct("chapter", "verse")
    out = marks.groupBy("doc", "page").agg(F.min_by(m, "serial").alias("first"), F.max_by(m, "serial").alias("last"))
    return out.withColumn("shown", F.when(F.col("page") % 2 == 1, F.col("last")).otherwise(F.col("first")))
