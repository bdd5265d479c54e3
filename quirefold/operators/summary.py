"""Counts and summaries over comparisons, and their rendering as Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.macros import macro_table
from ..sources.scratch import stored
from .diff import Comparison, glyph_log, text_changes
from .ordered import numbered


COUNTS = ["left_sections", "right_sections", "left_verses", "right_verses", "common", "only_left", "only_right", "text_diffs", "italic_diffs", "mismatches"]


def paper_summary(c: Comparison) -> DataFrame:
    """A row per paper: counts of both sides, of differences (skipped keys count in only_*), and the status.

    Every table contributes rows of counts, and one grouping adds them up.
    """

    def part(df: DataFrame, **counts) -> DataFrame:
        return df.select("paper", *[counts[n].cast("long").alias(n) if n in counts else F.lit(0).cast("long").alias(n) for n in COUNTS])

    one, told = F.lit(1), ~F.col("skip")
    is_ = lambda s, more=F.lit(True): ((F.col("status") == s) & more).cast("int")
    rows = part(c.left_heads, left_sections=F.col("sections")).unionAll(part(c.right_heads, right_sections=F.col("sections")))
    rows = rows.unionAll(part(c.left_verses, left_verses=one)).unionAll(part(c.right_verses, right_verses=one)).unionAll(part(c.mismatches, mismatches=one))
    both = (~F.col("status").isin("only_left", "only_right")).cast("int")
    rows = rows.unionAll(part(c.compared, common=both, only_left=is_("only_left"), only_right=is_("only_right"), text_diffs=is_("text", told), italic_diffs=is_("italic", told)))
    out = rows.groupBy("paper").agg(*[F.sum(n).alias(n) for n in COUNTS])
    return out.withColumn("status", F.when(F.col("mismatches") == 0, "CLEAN").otherwise("FAIL"))


def totals(summary: DataFrame) -> DataFrame:
    """One row for the book."""
    sums = [F.sum(c).alias(c) for c in ("left_verses", "right_verses", "common", "only_left", "only_right", "text_diffs", "italic_diffs", "mismatches")]
    return summary.agg(F.count("*").alias("papers"), F.count_if(F.col("status") == "CLEAN").alias("clean"), F.count_if(F.col("status") == "FAIL").alias("failed"), *sums)


def by_kind(mismatches: DataFrame, examples: int = 8) -> DataFrame:
    """Findings by kind, most first, with the first few keys as examples.

    A kind may hold most rows: each task counts them and keeps its first few, only these meet.
    """
    first = F.row_number().over(Window.partitionBy("kind").orderBy("paper", "section", "verse"))
    near = mismatches.select("kind", "paper", "section", "verse").withColumn("__n", first).where(F.col("__n") <= examples)
    keys = near.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("__n", F.concat_ws(":", "paper", "section", "verse").alias("key")))).alias("x"))
    counts = mismatches.groupBy("kind").agg(F.count("*").alias("n"))
    return counts.join(keys, "kind").select("kind", "n", F.transform("x", lambda e: e["key"]).alias("examples")).orderBy(F.desc("n"), "kind")


def macro_coverage(tokens: DataFrame, places: int = 3) -> DataFrame:
    """Each macro used: count, whether the table knows it, first places, and its rank: most used first, then first seen.

    ``tokens`` has path, ord, kind, value, line and col.
    """
    used = tokens.where("kind = 'MACRO'")
    w = Window.partitionBy("value").orderBy("path", "ord")
    near = used.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= places).groupBy("value").agg(F.sort_array(F.collect_list(F.struct("__n", F.concat_ws(":", "path", "line", "col").alias("at")))).alias("x"))
    counts = used.groupBy("value").agg(F.count("*").alias("n"), F.min(F.struct("path", "ord")).alias("first"))
    known = F.broadcast(macro_table(tokens.sparkSession).select(F.col("name").alias("value"), F.lit(True).alias("k")))
    told = counts.join(known, "value", "left").join(near, "value").select("value", "n", F.coalesce("k", F.lit(False)).alias("known"), F.transform("x", lambda e: e["at"]).alias("places"), "first")
    return numbered(told, F.desc("n"), "first", name="rank").select("value", "n", "known", "places", (F.col("rank") + 1).alias("rank")).orderBy("rank")


def unknown_macros(tokens: DataFrame) -> DataFrame:
    """Macro names that the table lacks."""
    used = tokens.where("kind = 'MACRO'").select(F.col("value").alias("name")).distinct()
    return used.join(F.broadcast(macro_table(tokens.sparkSession).select("name")), "name", "left_anti")


def _joined(rows: DataFrame, order: list[str], line, most: int, more: str) -> DataFrame:
    """(paper, text): the lines of each paper's first ``most`` rows in order, and how many more there are."""
    w = Window.partitionBy("paper")
    ranked = rows.withColumn("__n", F.row_number().over(w.orderBy(*order))).withColumn("__all", F.count("*").over(w)).where(F.col("__n") <= most)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", line.alias("line")))), lambda x: x["line"]), "\n")
    left = F.max("__all") - most
    return ranked.groupBy("paper").agg(F.concat(text, F.when(left > 0, F.concat(F.lit("\n... ("), left.cast("string"), F.lit(f" more {more})"))).otherwise("")).alias("text"))


def _quoted(c) -> Column:
    return F.concat(F.lit("`"), F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), F.lit("`"))


def _key() -> Column:
    return F.concat_ws(":", "paper", "section", "verse")


def paper_reports(c: Comparison, most: int = 50) -> DataFrame:
    """(paper, report): Markdown for each paper, written by the executors.

    Counts and status, both titles, all mismatches, and at most ``most`` text changes with
    their characters, italic differences and odd glyphs, with how many more there are.
    """
    heads = c.left_heads.select("paper", F.col("title").alias("lt"), F.col("sections").alias("ls")).join(c.right_heads.select("paper", F.col("title").alias("rt"), F.col("sections").alias("rs")), "paper", "full_outer")
    told = c.compared.where("not skip")
    edits = text_changes(c.compared)
    per_verse = edits.groupBy("paper", "section", "verse").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i1", "j1", F.concat(F.lit("- `..."), "before", F.lit("` left "), _quoted("left"), F.lit(" right "), _quoted("right"), F.lit(" `"), "after", F.lit("...`")).alias("line")))), lambda x: x["line"]), "\n").alias("edits"))
    spans = lambda s: F.array_join(F.transform(F.col(f"{s}.italics"), lambda x: F.concat(x["s"].cast("string"), F.lit("-"), x["e"].cast("string"))), " ")
    line = F.concat(F.lit("- **"), "kind", F.lit("** "), F.concat_ws(":", F.col("section").cast("string"), F.col("verse").cast("string")), F.lit(" "), "detail")
    parts = {
        "Mismatches": _joined(c.mismatches, ["kind", "section", "verse", "detail"], line, 1 << 30, ""),
        "Text": _joined(per_verse, ["section", "verse"], F.concat(F.lit("### "), _key(), F.lit("\n"), "edits"), most, "text differences"),
        "Italics": _joined(told.where("status = 'italic'"), ["section", "verse"], F.concat(F.lit("### "), _key(), F.lit("\n- left "), spans("nl"), F.lit("\n- right "), spans("nr"), F.lit("\n- "), F.substring(F.col("nl.text"), 1, 200)), most, "italic differences"),
        "Glyphs": _joined(glyph_log(c.compared), ["section", "verse", "side", "glyph"], F.concat(F.lit("- "), _key(), F.lit(" "), "side", F.lit(" "), "glyph", F.lit(" "), F.col("n").cast("string")), most, "glyph notes"),
    }
    s = paper_summary(c).join(heads, "paper", "left")
    number = lambda x: F.col(x).cast("string")
    top = F.concat_ws("\n", F.concat(F.lit("# Paper "), number("paper")), F.concat(F.lit("- Left verses: "), number("left_verses"), F.lit(" Right verses: "), number("right_verses"), F.lit(" common: "), number("common")),
        F.concat(F.lit("- Only left: "), number("only_left"), F.lit(" Only right: "), number("only_right")), F.concat(F.lit("- Text diffs: "), number("text_diffs"), F.lit(" Italic diffs: "), number("italic_diffs")), F.concat(F.lit("- Status: "), "status"),
        F.concat(F.lit("- Titles: "), _quoted("lt"), F.lit(" "), _quoted("rt")), F.concat(F.lit("- Sections: "), F.coalesce(number("ls"), F.lit("0")), F.lit(" "), F.coalesce(number("rs"), F.lit("0"))))
    for name, rows in parts.items():
        s = s.join(rows.withColumnRenamed("text", f"__{name}"), "paper", "left")
    sections = [F.when(F.col(f"__{n}").isNotNull(), F.concat(F.lit(f"\n## {n}\n"), f"__{n}")) for n in parts]
    return s.select("paper", F.concat_ws("\n", top, *sections).alias("report"))


def read_reports(reports: DataFrame) -> DataFrame:
    """Counts read back from ``paper_reports``' Markdown; a report without them has nulls and the status ``?``."""
    get = lambda label: F.expr(f"try_cast(nullif(regexp_extract(report, '(?m){label}: (\\\\d+)', 1), '') as bigint)")
    labels = {"left_verses": "Left verses", "right_verses": "Right verses", "common": "common", "only_left": "Only left", "only_right": "Only right", "text_diffs": "Text diffs", "italic_diffs": "Italic diffs"}
    status = F.regexp_extract("report", r"(?m)^- Status: (\w+)", 1)
    return reports.select("paper", *[get(v).alias(k) for k, v in labels.items()], F.when(status == "", "?").otherwise(status).alias("status"), F.regexp_count("report", F.lit(r"(?m)^- \*\*")).cast("long").alias("mismatches"))


def paper_report(c: Comparison, paper: int) -> str:
    """The report of one paper."""
    r = paper_reports(c).where(F.col("paper") == paper).first()
    return r.report + "\n" if r else f"# Paper {paper}: absent\n"


def failed_details(c: Comparison, most: int = 20) -> DataFrame:
    """(paper, text): the first ``most`` mismatches of each failed paper, for the book's report."""
    return _joined(c.mismatches, ["kind", "section", "verse", "detail"], F.concat(F.lit("- **"), "kind", F.lit("** "), "detail"), most, "in the paper's own report")


def book_rows(c: Comparison) -> DataFrame:
    """(part, paper, line): the book's report as rows: totals, categories, a line per paper, details of the papers that failed."""
    summary = paper_summary(c)
    spark = summary.sparkSession
    row = lambda df, part, line, paper=F.lit(0): df.select(F.lit(part).alias("part"), paper.cast("int").alias("paper"), line.alias("line"))
    text = lambda *parts: F.concat(*[F.lit(p[1:]) if p.startswith("=") else F.col(p).cast("string") for p in parts])
    one = spark.range(1)
    top = totals(summary)
    sums = F.concat_ws("\n", text("=# Summary\n\n- Papers: ", "papers", "=, clean ", "clean", "=, failed ", "failed"), text("=- Verses: ", "left_verses", "= and ", "right_verses", "=, common ", "common", "=, only left ", "only_left", "=, only right ", "only_right"), text("=- Text diffs: ", "text_diffs", "=, italic diffs: ", "italic_diffs"))
    kinds = by_kind(c.mismatches).withColumn("first", F.coalesce(F.try_element_at("examples", F.lit(1)), F.lit("")))
    # most first; kinds are few, their order is part of the sort below
    listed = row(kinds, 2, text("=| ", "kind", "= | ", "n", "= | ", "first", "= |"), -F.least(F.col("n"), F.lit(2**31 - 1)))
    papers = row(summary, 4, F.concat(F.lit("| "), F.concat_ws(" | ", *[F.col(x).cast("string") for x in ("paper", "left_verses", "right_verses", "common", "only_left", "only_right", "text_diffs", "italic_diffs", "status")]), F.lit(" |")), F.col("paper"))
    details = row(failed_details(c), 5, F.concat(F.lit("\n### Paper "), F.col("paper").cast("string"), F.lit("\n"), "text"), F.col("paper"))
    heads = row(one, 1, F.lit("\n| Category | Count | First |\n|-|-|-|")).unionAll(row(one, 3, F.lit("\n| Paper | Left | Right | Common | Only left | Only right | Text | Italic | Status |\n|-|-|-|-|-|-|-|-|-|")))
    return row(top, 0, sums).unionAll(heads).unionAll(listed).unionAll(papers).unionAll(details)


def write_in_order(rows: DataFrame, order: list[str], folder: str, parts: int | None = None) -> None:
    """Writes ``line`` of the rows as text files whose names and lines follow ``order``; the executors write, the driver holds none of it."""
    n = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("line").write.text(folder)


def read_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """(file, n, line): the lines of what ``write_in_order`` wrote, in the order of file and n."""
    return spark.read.text(folder).select(F.col("_metadata.file_name").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("k")).alias("n"), F.col("value").alias("line"))


def write_book_report(c: Comparison, folder: str, parts: int | None = None) -> None:
    """The book's report as text files in order, written by the executors."""
    write_in_order(book_rows(c), ["part", "paper", "line"], folder, parts)


def book_report(c: Comparison) -> str:
    """The book's report as one string, for a book that a reader would read on a screen; ``write_book_report`` has no such bound."""
    return "\n".join(r.line for r in book_rows(c).orderBy("part", "paper", "line").toLocalIterator()) + "\n"


def coverage_rows(tokens: DataFrame) -> DataFrame:
    """(part, rank, line): the macro coverage as rows: totals, unknown names in order, then each macro with its places, most used first."""
    used = stored(macro_coverage(tokens), "coverage")
    row = lambda df, part, rank, line: df.select(F.lit(part).alias("part"), rank.cast("long").alias("rank"), line.alias("line"))
    top = used.agg(F.count("*").alias("m"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(~F.col("known")).alias("u"))
    head = row(top, 0, F.lit(0), F.concat(F.lit("# "), F.col("m").cast("string"), F.lit(" macros, "), F.col("n").cast("string"), F.lit(" occurrences\n# unknown: "), F.col("u").cast("string")))
    unknown = row(used.where("not known"), 1, F.lit(0), F.concat(F.lit("# unknown "), "value"))
    places = F.array_join(F.transform("places", lambda p: F.concat(F.lit("\n    at "), p)), "")
    each = row(used, 2, F.col("rank"), F.concat(F.when(F.col("known"), "KNOWN ").otherwise("UNKNOWN "), F.col("n").cast("string"), F.lit(" \\"), "value", places))
    return head.unionAll(unknown).unionAll(each)


def write_coverage_report(tokens: DataFrame, folder: str, parts: int | None = None) -> None:
    """The macro coverage as text files in order, written by the executors."""
    write_in_order(coverage_rows(tokens), ["part", "rank", "line"], folder, parts)


def coverage_report(tokens: DataFrame) -> str:
    """The macro coverage as one string."""
    return "\n".join(r.line for r in coverage_rows(tokens).orderBy("part", "rank", "line").toLocalIterator()) + "\n"
