"""Readers and writers of papers, extracts, deviations, page boxes and text layouts.

Everything is read through Spark, so any store that Spark reads will do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import running
from ..schemas import BBOX_PAGE, DEVIATION, SECTION, SPANS
from .scratch import write_files

JSONL = f"_kind string, paper int, title string, subtitle string, author string, sections array<{SECTION}>, section int, verse int, text string, italics array<array<int>>, macros_seen array<string>, floater boolean"


def whole_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path, src): one row per file whose name matches ``glob``."""
    read = spark.read.text(folder, wholetext=True, pathGlobFilter=glob)
    return read.select(F.col("_metadata.file_name").alias("path"), F.col("value").alias("src"))


def tex_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paper files pNNN.tex; fragments with other names are left out."""
    return whole_files(spark, folder, "p[0-9][0-9][0-9].tex")


def html_files(spark: SparkSession, folder: str) -> DataFrame:
    return whole_files(spark, folder, "*Paper[0-9][0-9][0-9].html")


def tex_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, place, line): the lines of paper files pNNN.tex, so that no row holds a file."""
    read = spark.read.option("lineSep", "\n").text(folder, pathGlobFilter="p[0-9][0-9][0-9].tex")
    return read.select(F.col("_metadata.file_name").alias("path"), F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n")).alias("place"), F.col("value").alias("line"))


def numbered_files(files: DataFrame) -> DataFrame:
    """(paper, path) by the number in each file's name; other columns aren't read."""
    return files.select(F.expr(r"try_cast(nullif(regexp_extract(path, '(\\d{3,})\\.\\w+$', 1), '') as int)").alias("paper"), "path")


def chosen(files: DataFrame, papers: list[int] | None) -> DataFrame:
    """Files of the chosen papers, by their names, so that no other is parsed."""
    number = F.expr(r"try_cast(nullif(regexp_extract(path, '(\\d{3,})\\.\\w+$', 1), '') as int)")
    return files if papers is None else files.where(number.isin(papers))


def file_problems(files: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper, n) of the wanted papers that don't have exactly one file."""
    counts = numbered_files(files).groupBy("paper").agg(F.count("*").alias("n"))
    return papers.select("paper").join(counts, "paper", "left").select("paper", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def only(df: DataFrame, papers: list[int] | None) -> DataFrame:
    """Rows of the chosen papers; on a table partitioned by paper this prunes partitions."""
    return df if papers is None else df.where(F.col("paper").isin(papers))


def verses_of(papers: DataFrame) -> DataFrame:
    """One row per verse of extracted papers."""
    return papers.select("paper", F.explode("verses").alias("v")).select("paper", "v.*")


def sections_of(papers: DataFrame) -> DataFrame:
    return papers.select("paper", F.posexplode("sections").alias("pos", "s")).select("paper", "pos", "s.*")


def headers_of(papers: DataFrame) -> DataFrame:
    return papers.select("paper", "title", "subtitle", "author", F.size("sections").alias("sections"), F.size("verses").alias("verses"), "error")


def write_jsonl(papers: DataFrame, path: str, pieces: DataFrame | None = None, compression: str = "none") -> None:
    """A header line and then the verses of each paper, in a folder per paper; the verses are in ``pieces``, if given."""
    head = papers.select("paper", F.lit(-1).alias("ord"), F.to_json(F.struct(F.lit("paper").alias("_kind"), "paper", "title", "subtitle", "author", "sections"), {"ignoreNullFields": "false"}).alias("value"))
    v = verses_of(papers if pieces is None else pieces)
    spans = F.transform("italics", lambda x: F.array(x["s"], x["e"])).alias("italics")
    body = v.select("paper", "ord", F.to_json(F.struct("paper", "section", "verse", "text", spans, "macros_seen", "floater")).alias("value"))
    rows = head.unionByName(body).repartition("paper").sortWithinPartitions("paper", "ord")
    rows.select("value", "paper").write.mode("overwrite").partitionBy("paper").text(path, compression=compression)


def read_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(headers, verses) of a folder of extracts; missing optional fields get their defaults.

    ``ord`` is a line's place: its file, the file's split and the place in that, so the order of lines holds however a file is split.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n"))
    rows = spark.read.schema(JSONL).json(path).select("*", place.alias("ord"))
    is_head = F.col("_kind").eqNullSafe("paper")
    spans = F.coalesce(F.transform("italics", lambda x: F.struct(x[0].alias("s"), x[1].alias("e"))), F.expr(f"cast(array() as {SPANS})")).alias("italics")
    heads = rows.where(is_head).select("paper", "title", "subtitle", "author", "sections")
    verses = rows.where(~is_head).select("paper", "section", "verse", "text", spans, F.coalesce("macros_seen", F.expr("cast(array() as array<string>)")).alias("macros_seen"), F.coalesce("floater", F.lit(False)).alias("floater"), "ord")
    return heads, verses


#: How a key is written, and the fields that a deviation may have.
_KEY = r"^(\d+):(\d+):(\d+)(?:-(\d+))?:\s*$"
_FLAGS, _NOTES = ["skip", "ignore_italics"], ["reason", "expect_tex", "expect_srt"]


def deviation_rows(lines: DataFrame) -> DataFrame:
    """The allow-list (schema DEVIATION) from its lines (n, line), a row per verse key.

    A key's line opens a block, the fields below it are the block's; ranges fan out, a
    reversed one is an error, the last block of a key holds, other lines are passed over.
    Blocks are told by ranges of the lines, so a list of any length is read by many tasks.
    """
    number = lambda k: F.regexp_extract("line", _KEY, k).try_cast("int")
    told = lines.where("trim(line) <> '' and not trim(line) like '#%'").withColumn("is_key", F.col("line").rlike(_KEY))
    blocks = running(told, [], ["n"], lasts={"block": F.when(F.col("is_key"), F.col("n"))})
    field = r"^\s+(\w+):\s*(.*)$"
    value = F.regexp_replace(F.regexp_extract("line", field, 2), r"""^(["'])(.*)\1$""", "$2")
    named = F.regexp_extract("line", field, 1)
    last = lambda f: F.max_by(F.when(~F.col("is_key") & (named == f), value), F.when(~F.col("is_key") & (named == f), F.col("n")))
    keys = [F.max(F.when(F.col("is_key"), number(k))).alias(c) for k, c in enumerate(("paper", "section", "a", "b"), 1)]
    found = blocks.where("block is not null").groupBy("block").agg(*keys, *[F.coalesce(F.lower(last(f)).isin("true", "yes", "1"), F.lit(False)).alias(f) for f in _FLAGS], *[last(f).alias(f) for f in _NOTES])
    upto = F.coalesce("b", "a")
    span = F.when(upto < F.col("a"), F.raise_error(F.concat(F.lit("invalid range "), F.col("a").cast("string"), F.lit("-"), upto.cast("string")))).otherwise(F.sequence("a", upto))
    rows = found.select("block", "paper", "section", F.explode(span).alias("verse"), *_FLAGS, *_NOTES)
    fields = [c.split()[0] for c in DEVIATION.split(", ")[3:]]
    return rows.groupBy("paper", "section", "verse").agg(F.max_by(F.struct(*fields), "block").alias("d")).select("paper", "section", "verse", "d.*")


def read_deviations(spark: SparkSession, path: str | None) -> DataFrame:
    """The allow-list of a file; a missing file is empty."""
    empty = spark.createDataFrame([], "n int, line string")
    if not path:
        return deviation_rows(empty)
    try:
        return deviation_rows(spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("n", "line")))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return deviation_rows(empty)


def bbox_pages(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, body): pages of box documents in file order, parsed with a fixed schema.

    Files are read page by page: what a task holds is a page, and a large file is split.
    """
    place = [F.col("_metadata.file_name").alias("doc"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n")]
    pieces = spark.read.option("lineSep", "</page>").text(path).select("value", *place).where(F.col("value").contains("<page"))
    xml = F.concat(F.regexp_extract("value", r"(?s)<page\b.*", 0), F.lit("</page>"))
    parsed = pieces.select("doc", "split", "n", F.from_xml(xml, F.lit(BBOX_PAGE), {"ignoreNamespace": "true"}).alias("body"))
    return parsed.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("split", "n")).alias("page"), "body")


def bbox_words(pages: DataFrame) -> DataFrame:
    """Schema WORD: a row per word box that has text."""
    x = pages.select("doc", "page", F.posexplode("body.flow").alias("flow", "f"))
    x = x.select("doc", "page", "flow", F.posexplode("f.block").alias("block", "b"))
    x = x.select("doc", "page", "flow", "block", F.posexplode("b.line").alias("line", "l"))
    x = x.select("doc", "page", "flow", "block", "line", F.posexplode("l.word").alias("word", "w"))
    box = [F.col(f"w._{c}").alias(c) for c in ("xMin", "xMax", "yMin", "yMax")]
    return x.select("doc", "page", "flow", "block", "line", "word", F.col("w._VALUE").alias("text"), *box).where(F.col("text").isNotNull())


def bbox_lines(pages: DataFrame) -> DataFrame:
    """(doc, page, ord, text, xMin, xMax, yMin, yMax): a row per native line box that has text."""
    x = pages.select("doc", "page", F.posexplode("body.flow").alias("flow", "f"))
    x = x.select("doc", "page", "flow", F.posexplode("f.block").alias("block", "b"))
    x = x.select("doc", "page", "flow", "block", F.posexplode("b.line").alias("line", "l"))
    words = F.filter(F.transform("l.word", lambda w: w["_VALUE"]), lambda t: t.isNotNull() & (t != ""))
    box = [F.col(f"l._{c}").alias(c) for c in ("xMin", "xMax", "yMin", "yMax")]
    out = x.select("doc", "page", (F.col("flow") * 1_000_000_000 + F.col("block") * 100_000 + F.col("line")).cast("long").alias("ord"), F.trim(F.array_join(words, " ")).alias("text"), *box)
    return out.where("text <> ''")


def text_pages(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, n_lines, line_no, line) of text layouts: pages end at form feeds; line_no counts from 0."""
    return laid_out(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("doc"), "value"))


def box_pages_of(files: DataFrame) -> DataFrame:
    """(doc, page, body) of box documents (path, src) that are rows: pages are numbered within their row, so none is moved."""
    pieces = F.filter(F.split("src", "</page>"), lambda x: x.contains("<page"))
    each = files.select(F.col("path").alias("doc"), F.posexplode(pieces).alias("p", "value"))
    xml = F.concat(F.regexp_extract("value", r"(?s)<page\b.*", 0), F.lit("</page>"))
    return each.select("doc", (F.col("p") + 1).alias("page"), F.from_xml(xml, F.lit(BBOX_PAGE), {"ignoreNamespace": "true"}).alias("body"))


def laid_out(files: DataFrame) -> DataFrame:
    """The lines of (doc, value) text layouts."""
    pages = files.select("doc", F.posexplode(F.split("value", "\\x0c")).alias("p", "page_text"))
    lines = pages.select("doc", (F.col("p") + 1).alias("page"), F.split("page_text", "\n").alias("ls"))
    return lines.select("doc", "page", F.size("ls").alias("n_lines"), F.posexplode("ls").alias("line_no", "line"))


def write_fixed(files: DataFrame, folder: str) -> DataFrame:
    """Writes the files whose list openers lack the paragraph mark, with it and under their names, to a new folder; returns (path, fixes)."""
    from ..functions.text import mark_list_openers

    text, n = mark_list_openers(F.col("src"))
    fixed = files.select("path", text.alias("src"), n.alias("fixes")).where("fixes > 0")
    return write_files(fixed, folder).join(fixed.select("path", "fixes"), "path").select("path", "fixes")
