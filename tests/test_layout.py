"""Page geometry on synthetic boxes."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quirefold.operators import layout
from quirefold.plans import pages
from quirefold.sources import files as fs


def page(*words, body=10.0):
    """Words as (text, x0, x1, baseline[, height])."""
    return "".join(f'<line xMin="{w[1]}" yMin="{w[3] - (w[4] if len(w) > 4 else body)}" xMax="{w[2]}" yMax="{w[3]}"><word xMin="{w[1]}" yMin="{w[3] - (w[4] if len(w) > 4 else body)}" xMax="{w[2]}" yMax="{w[3]}">{w[0]}</word></line>' for w in words)


def doc(*pages):
    inner = "".join(f'<page width="481" height="680"><flow><block xMin="0" yMin="0" xMax="1" yMax="1">{p}</block></flow></page>' for p in pages)
    return f'<?xml version="1.0"?><html xmlns="http://www.w3.org/1999/xhtml"><head/><body><doc>{inner}</doc></body></html>'


def column(side, ys, x=None):
    x = x or {"left": 60, "right": 250}[side]
    return [(f"{side[0]}{y}", x, x + 140, y) for y in ys]


@pytest.fixture
def read(spark, tmp_path):
    def made(*pages):
        (tmp_path / "a_bbox.html").write_text(doc(*pages), encoding="utf-8")
        p = fs.bbox_pages(spark, str(tmp_path / "a_bbox.html"))
        return fs.bbox_words(p), fs.bbox_lines(p)

    return made


def test_reader(read):
    words, lines = read(page(("a", 60, 70, 100.5), (" ", 80, 90, 100)), page(("b", 60, 70, 200)))
    assert [(r.page, r.text, r.yMax) for r in words.where("trim(text) <> ''").orderBy("page").collect()] == [(1, "a", 100.5), (2, "b", 200.0)]
    assert lines.count() == 2


def test_unbalanced(read):
    title = [("Title", 100, 300, 300)]
    words, _ = read(
        page(*column("left", [100, 111, 122]), *column("right", [100, 111, 117])),
        page(*column("left", [100, 111, 122]), *column("right", [100, 111]), *title, *column("left", [400, 626]), *column("right", [400, 626])),
        page(*column("left", [100]), *column("right", [100]), ("foot", 60, 200, 500, 8.97)),
    )
    apart, over = layout.unbalanced(words)
    assert [(r.page, r.section, r["diff"], r.left_text, r.right_y) for r in apart.collect()] == [(2, 0, 11, "l122", 111)]
    assert [(r.page, r.over) for r in over.collect()] == [(2, 1)]


def test_orphans(read):
    full = [*column("left", [100, 111, 122, 133]), *column("right", [100, 111, 122, 133])]
    words, _ = read(
        page(*full), page(*full),
        page(*column("left", [100, 117, 128]), *column("right", [100, 116, 127])),  # gap 17 tells, 16 doesn't
        page(*column("left", [100], x=72), *column("left", [122, 133]), *column("right", [100, 111])),  # indented start
        page(*column("left", [100, 122]), *[(f"w{y}", 200, 300, y) for y in (300, 311, 322)]),  # one column
    )
    assert [(r.page, r.side, r.y, r.gap, r.text) for r in layout.orphans(words).collect()] == [(3, "left", 100, 17, "l100")]


def test_margins_take_first_seen(read):
    words, _ = read(page(*column("left", [100], x=60), *column("left", [111], x=72)))
    m = layout.margins(layout.page_lines(words)).collect()
    assert [(r.parity, r.side, r.margin) for r in m] == [(1, "left", 60)]


def test_section_top_gaps(read):
    head = ("100:2.3", 60, 100, 40, 8)
    words, _ = read(page(head, *column("left", [100, 600])), page(head, ("6", 60, 62, 60, 6.0), ("3. A Heading", 60, 200, 75, 13.0), *column("left", [110])), page(), page(head, ("4. Flush", 60, 200, 66, 13.0)))
    rows = layout.section_top_gaps(words).orderBy("page").collect()
    assert [(r.page, r.paper, r.section, r.bottom_gap, r.title_y, r.top_gap, r.flagged, r.title) for r in rows] == [(2, "100", "3", 23.0, 75, 8.0, True, "A Heading"), (4, "100", "4", 623.0, 66, -1.0, False, "Flush")]


def test_column_blocks(read):
    _, lines = read(page(*column("left", [120, 131, 142]), *column("right", [120, 131]), ("span", 100, 400, 200), *column("left", [300]), *column("right", [300, 303])), page(*column("left", [120, 140]), *column("right", [120])))
    rows = layout.column_blocks(lines).orderBy("page", "block").collect()
    assert [(r.page, r.block, r["diff"], r.left_tail, r.right_tail) for r in rows] == [(1, 0, 11.0, ["l131", "l142"], ["r120", "r131"]), (2, 0, 20.0, ["l120", "l140"], ["r120"])]
    assert [(r.page, r.block) for r in layout.first_uneven(lines).collect()] == [(1, 0)]


def test_pages_are_read_one_by_one(spark, tmp_path):
    """A box file in several splits keeps the order of its pages; probes show a band and a page."""
    (tmp_path / "b_bbox.html").write_text(doc(*[page((f"w{k}", 60, 70, 100 + k)) for k in range(400)]), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        pages = fs.bbox_pages(spark, str(tmp_path / "b_bbox.html"))
        words = fs.bbox_words(pages).collect()
        assert len(words) == 400 and all(r.text == f"w{r.page - 1}" for r in words)
        assert [(r.page, r.text) for r in layout.probe(fs.bbox_words(pages), 102.0, 104.0).collect()] == [(4, "w3")]
        assert [r.text for r in layout.probe_lines(fs.bbox_lines(pages), 7).collect()] == ["w6"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_suffixes_of_many_lengths(spark):
    targets = spark.range(1, 1300).selectExpr("repeat('a', cast(id as int)) AS target")
    hits = layout.ends_with(spark.createDataFrame([("b" + "a" * 1200,)], "text string"), targets)
    assert hits.count() == 1200


def test_text_blocks(spark, tmp_path):
    row = lambda a, b="": f"{a:<43}     {b}"
    body = ["head", "", row("one", "uno"), row("two", "dos"), row("three"), row("12", "7"), "x" * 60, row("a", "b"), "", "tail", "end"]
    (tmp_path / "t.txt").write_text("short\n\x0c" + "\n".join(body), encoding="utf-8")
    rows = layout.text_blocks(fs.text_pages(spark, str(tmp_path / "t.txt"))).collect()
    assert [(r.page, r.left_line, r.left_text, r.right_line, r.right_text) for r in rows] == [(2, 4, "three", 3, "dos")]


def test_suffix_parts_marks(spark):
    lines = spark.createDataFrame([("the end.",), ("an end.",), ("x",)], "text string")
    hits = layout.ends_with(lines, spark.createDataFrame([("end.",), ("e end.",), ("longer than all",)], "target string"))
    assert {tuple(r) for r in hits.select("text", "target").collect()} == {("the end.", "end."), ("an end.", "end."), ("the end.", "e end.")}
    parts = layout.part_of(spark.createDataFrame([(0,), (1,), (31,), (32,), (196,)], "paper int")).orderBy("paper").collect()
    assert [r.part for r in parts] == [None, 1, 1, 2, 4]
    marks = spark.createDataFrame([("d", 1, 1, 5, 1), ("d", 1, 2, 5, 2), ("d", 2, 3, 5, 3), ("d", 2, 4, 6, 1)], "doc string, page int, serial int, chapter int, verse int")
    rows = layout.page_marks(marks).orderBy("page").select("page", F.col("shown.chapter").alias("c"), F.col("shown.verse").alias("v")).collect()
    assert [tuple(r) for r in rows] == [(1, 5, 2), (2, 5, 3)]


def test_endings_by_trie_and_by_tails(spark, monkeypatch):
    """Both ways of finding endings give every line with every target it ends in."""
    import random

    rng = random.Random(6)
    texts = ["".join(rng.choices("abé", k=rng.randrange(12))) for _ in range(300)] + [None, ""]
    targets = ["".join(rng.choices("abé", k=rng.randrange(7))) for _ in range(60)] + [None, "", "a", "aa", "aaa"]
    lines = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    wanted = spark.createDataFrame([(t,) for t in targets], "target string")
    want = sorted((k, x) for k, t in enumerate(texts) for x in {x for x in targets if x} if t and t.endswith(x))
    found = layout.ends_with(lines, wanted)
    assert sorted((r.k, r.target) for r in found.collect()) == want and len(want) > 300
    assert found.columns == ["k", "text", "target"]
    monkeypatch.setattr(layout, "TRIE_CHARS", 0)
    assert sorted((r.k, r.target) for r in layout.ends_with(lines, wanted).collect()) == want
    assert layout.ends_with(lines, wanted.where("false")).count() == 0


def test_first_uneven_stops_early(spark, tmp_path):
    """Pages behind the range in which every document has a hit aren't read for it."""
    rows = []
    for doc, hit in (("a", 2), ("b", 3)):
        for page in range(1, 401):
            low = 300.0 if page == hit else 200.0
            rows += [(doc, page, 0, "l", 60.0, 200.0, 190.0, 200.0), (doc, page, 1, "r", 250.0, 390.0, low - 10, low)]
    path = str(tmp_path / "lines")
    spark.createDataFrame(rows, "doc string, page int, ord long, text string, xMin double, xMax double, yMin double, yMax double").repartitionByRange(4, "page").write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def counted(t: pd.Series) -> pd.Series:
        seen.add(len(t))
        return t

    lines = spark.read.parquet(path).withColumn("text", counted("text"))
    got = layout.first_uneven(lines, pages=4).orderBy("doc").collect()
    assert [(r.doc, r.page, r.diff) for r in got] == [("a", 2, 100.0), ("b", 3, 100.0)]
    assert 0 < seen.value < len(rows) // 4
    assert layout.first_uneven(lines.where("doc = 'a' and page > 2"), pages=4).count() == 0
    assert layout.first_uneven(lines.where("false")).count() == 0


def test_only_what_is_told_of_a_line_is_written(spark, monkeypatch):
    """Sections are counted over narrow rows: a line's words don't go through the ranges."""
    from pyspark.sql import functions as F

    from quirefold.operators import layout

    words = spark.createDataFrame([("d", 1, 0, 0, k, 0, f"w{k}", 60.0, 200.0, 90.0 + 11 * k, 100.0 + 11 * k) for k in range(5)], "doc string, page int, flow int, block int, line int, word int, text string, xMin double, xMax double, yMin double, yMax double")
    given, real = [], layout.running
    monkeypatch.setattr(layout, "running", lambda df, *a, **k: given.append(df.columns) or real(df, *a, **k))
    rows = layout.section_runs(words, n=F.size("ws")).orderBy("y").collect()
    assert given == [["doc", "page", "y", "title", "n"]] and [(r.y, r.section, r.n) for r in rows] == [(100 + 11 * k, 0, 1) for k in range(5)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_native_lines_are_not_made_of_words(spark):
    """Lines for first_uneven_block are dealt out once, and aren't taken apart and put together again."""
    data = "/root/testdata/sf0.001"
    plan = plan_of(pages.native_lines(spark, data))
    assert "Generate" not in plan and "collect_list" not in plan and plan.count("Repartition") == 1
    words = pages.boxes(spark, data).where("trim(text) <> ''")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("word", "text"))), lambda x: x["text"]), " ")
    lines = words.groupBy("doc", "page", F.col("line").cast("long").alias("ord")).agg(joined.alias("text"), *[f(c).alias(c) for f, c in ((F.min, "xMin"), (F.max, "xMax"), (F.min, "yMin"), (F.max, "yMax"))])
    got = pages.native_lines(spark, data)
    assert got.columns == lines.columns and got.count() == lines.count() and got.exceptAll(lines).isEmpty()


def test_section_counts_are_those_of_the_lines(spark, monkeypatch):
    """Only counts by page are put in order, no line and no word."""
    words = pages.boxes(spark, "/root/testdata/sf0.001")
    want = layout.section_runs(words).groupBy("doc", "section", "page").agg(F.count("*").alias("lines"))
    put = []
    monkeypatch.setattr(layout, "running", lambda df, *a, f=layout.running, **b: put.append(df) or f(df, *a, **b))
    got = layout.section_counts(words)
    assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert "collect_list" not in plan_of(layout.titled_lines(words))
    layout.section_pages(words)
    assert all(df.columns == ["doc", "page", "place", "lines", "titles"] for df in put) and put[0].count() < layout.page_lines(words).count()
