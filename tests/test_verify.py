"""Two small editions through the whole comparison, its summaries, files and self-checks."""

import pytest
from pyspark.sql import functions as F

from quirefold.operators import checks, summary, tex
from quirefold.operators.diff import Comparison, glyph_log, last_wins, text_changes
from quirefold.plans.verify import verify
from quirefold.sources import files as fs

TEX = {
    "p001.tex": "\\upaper{1}{One}\n\\usection{A}\n\\vs p001 1:1 alpha beta gamma delta, and so it goes. Then More words.\n\\vs p001 1:2 an \\bibemph{odd} word\u2019s",
    "p002.tex": "\\upaper{2}{Two}\n\\usection{A}\n\\usectiontwo{2 and 3}{B}\n\\vs p002 1:1 same\n\\vs p002 2:1 moved\n\\vs p002 1:5 only here\n\\vs p002 1:6 skipped text\n\\vs p002 1:7 \\bibemph{loose}\n\\vs p002 1:8 first\n\\vs p002 1:8 second",
}
HTML = {
    "BookPaper001.html": '<h1 id="U1_0_0">Paper 1. One</h1><h2 id="U1_1_0">1. A</h2><p id="U1_1_1">alpha beta gamma delta, and so it goes. Then More words.</p><p id="U1_1_2">an <em>odd</em> word\u02bcs</p>',
    "BookPaper002.html": '<h1 id="U2_0_0">Paper 2. Deux</h1><h2 id="U2_1_0">1. A</h2><h2 id="U2_4_0">4. New</h2><p id="U2_1_1">sane</p><p id="U2_3_1">moved</p><p id="U2_1_6">other</p><p id="U2_1_7">loose</p><p id="U2_1_8">second</p><p id="U2_1_9">extra</p>',
}
ALLOW = """# accepted
2:1:6:
  skip: true
  reason: "known"
2:1:7-8:
  ignore_italics: yes
  unknown: x
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("book")
    for sub, papers in (("tex", TEX), ("html", HTML)):
        (base / sub).mkdir()
        for name, text in papers.items():
            (base / sub / name).write_text(text, encoding="utf-8")
    (base / "tex" / "p1-sections.tex").write_text("\\nothing")
    (base / "allow.yaml").write_text(ALLOW)
    return base


@pytest.fixture(scope="module")
def compared(spark, folder) -> Comparison:
    return verify(spark, str(folder / "tex"), str(folder / "html"), str(folder / "allow.yaml"))


def test_mismatches(compared):
    got = {(r.paper, r.kind, r.section, r.verse, r.detail) for r in compared.mismatches.collect()}
    assert got == {
        (2, "PAPER_TITLE", None, None, "paper titles differ"),
        (2, "SECTION_TITLE", 2, None, "missing on the right"), (2, "SECTION_TITLE", 3, None, "missing on the right"), (2, "SECTION_TITLE", 4, None, "missing on the left"),
        (2, "STRUCT", 1, 8, "duplicate key on the left"), (2, "STRUCT", 1, 5, "only_left"), (2, "STRUCT", 1, 9, "only_right"),
        (2, "TEXT", 1, 1, "text"),
    }
    assert compared.errors().count() == 0


def test_summaries(compared):
    rows = {r.paper: r for r in summary.paper_summary(compared).collect()}
    assert rows[1].status == "CLEAN" and rows[1].common == 2
    r = rows[2]
    assert (r.left_verses, r.right_verses, r.common, r.only_left, r.only_right, r.text_diffs, r.italic_diffs, r.mismatches, r.status) == (7, 6, 5, 1, 1, 1, 0, 8, "FAIL")
    t = summary.totals(summary.paper_summary(compared)).first()
    assert (t.papers, t.clean, t.failed, t.mismatches) == (2, 1, 1, 8)
    kinds = summary.by_kind(compared.mismatches).collect()
    assert {(k.kind, k.n) for k in kinds} == {("SECTION_TITLE", 3), ("STRUCT", 3), ("PAPER_TITLE", 1), ("TEXT", 1)}
    assert [r.n for r in kinds] == sorted((r.n for r in kinds), reverse=True)
    report = summary.paper_report(compared, 2)
    assert "- Status: FAIL" in report and "- Titles: `Two` `Deux`" in report and "## Text" not in report.replace("## Text\n### 2:1:1", "") and "- **STRUCT** 1:5 only_left" in report
    assert "## Italics" not in report and "absent" in summary.paper_report(compared, 9)
    book = summary.book_report(compared)
    assert "clean 1" in book and "### Paper 2" in book and "- **PAPER_TITLE** paper titles differ" in book and "### Paper 1" not in book


def test_reports_tell_what_they_leave_out(compared):
    rows = {r.paper: r.report for r in summary.paper_reports(compared, most=0).collect()}
    assert "more text differences" not in rows[1]
    details = {r.paper: r.text for r in summary.failed_details(compared, most=3).collect()}
    assert details[2].endswith("... (5 more in the paper's own report)") and details[2].count("- **") == 3
    back = {r.paper: r for r in summary.read_reports(summary.paper_reports(compared)).collect()}
    assert (back[2].left_verses, back[2].right_verses, back[2].common, back[2].only_left, back[2].text_diffs, back[2].status, back[2].mismatches) == (7, 6, 5, 1, 1, "FAIL", 8)


def test_glyphs_and_changes(compared):
    assert [tuple(r) for r in glyph_log(compared.compared).collect()] == [(1, 1, 2, "right", "MODIFIER_APOSTROPHE", 1)]
    assert [(r.tag, r.left, r.right) for r in text_changes(compared.compared).collect()] == [("replace", "m", "n")]


def test_files(spark, folder, tmp_path):
    t = fs.tex_files(spark, str(folder / "tex"))
    assert t.count() == 2
    wanted = spark.createDataFrame([(1,), (2,), (3,)], "paper int")
    assert [tuple(r) for r in fs.file_problems(t, wanted).collect()] == [(3, 0)]
    papers = tex.tex_papers(t)
    fs.write_jsonl(papers, str(tmp_path / "j"))
    heads, verses = fs.read_jsonl(spark, str(tmp_path / "j"))
    assert {(r.paper, r.title) for r in heads.collect()} == {(1, "One"), (2, "Two")}
    cols = ["paper", "section", "verse", "text", "italics"]
    assert sorted(map(str, verses.select(cols).collect())) == sorted(map(str, fs.verses_of(papers).select(cols).collect()))
    assert fs.only(verses, [2]).select("paper").distinct().count() == 1
    src = "\\vs p001 1:1 \\ublistelem{1.} a"
    fixed = fs.write_fixed(spark.createDataFrame([("p", src), ("q", "x")], "path string, src string"), str(tmp_path / "f"))
    assert [tuple(r) for r in fixed.collect()] == [("p", 1)]
    assert (tmp_path / "f" / "p").read_text() == "\\pc " + src and not (tmp_path / "f" / "q").exists()


def test_lines_keep_their_order(spark, tmp_path):
    """The last line of a key wins, also where a file is read in several splits."""
    (tmp_path / "j").mkdir()
    lines = [f'{{"paper": 1, "section": 1, "verse": {i % 50}, "text": "t{i}"}}' for i in range(20_000)]
    (tmp_path / "j" / "a.json").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        _, verses = fs.read_jsonl(spark, str(tmp_path / "j"))
        assert verses.rdd.getNumPartitions() > 5
        assert {(r.verse, r.text) for r in last_wins(verses).collect()} == {(i % 50, f"t{i}") for i in range(19_950, 20_000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_deviations(spark, folder):
    rows = {(r.paper, r.section, r.verse): r for r in fs.read_deviations(spark, str(folder / "allow.yaml")).collect()}
    assert rows[2, 1, 6].skip and rows[2, 1, 6].reason == "known" and rows[2, 1, 8].ignore_italics and len(rows) == 3
    assert fs.read_deviations(spark, str(folder / "absent.yaml")).count() == 0
    lines = spark.createDataFrame([(0, "1:1:5-2:"), (1, "  skip: true")], "n int, line string")
    with pytest.raises(Exception, match="invalid range 5-2"):
        fs.deviation_rows(lines).collect()
    twice = spark.createDataFrame(list(enumerate(["1:1:1:", "  skip: true", "", "1:1:1-2:", "  skip: 'false'"])), "n int, line string")
    assert {(r.verse, r.skip) for r in fs.deviation_rows(twice).collect()} == {(1, False), (2, False)}


def test_coverage(spark, folder):
    t = tex.token_table(fs.tex_files(spark, str(folder / "tex")).unionByName(spark.createDataFrame([("x", "\\mystery \\pc")], "path string, src string")))
    rows = summary.macro_coverage(t).collect()
    assert rows[0].value == "vs" and rows[0].n == 9 and rows[0].known and len(rows[0].places) == 3 and rows[0].places[0] == "p001.tex:3:1"
    assert [r.name for r in summary.unknown_macros(t).collect()] == ["mystery"]
    report = summary.coverage_report(t)
    assert "# unknown: 1\n# unknown mystery" in report and "KNOWN 9 \\vs\n    at p001.tex:3:1" in report


def test_self_checks(spark, folder, compared):
    t, h = fs.tex_files(spark, str(folder / "tex")), fs.html_files(spark, str(folder / "html"))
    counts = checks.recount(t, h, compared.left_verses, compared.right_verses).collect()
    assert all(r.ok for r in counts) and len(counts) == 2
    assert checks.deterministic(lambda: fs.verses_of(tex.tex_papers(t)))
    assert checks.digest(compared.left_verses) != checks.digest(compared.right_verses)
    # the second paper's sides differ as they are, the first's only before glyphs are normalized
    assert checks.mutation_check(t, h).count() == 0
    plain = h.withColumn("src", F.replace("src", F.lit("\u02bc"), F.lit("\u2019")))
    caught = {(r.paper, r.mutant): r.caught for r in checks.mutation_check(t, plain).collect()}
    assert caught == {(1, m): True for m in ("double_word", "lose_verse", "shift_number", "mark_word", "cut_letter", "unmark_word")} | {k: v for k, v in caught.items() if k[1] in ("comma_to_dot", "lose_sentence")}
    spot = checks.spot_check(compared.left_verses, compared.right_verses, 4)
    assert spot.count() == 4 and [tuple(r) for r in spot.collect()] == [tuple(r) for r in checks.spot_check(compared.left_verses.repartition(3), compared.right_verses, 4).collect()]


def test_combined_remap(compared):
    assert compared.left_keyed.where("section = 3").select("text").first()[0] == "moved"
    assert compared.left_keyed.where(F.col("section") == 2).count() == 0


def test_strict_runs_stop_at_their_gates(spark, folder, tmp_path):
    """A missing, a doubled and a broken paper and a lost verse are all told; the same run goes through when it isn't strict."""
    import shutil

    from quirefold.operators import gates
    from quirefold.plans.verify import verify

    shutil.copytree(folder, tmp_path / "in")
    tex_dir, html_dir = tmp_path / "in" / "tex", tmp_path / "in" / "html"
    run = lambda **more: verify(spark, str(tex_dir), str(html_dir), **more)
    one = next(p for p in html_dir.iterdir() if p.name.endswith("Paper001.html"))
    shutil.copy(one, html_dir / "AgainPaper001.html")
    with pytest.raises(gates.GateError, match="files right paper 1: 2 files"):
        run(strict=True)
    assert run().observed()["right"]["papers"] >= 3
    (html_dir / "AgainPaper001.html").unlink()
    (tex_dir / "p009.tex").write_text("\\vs p009 1:1 alone")
    with pytest.raises(gates.GateError, match="files right paper 9: 0 files"):
        run(strict=True)
    # chosen papers are picked before anything is parsed or checked
    assert run(strict=True, papers=[1]).observed() == {side: {"papers": 1, "broken": 0, "verses": n} for side, n in (("left", run(papers=[1]).left_verses.count()), ("right", run(papers=[1]).observed()["right"]["verses"]))}
    (tex_dir / "p009.tex").unlink()
    one.write_text(one.read_text() + '<!--<p id="U1_1_77">hidden</p>-->')
    with pytest.raises(gates.GateError, match="recount right paper 1") as told:
        run(strict=True, papers=[1])
    assert told.value.total == 1
    (tex_dir / "p001.tex").write_text("\\nosuchmacro")
    with pytest.raises(gates.GateError, match="parse left paper 1"):
        run(strict=True, papers=[1])


def test_digests_tell_papers_apart(spark, compared):
    before = checks.paper_digests(compared.left_verses)
    again = checks.paper_digests(compared.left_verses.repartition(7))
    assert checks.changed_papers(before, again).count() == 0
    other = compared.left_verses.withColumn("text", F.when(F.expr("paper = 1 and verse = 1 and section = 1"), "x").otherwise(F.col("text"))).where("paper <> 2")
    assert {tuple(r) for r in checks.changed_papers(before, checks.paper_digests(other)).collect()} == {(1, "changed"), (2, "gone")}
    assert {tuple(r) for r in checks.changed_papers(checks.paper_digests(other), before).collect()} == {(1, "changed"), (2, "new")}


def test_book_report_is_written_in_order(spark, compared, tmp_path):
    """The files' lines, in the order of names and lines, are the report; many files hold it, the driver none of it."""
    summary.write_book_report(compared, str(tmp_path / "report"), 5)
    files = sorted((tmp_path / "report").glob("part-*"))
    assert len(files) > 1 and "".join(f.read_text() for f in files) == summary.book_report(compared)
    read = summary.read_in_order(spark, str(tmp_path / "report")).orderBy("file", "n").collect()
    assert "\n".join(r.line for r in read) + "\n" == summary.book_report(compared)


def test_token_table_in_sql(spark, folder):
    tex.register(spark)
    fs.tex_files(spark, str(folder / "tex")).createOrReplaceTempView("token_sources_test")
    got = spark.sql("SELECT * FROM token_table(TABLE(token_sources_test) PARTITION BY path)")
    assert got.columns == ["path", "ord", "kind", "value", "line", "col"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, tex.token_table(fs.tex_files(spark, str(folder / "tex"))).collect()))
    with pytest.raises(Exception, match="key and a source"):
        spark.sql("SELECT * FROM token_table('x')").collect()


def test_mutants_are_parsed_once(spark, monkeypatch):
    """Each source, damaged or not, goes through its parser once."""
    import pyarrow as pa

    from quirefold.operators import checks

    seen = {side: spark.sparkContext.accumulator(0) for side in ("tex", "html")}

    def counting(side, parse):
        n = seen[side]

        def run(batches):
            for b in batches:
                n.add(b.num_rows)
                yield pa.RecordBatch.from_arrays(b.columns, ["path", "src"])

        return lambda files: parse(files.select("path", "src").mapInArrow(run, "path string, src string"))

    monkeypatch.setattr(checks, "tex_papers", counting("tex", checks.tex_papers))
    monkeypatch.setattr(checks, "html_papers", counting("html", checks.html_papers))
    left = spark.createDataFrame([(f"p00{k}.tex", f"\\upaper{{{k}}}{{T}}\n\\vs p00{k} 1:1 word \\bibemph{{a}} b, c. d. e.") for k in (1, 2)], "path string, src string")
    right = spark.createDataFrame([(f"Paper00{k}.html", f'<p id="U{k}_1_1">word <em>a</em> b, c. d. e.</p>') for k in (1, 2)], "path string, src string")
    got = checks.mutation_check(left, right).collect()
    assert sorted((r.paper, r.mutant, r.caught) for r in got) == sorted((k, d[0], True) for k in (1, 2) for d in checks.DAMAGE)
    assert {side: n.value for side, n in seen.items()} == {"tex": 14, "html": 6}
