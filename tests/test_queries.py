"""Registered queries against their SQL on the smallest driver tables, and the entry module without the llm parts."""

import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from quirefold.plans import queries as q

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables absent")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@needs_data
@pytest.mark.parametrize("name", sorted(q.queries()))
def test_query(spark, duck, name):
    got = q.queries()[name](spark, DATA)
    rows = sorted(repr(tuple(r[c] for c in sorted(got.columns))) for r in got.collect())
    if name not in q.oracle_sql():
        assert rows
        return
    want = duck.sql(q.oracle_sql()[name])
    assert sorted(want.columns) == sorted(got.columns)
    at = [want.columns.index(c) for c in sorted(want.columns)]
    assert rows == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


def test_entry_without_llm(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "quirefold", tmp_path / "quirefold", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert 'line_explode' in e.queries() and not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)}, timeout=120)


def test_nothing_else_imports_llm():
    for f in (ROOT / "quirefold").rglob("*.py"):
        if "llm" not in f.parts:
            assert not re.search(r"\bllm\b", f.read_text(encoding="utf-8")), f


def test_headings_with_unclosed_references(spark, tmp_path):
    """A reference without its semicolon is read as one, by the query and by its SQL."""
    import duckdb

    rows = [(1, "<h1>a &amp</h1><h2>b &lt c &gt;d &quot e</h2><h3>&amp;lt &#39 f&#391; &#39;</h3>"), (2, None)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = sorted(tuple(r) for r in q.queries()["html_extract_headings"](spark, str(tmp_path)).select("page_id", "k", "level", "heading").collect())
    want = sorted(c.sql(f"SELECT page_id, k, level, heading FROM ({q.oracle_sql()['html_extract_headings']})").fetchall())
    assert got[0] == (1, 0, "h1", "a &") and got[:2] == want[:2]
    assert got[2][3] == "&lt ' fƇ '" and want[2][3] == "&lt ' f&#391; '"  # other references are not among the SQL's five


def test_gates_of_a_doubled_file_that_lost_its_verse(spark, tmp_path):
    """Paper 5831 has one verse, whose file comes twice and hides another: two verses, two ids, yet not the same."""
    import duckdb

    rows = [(5831, "one line"), (5832, "one line\nand two"), (5, "left missing"), (2, "twice\nthere")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(tuple(r) for r in q.queries()["gate_findings"](spark, str(tmp_path)).select("gate", "paper", "side").collect())
    assert got == sorted(c.sql(f"SELECT gate, paper, side FROM ({q.oracle_sql()['gate_findings']})").fetchall())
    assert ("recount", 5831, "right") in got


def test_digests_are_made_once(spark, monkeypatch, tmp_path):
    from quirefold.operators import checks

    spark.createDataFrame([(1, "one line\nand two")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made, digest = [], checks.digest
    monkeypatch.setattr(checks, "digest", lambda df: made.append(digest(df)) or made[-1])
    assert tuple(q.queries()["extract_digest"](spark, str(tmp_path)).first()) == (3, 1, True, True)
    assert len(made) == 3 and len(set(made)) == 2


def test_sources_move_no_text(spark):
    """Both markups are made where a document's row is: neither plan deals anything out."""
    from quirefold.plans import editions as ed

    for side in ed.editions(spark, DATA):
        assert "Exchange" not in side._jdf.queryExecution().executedPlan().toString()


def test_documents_that_share_a_number(spark, tmp_path):
    """Their lines are one paper's, in the order of line numbers; blank and null texts make no paper."""
    from quirefold.plans import editions as ed

    rows = [(1, "b one\n\nb two"), (1, "a one"), (2, "%{}\n - "), (3, None), (4, "one\nand  two")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.paper: [(v.k, v.first, v.rest) for v in r.vs] for r in ed._sources(spark, str(tmp_path)).collect()}
    assert got == {1: [(1, "a", " one"), (1, "b", " one"), (3, "b", " two")], 4: [(1, "one", ""), (2, "and", " two")]}


def test_only_reported_texts_are_written(spark):
    """Of verses that agree, and hold no odd glyph, no text is kept; what was shuffled goes when it is written."""
    from quirefold.plans import editions as ed
    from quirefold.sources.scratch import CLEANUP

    spark.conf.unset(CLEANUP)
    c = ed._compared(spark, DATA)
    assert spark.conf.get(CLEANUP) == "true"
    same = c.compared.where("status = 'same' and paper % 4 <> 1 and not skip")
    assert same.count() and not same.where("nl is not null or nr is not null or left_raw is not null or right_raw is not null").count()


def test_layout_files_are_not_listed_by_the_driver(spark):
    from quirefold.plans import pages

    found = pages.text_layout_files(spark, DATA)
    assert not [f for f in found.inputFiles() if "/layouts-" in f]
    assert found.count() == pages.text_layout_blocks(spark, DATA).count()


def test_layouts_of_rows_that_share_an_id(spark, tmp_path):
    from quirefold.plans import pages

    text = "\n".join(f"line {k} " + "y" * 50 for k in range(12))
    spark.createDataFrame([(1, text), (1, "other"), (2, text), (3, None), (4, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc: r.value for r in pages._cells(spark, str(tmp_path)).collect()}
    assert sorted(got) == [1, 2, 4] and [len(p.split("\n")) for p in got[2].split("\f")] == [10, 2] and [len(p.split("\n")) for p in got[1].split("\f")] == [11, 2]
    assert got[1].split("\f")[1] == got[2].split("\f")[1] and got[2].split("\f")[1].startswith("line 10 ")


def test_box_files_are_compressed_and_move_no_page(spark, monkeypatch):
    """Documents are written compressed; what is read is numbered and parsed in the task that read it."""
    from quirefold.plans import pages

    made, write = [], pages.write_files
    monkeypatch.setattr(pages, "write_files", lambda files, folder: made.append(write(files, folder)) or made[-1])
    found = pages.box_files(spark, DATA)
    assert made[0].where("path like '%.gz'").count() == made[0].count() > 0
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_totals_of_findings_write_no_texts_and_move_no_words(spark, monkeypatch):
    from quirefold.operators import layout
    from quirefold.plans import pages

    kept, stored = [], layout.stored
    monkeypatch.setattr(layout, "stored", lambda df, name: kept.append((name, stored(df, name))) or kept[-1][1])
    n = {r.kind: r.n for r in pages.findings_totals(spark, DATA).collect()}
    assert [name for name, _ in kept] == ["ends"] and kept[0][1].where("l.text <> '' or r.text <> ''").count() == 0 < kept[0][1].where("l is not null").count()
    assert n["uneven"] == pages.uneven_columns(spark, DATA).count() and n["orphan"] == pages.orphan_lines(spark, DATA).count()
    plan = pages.orphan_lines(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and not any("row_number" in x.lower() and "side" in x for x in plan.splitlines() if "Exchange" in x)
