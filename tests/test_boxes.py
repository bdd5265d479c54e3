"""The box data source: every page once however files are cut, and filters that pick ranges."""

import pytest
from pyspark.sql import functions as F

from quirefold.sources import boxes
from quirefold.sources import files as fs


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("boxes")
    word = lambda d, p: f'<word xMin="1" yMin="2" xMax="3.5" yMax="4">{d}é{p}</word>'
    for d, n in (("a", 23), ("b", 1), ("c", 0)):
        pages = "".join(f'<page width="10"><flow><block><line xMin="1" yMin="2" xMax="3" yMax="4">{word(d, p) * (p % 4)}</line></block></flow></page>\n' for p in range(1, n + 1))
        (path / f"{d}_bbox.html").write_text(f'<?xml version="1.0"?><html xmlns="x"><doc>\n{pages}</doc></html>', encoding="utf-8")
    (path / "_SUCCESS").write_text("")
    return str(path)


@pytest.mark.parametrize("size", [1, 7, 8, 100, 333, 1 << 20])
def test_every_page_once(spark, folder, size):
    if size < 50:  # without Spark: many small ranges
        reader = boxes.BoxReader({"path": folder, "rangeBytes": size})
        got = {}
        for r in reader.ranges():
            got.setdefault(r.doc, []).extend(boxes.pages_in(folder, r))
        assert {d: len(p) for d, p in got.items()} == {"a_bbox.html": 23, "b_bbox.html": 1, "c_bbox.html": 0}
        return
    pages = boxes.box_pages(spark, folder, range_bytes=size)
    rows = sorted((r.doc, r.page, r.xml) for r in pages.collect())
    assert [(d, p) for d, p, _ in rows] == [("a_bbox.html", k) for k in range(1, 24)] + [("b_bbox.html", 1)]
    assert all(f"aé{p}<" in x or p % 4 == 0 for d, p, x in rows if d[0] == "a")
    words = lambda df: sorted(map(repr, fs.bbox_words(df).collect()))
    assert words(boxes.parsed_pages(pages)) == words(fs.bbox_pages(spark, folder))


def test_a_page_filter_picks_ranges(spark, folder):
    index = boxes.box_index(spark, folder, range_bytes=200)
    pages = boxes.box_pages(spark, folder, index=index, range_bytes=200)
    assert pages.rdd.getNumPartitions() > 10
    one = pages.where("page = 20 and doc = 'a_bbox.html'")
    assert one.rdd.getNumPartitions() == 1 and [r.page for r in one.collect()] == [20]
    some = pages.where(F.col("page").isin(2, 21) | F.lit(False))
    assert some.rdd.getNumPartitions() == 2 and sorted(r.page for r in some.collect()) == [2, 21]
    last = pages.where("page > 20 and page <= 22")
    assert last.rdd.getNumPartitions() < 4 and sorted(r.page for r in last.collect()) == [21, 22]


def test_small_ranges_share_tasks(spark, tmp_path):
    """The number of tasks follows the bytes that are read, not the number of ranges."""
    page = '<page width="10"><flow><block><line xMin="1" yMin="2" xMax="3" yMax="4"><word xMin="1" yMin="2" xMax="3.5" yMax="4">w</word></line></block></flow></page>\n'
    for d in range(300):
        (tmp_path / f"d{d}_bbox.html").write_text(f"<html><doc>\n{page * 3}</doc></html>", encoding="utf-8")
    reader = boxes.BoxReader({"path": str(tmp_path), "rangeBytes": 200})
    assert len(reader.ranges()) > 600 and len(reader.partitions()) < 110
    pages = boxes.box_pages(spark, str(tmp_path), range_bytes=200)
    assert pages.count() == 900 and pages.where("page = 3").count() == 300
