"""Page boxes as a data source: files cut in byte ranges, pages numbered by a counting pass, a page filter that picks ranges.

A page is what ends in ``</page>``; it belongs to the range in which it begins, which
is where the page before it ends, so each page is read once however files are cut.  The
counting pass gives each range the number of its first page; with it, ranges that hold
none of the pages asked for are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..operators.ordered import running
from ..schemas import BBOX_PAGE
from .scratch import scratch

END = b"</page>"
RANGE_BYTES, READ_BYTES = 64 << 20, 1 << 20
#: Small ranges are read several a task: up to so many bytes, while there are so many tasks.
TASK_BYTES, TASKS = 16 << 20, 64
BEYOND_BYTES = 16 << 10
COUNTS = "doc string, start long, length long, pages long"
PAGES = "doc string, page int, xml string"
FAR = 2**31 - 1


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


class Range(NamedTuple):
    doc: str
    start: int
    length: int
    first: int


class Ranges(InputPartition):
    """Ranges that one task reads: however small they are cut, several together."""

    def __init__(self, ranges: list[Range]) -> None:
        self.ranges = ranges


def pages_in(folder: str, part: Range) -> Iterator[bytes]:
    """The pages that begin in the range, each with its closing tag."""
    store, inner = opened(folder)
    with store.open_input_file(f"{inner.rstrip('/')}/{part.doc}") as f:
        size, stop = f.size(), part.start + part.length
        # a page begins behind a closing tag; one that straddles the range's start counts here
        at = max(0, part.start - len(END))
        held, origin, begun = b"", at, part.start == 0
        while True:
            k = held.find(END)
            if k < 0:
                if at >= size or not begun and origin + len(held) >= stop + len(END):
                    return
                # up to the range's end, then in pieces for the page that reaches beyond
                piece = f.read_at(min(READ_BYTES, size - at, max(stop - at, BEYOND_BYTES)), at)
                at += len(piece)
                held += piece
                continue
            if begun:
                yield held[: k + len(END)]
            held, origin = held[k + len(END) :], origin + k + len(END)
            if origin >= stop:
                return
            begun = True


class BoxReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.bytes = int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))
        self.index = options.get("index")
        self.low, self.high, self.picked = 1, FAR, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if self.index and getattr(f, "attribute", None) == ("page",):
                if isinstance(f, EqualTo | In):
                    self.picked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                elif isinstance(f, LessThan | LessThanOrEqual):
                    self.high = min(self.high, f.value - isinstance(f, LessThan))
            yield f  # ranges are picked by it; their rows are judged by Spark

    def ranges(self) -> list[Range]:
        store, inner = opened(self.path)
        if self.index:
            own, at = opened(self.index)
            rows = pq.read_table(at, filesystem=own).to_pylist()
            wanted = lambda a, n: n and a <= self.high and a + n > self.low and (self.picked is None or any(a <= p < a + n for p in self.picked if p is not None))
            return [Range(r["doc"], r["start"], r["length"], r["first"]) for r in rows if wanted(r["first"], r["pages"])]
        files = [f for f in store.get_file_info(pafs.FileSelector(inner)) if f.is_file and f.base_name.endswith(("html", "xml")) and not f.base_name.startswith(("_", "."))]
        return [Range(f.base_name, at, min(self.bytes, f.size - at), 1) for f in sorted(files, key=lambda f: f.base_name) for at in range(0, f.size, self.bytes)]

    def partitions(self) -> list[Ranges]:
        out: list[list[Range]] = [[]]
        ranges, size = self.ranges(), 0
        most = max(self.bytes, min(TASK_BYTES, sum(r.length for r in ranges) // TASKS))
        for r in ranges:
            if out[-1] and size + r.length > most:
                out.append([])
                size = 0
            out[-1].append(r)
            size += r.length
        return [Ranges(some) for some in out]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        if not self.index:
            counts = [(r.doc, r.start, r.length, sum(1 for _ in pages_in(self.path, r))) for r in partition.ranges]
            yield pa.RecordBatch.from_arrays([pa.array([c[k] for c in counts], pa.int64() if k else pa.string()) for k in range(4)], ["doc", "start", "length", "pages"])
            return
        held, size = [], 0
        for r in partition.ranges:
            for page, raw in enumerate(pages_in(self.path, r), r.first):
                held.append((r.doc, page, raw[max(raw.find(b"<page"), 0) :].decode()))
                size += len(raw)
                if size > READ_BYTES:
                    yield self.batch(held)
                    held, size = [], 0
        if held:
            yield self.batch(held)

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        doc, page, xml = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(page, pa.int32()), pa.array(xml)], ["doc", "page", "xml"])


class PageBoxes(DataSource):
    """Options: path (a folder), rangeBytes, and index (a table of ``box_index``); without an index, the ranges with their pages counted."""

    @classmethod
    def name(cls) -> str:
        return "page_boxes"

    def schema(self) -> str:
        return PAGES if self.options.get("index") else COUNTS

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return BoxReader(dict(self.options))


def ready(spark: SparkSession) -> None:
    spark.dataSource.register(PageBoxes)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def box_index(spark: SparkSession, path: str, *, range_bytes: int = RANGE_BYTES) -> str:
    """Counts the pages of all ranges and writes (doc, start, length, pages, first: the number of the first page); returns where."""
    ready(spark)
    counted = spark.read.format("page_boxes").option("rangeBytes", range_bytes).load(path)
    upto = running(counted, ["doc"], ["start"], sums={"upto": F.col("pages")})
    index = scratch(spark, "box-index")
    upto.select("doc", "start", "length", "pages", (F.col("upto") - F.col("pages") + 1).alias("first")).write.parquet(index)
    return index


def box_pages(spark: SparkSession, path: str, *, index: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc, page, xml) of a folder of box documents; a filter on ``page`` reads only the ranges that hold such pages."""
    index = index or box_index(spark, path, range_bytes=range_bytes)
    ready(spark)
    return spark.read.format("page_boxes").option("index", index).option("rangeBytes", range_bytes).load(path)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(doc, page, body) with the fixed schema, as ``files.bbox_pages`` gives it."""
    return pages.select("doc", "page", F.from_xml("xml", F.lit(BBOX_PAGE), {"ignoreNamespace": "true"}).alias("body"))
