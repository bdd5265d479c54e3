"""WARC archives as a PySpark Python data source.

Reading plans partitions over the archives' files: each record is a gzip member
of its own whose header carries its compressed length (the ``sl`` extra field),
so a file is split into byte ranges, and a reader can pass over a record after
inflating just its headers.  Predicates on record type and on header columns are
pushed down; they are tested on the headers, and only payloads of records that
pass, and only if payloads are asked for, are inflated whole.

Writing gives every task a file of its own; each commit lists the files of the
tasks that succeeded in a manifest of its own, so what a failed or repeated attempt
left behind is never read.  Appending adds a manifest; overwriting adds one and then
removes those that were there before, with their files.

Defined results (``deduplicate``): a null payload is empty; among payloads of at
least ``least`` bytes that are equal the one with the largest id is a response
and the others revisit it; rows that share that id are all responses; a row
without an id revisits one with an id, and without any all are responses;
repeated rows are written as often as they come; a very long payload is written and
read whole, in one record; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage

from .common import cut, scratch, table

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "_manifest-"
MEMBER = re.compile(rb"\x1f\x8b\x08\x04.{6}\x0c\x00sl\x08\x00", re.DOTALL)
MEMBER_HEAD = 24
RANGE_BYTES = 32 << 20
READ_BYTES = 4 << 20
LEAST_PAYLOAD = 1000
SCHEMA = "record_id string, record_type string, date string, target_uri string, payload_digest string, refers_to string, content_length long, payload_length long, payload binary"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
PUSHED = ("record_id", "record_type", "date", "target_uri", "payload_digest", "refers_to")


def filesystem(path: str):
    """(file system, path in it) for a local path or a URI."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member with the lengths of its compressed and plain data in an extra field."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x0c\0sl\x08\0" + len(body).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little") + body + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")


def clean(value: str) -> str:
    """A header value: control characters and line ends are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict) -> bytes:
    """A response record, or a revisit that names the record it repeats; the payload of a revisit isn't stored."""
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    head = [VERSION.decode(), f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{clean(row['record_id'])}>", f"WARC-Date: {DATE}"]
    if row["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {clean(row['target_uri'])}")
    head.append(f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}")
    if revisit:
        head += [f"WARC-Refers-To: <{clean(row['refers_to'])}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


@dataclass
class FileRange(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    files: list


def headers_of(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if ":" in x)}


def read_range(path: str, start: int, end: int, wanted, payloads: bool) -> Iterator[tuple]:
    """Records whose member begins in [start, end); ``wanted`` judges the header columns."""
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as f:
        size = f.size()
        at = start
        buffer, origin = b"", start

        def need(pos: int, n: int) -> bytes:
            nonlocal buffer, origin
            if pos < origin or pos + n > origin + len(buffer):
                buffer, origin = f.read_at(min(max(n, READ_BYTES), size - pos), pos), pos
            return buffer[pos - origin : pos - origin + n]

        if start:  # the first member that begins at or after the range's start
            while at < size:
                chunk = need(at, min(READ_BYTES, size - at))
                found = MEMBER.search(chunk)
                if found:
                    at += found.start()
                    break
                at += max(1, len(chunk) - MEMBER_HEAD)
        while at < min(end, size):
            head = need(at, MEMBER_HEAD)
            if not MEMBER.match(head):
                raise ValueError(f"{path}: no record at byte {at}")
            length = int.from_bytes(head[16:20], "little")
            begin, following = at + MEMBER_HEAD, at + MEMBER_HEAD + length + 8
            z, text, taken = zlib.decompressobj(-15), b"", 0
            # both header blocks, a kilobyte at a time
            while text.count(b"\r\n\r\n") < 2 and taken < length:
                piece = need(begin + taken, min(1024, length - taken))
                taken += len(piece)
                text += z.decompress(piece)
            warc, _, rest = text.partition(b"\r\n\r\n")
            if not warc.startswith(b"WARC/"):
                raise ValueError(f"{path}: no WARC header at byte {at}")
            h = headers_of(warc)
            http, _, _ = rest.partition(b"\r\n\r\n")
            digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
            plain = lambda v: v[1:-1] if v and v.startswith("<") else v
            row = [plain(h.get("warc-record-id")), h.get("warc-type"), h.get("warc-date"), h.get("warc-target-uri"), digest, plain(h.get("warc-refers-to")), int(h["content-length"]), int(headers_of(http).get("content-length", 0))]
            if wanted(dict(zip(NAMES, row, strict=False))):
                payload = None
                if payloads and h.get("warc-type") != "revisit":
                    if taken < length:
                        text += z.decompress(need(begin + taken, length - taken))
                    text += z.flush()
                    if int.from_bytes(need(following - 8, 4), "little") != zlib.crc32(text):
                        raise ValueError(f"{path}: damaged record at byte {at}")
                    from_http = len(warc) + 4 + len(http) + 4
                    payload = text[from_http : len(warc) + 4 + row[6]]
                yield (*row, payload)
            at = following


def manifests(path: str) -> dict[str, list]:
    """Each manifest's path and the (name, size) of its files."""
    fs, inner = filesystem(path.rstrip("/"))
    found = {}
    for info in fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
        if info.base_name.startswith(MANIFEST):
            with fs.open_input_file(info.path) as f:
                found[info.path] = json.loads(f.read())
    return found


class Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() == "true"
        self.range_bytes = int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))
        self.tests: list[tuple[str, list | None]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in PUSHED and isinstance(f, EqualTo):
                self.tests.append((name, [f.value]))
            elif name in PUSHED and isinstance(f, In):
                self.tests.append((name, list(f.value)))
            elif name in PUSHED and isinstance(f, IsNotNull):
                self.tests.append((name, None))
            else:
                yield f

    def partitions(self) -> list[FileRange]:
        files = [tuple(x) for files in manifests(self.path).values() for x in files]
        base = self.path.rstrip("/")
        return [FileRange(f"{base}/{name}", at, min(size, at + self.range_bytes)) for name, size in sorted(files) for at in range(0, size, self.range_bytes)] or [FileRange("", 0, 0)]

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        tests = self.tests
        wanted = lambda row: all(row[n] is not None if v is None else row[n] is not None and row[n] in v for n, v in tests)
        kinds = [pa.string()] * 6 + [pa.int64(), pa.int64(), pa.binary()]
        rows, size = [], 0
        for row in read_range(partition.path, partition.start, partition.end, wanted, self.payloads):
            rows.append(row)
            size += len(row[-1] or b"")
            if len(rows) == 2000 or size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], NAMES)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], NAMES)


class Writer(DataSourceArrowWriter):
    """Rows need record_id, record_type, target_uri, refers_to and payload."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, inner = filesystem(self.path)
        name, size, out = f"part-{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in iterator:
            if out is None and batch.num_rows:
                fs.create_dir(inner, recursive=True)
                out = fs.open_output_stream(f"{inner}/{name}", compression=None)
            for row in batch.to_pylist():
                data = record(row)
                out.write(data)
                size += len(data)
        if out is None:
            return Written([])
        out.close()
        return Written([(name, size)])

    def commit(self, messages: list[Written | None]) -> None:
        fs, inner = filesystem(self.path)
        fs.create_dir(inner, recursive=True)
        before = manifests(self.path) if self.overwrite else {}
        with fs.open_output_stream(f"{inner}/{MANIFEST}{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())
        for manifest, files in before.items():
            fs.delete_file(manifest)
            for name, _ in files:
                fs.delete_file(f"{inner}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, inner = filesystem(self.path)
        for name, _ in (x for m in messages if m for x in m.files):
            fs.delete_file(f"{inner}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc")``; options: path, payload (true or false), rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def deduplicate(spark: SparkSession, pages: DataFrame, *, id_col: str, payload: str, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Adds __type and __refers to rows with a binary ``payload`` column.

    Only digests that repeat are kept for the join; written first, their size is
    known, and Spark broadcasts them only below its own threshold.
    """
    key = F.sha2(F.col(payload), 256)
    repeated = pages.where(F.octet_length(payload) >= least).groupBy(key.alias("__key")).agg(F.count("*").alias("__n"), F.max(id_col).alias("__best")).where((F.col("__n") > 1) & F.col("__best").isNotNull()).select("__key", "__best")
    repeated = cut(spark, repeated, "warc-repeated")
    joined = pages.withColumn("__key", F.when(F.octet_length(payload) >= least, key)).join(repeated, "__key", "left")
    revisit = F.col("__best").isNotNull() & ~F.col("__best").eqNullSafe(F.col(id_col))
    return joined.withColumn("__type", F.when(revisit, "revisit").otherwise("response")).withColumn("__refers", F.when(revisit, F.col("__best"))).drop("__key", "__best")


URN = "urn:quirefold:page:"


def archive(spark: SparkSession, pages: DataFrame, path: str) -> None:
    """Writes (page_id, url, html) rows as WARC files below ``path``."""
    register(spark)
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    named = deduplicate(spark, rows, id_col="page_id", payload="payload")
    urn = lambda c: F.concat(F.lit(URN), F.coalesce(F.col(c).cast("string"), F.lit("")))
    out = named.select(urn("page_id").alias("record_id"), F.col("__type").alias("record_type"), F.col("url").cast("string").alias("target_uri"), F.when(F.col("__refers").isNotNull(), urn("__refers")).alias("refers_to"), "payload")
    out.write.format("warc").mode("append").option("path", path).save()


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for every row of ``pages``, written and read back by pushed-down record types."""
    path = scratch(spark, "warc")
    archive(spark, table(spark, sf_dir, "pages"), path)
    read = lambda kind, payload: spark.read.format("warc").option("path", path).option("payload", payload).load().where(F.col("record_type") == kind)
    number = lambda c: F.when(F.length(c) > len(URN), F.substring(c, len(URN) + 1, 40)).cast("long")
    # the digest of a stored payload is taken anew from what was read; of revisits only headers are read
    stored = read("response", "true").select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to")
    again = read("revisit", "false").select("record_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return stored.unionAll(again).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
