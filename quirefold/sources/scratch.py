"""Tables and files written between steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only local sessions without one get a temporary folder."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        own = sc._jsc.sc().getCheckpointDir()
        if own.isDefined():
            base = str(own.get())
        elif not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset; a cluster needs a folder that all executors share")
        else:
            base = "file://" + tempfile.mkdtemp(prefix="quirefold-")
            sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Characters of files that a task holds before it passes them on.
READ_CHARS = 4_000_000
#: Session setting: shuffle files go when the query that wrote them ends, and not whenever the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once and read from there; what was shuffled to make them goes as soon as they are written."""
    path = scratch(df.sparkSession, name)
    df.sparkSession.conf.set(CLEANUP, "true")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Writes each row's ``src`` to ``path`` below a new folder, from the executors; returns (path, bytes) of what was written.

    A file is written whole under its final name, so a task that is run again writes the same.
    Names that end in ``.gz`` are written compressed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(inner, recursive=True)
        for b in batches:
            sizes = []
            for path, src in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = (src or "").encode()
                with store.open_output_stream(f"{inner}/{path}", compression="gzip" if path.endswith(".gz") else None) as out:
                    out.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return stored(files.select("path", "src").mapInArrow(run, "path string, bytes long"), "written")


def write_lines(rows: DataFrame, order: list[str], folder: str) -> DataFrame:
    """Writes files below a new folder from their lines (path, line) in ``order``, line by line, so that no row and no task holds a file; returns (path, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(inner, recursive=True)
        every = (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for path, own in groupby(every, lambda x: x[0]):
            with store.open_output_stream(f"{inner}/{path}", compression=None, buffer_size=1 << 20) as out:
                size = 0
                for k, (_, line) in enumerate(own):
                    size += out.write(b"\n" * (k > 0) + (line or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([size], pa.int64())], ["path", "bytes"])

    dealt = rows.repartition("path").sortWithinPartitions("path", *order).select("path", "line")
    return stored(dealt.mapInArrow(run, "path string, bytes long"), "written")


def listed_files(written: DataFrame, folder: str) -> DataFrame:
    """(path, src) of the files below ``folder`` that ``written`` (path) names, read by the executors.

    No one lists the folder, so the driver holds nothing of its files, however many there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
        for b in batches:
            held, size = [], 0
            for path in b.column(0).to_pylist():
                with store.open_input_stream(f"{inner}/{path}", compression="gzip" if path.endswith(".gz") else None) as file:
                    held.append((path, file.read().decode()))
                size += len(held[-1][1])
                if size > READ_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], ["path", "src"])
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], ["path", "src"])

    return written.select("path").mapInArrow(run, "path string, src string")
