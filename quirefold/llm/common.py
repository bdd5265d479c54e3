"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about this many characters, so that memory
#: follows the longest single text and not the number of rows in a batch.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (local tests) a temporary folder is made and set.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        jvm_dir = sc._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            return str(jvm_dir.get())
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset; a cluster needs a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quirefold-")
        sc.setCheckpointDir(found)
    elif not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def cut(spark: SparkSession, df: DataFrame, what: str, **options: object) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends there."""
    path = scratch(spark, what)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = 32 << 20) -> None:
    """Bounds the bytes of an Arrow batch that goes to Python, unless the session has a smaller bound: rows may be large."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name, str(2**31 - 1)).rstrip("b")) > most:
        spark.conf.set(name, str(most))


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % parts


def thinned(df: DataFrame, n: int, *columns: str, salt: int = 0, count: int | None = None) -> DataFrame:
    """About 1.25 n rows (all, if fewer), drawn by a hash of ``columns``.

    Each task drops rows on its own, so what goes on doesn't grow with their number.
    """
    share = 1.25 * n / max(1, df.count() if count is None else count)
    return df if share >= 1 else df.where(F.xxhash64(*columns, F.lit(salt)) < F.lit(int(share * 2**64) - 2**63))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) for runs of rows with about ``limit`` characters; null texts are empty."""
    col = batch.column(batch.schema.get_field_index(column))
    n, start = len(col), 0
    while start < n:
        out, size, i = [], 0, start
        while i < n and (size < limit or not out):
            step = col.slice(i, min(256, n - i)).to_pylist()
            for text in step:
                text = text or ""
                out.append(text)
                size += len(text)
                i += 1
                if size >= limit:
                    break
        yield start, out
        start = i


def rows_of(batch: pa.RecordBatch, start: int, n: int, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column)).slice(start, n)
