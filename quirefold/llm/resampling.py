"""Importance resampling towards a target: hashed word features, their log ratios, Gumbel top-k.

Texts are read as the UTF-8 bytes of their Arrow buffers, many rows at a time.  A
lookup table tells word bytes from others, the differences of neighbouring bytes give
the words' boundaries, and one table-driven CRC-32 runs over all words at once: step k
takes byte k of every word that has one.  A run of several words goes on from the
checksum of the run before it, through a space and the next word.

Two passes: the first counts features by bucket, for the corpus and for the target,
and one row for each bucket comes to the driver; the second adds up each text's gains.
Ranks come from ranges of the scores (``operators.ordered``), not from one sorted partition.

Defined results: a null or wordless text has no features and weight 0; a null doc_id
is written as empty text where it is hashed; repeated rows are scored and ranked as
often as they come; rows of equal score and doc_id get successive ranks; a text of any
length is read whole (memory follows the longest single text); an empty corpus gives no
rows and an empty target counts as zeros; columns but the id and the text aren't read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from .common import cut, small_batches, table

MAX_WORDS = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Bytes of texts worked on at a time; a longer text alone.
SLICE_BYTES = 4_000_000
#: Words left at which zlib goes on with each, instead of one step for all.
FEW = 32


def crc_table() -> np.ndarray:
    """The 256 steps of CRC-32, from its reflected polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_STEPS = crc_table()
_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = (_BYTES >= 0x80) | ((_LOWER >= 0x61) & (_LOWER <= 0x7A)) | ((_BYTES >= 0x30) & (_BYTES <= 0x39))


def advance(crc: np.ndarray, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Running checksums (as in the middle of a CRC-32) after ``size`` bytes of ``data`` from ``at``, one for each of the three."""
    order = np.argsort(-size, kind="stable")
    crc, at, size = crc[order], at[order], size[order]
    shorter = -size
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(shorter, -k))  # the lanes that have a byte k
        if n <= FEW:
            for lane in range(n):
                rest = data[at[lane] + k : at[lane] + size[lane]].tobytes()
                crc[lane] = zlib.crc32(rest, int(crc[lane]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            break
        now = crc[:n]
        crc[:n] = _STEPS[(now ^ data[at[:n] + k]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = crc
    return out


def words_of(data: np.ndarray, ends: np.ndarray, is_word: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, size) of every word in texts that lie one behind another in ``data`` and end at ``ends``; ``is_word`` tells word bytes."""
    kind = np.zeros(len(data) + 2, np.int8)
    kind[1:-1] = is_word[data]
    step = np.diff(kind)
    starts, stops = step[:-1] == 1, step[1:] == -1
    # a word ends with its text, even if the next one begins with a word byte
    joint = ends[(ends > 0) & (ends < len(data))]
    joint = joint[(kind[joint] == 1) & (kind[joint + 1] == 1)]
    starts[joint] = True
    stops[joint - 1] = True
    start = np.flatnonzero(starts)
    return np.searchsorted(ends, start, side="right"), start, np.flatnonzero(stops) + 1 - start


def features(data: np.ndarray, ends: np.ndarray, max_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, row of each feature, bucket of each feature) for all runs of 1 to ``max_words`` words."""
    low = _LOWER[data]
    row, start, size = words_of(data, ends)
    n_words = np.bincount(row, minlength=len(ends))
    crc = advance(np.full(len(start), 0xFFFFFFFF, np.uint32), low, start, size)
    rows, found, first = [row], [crc], np.arange(len(start))
    for more in range(1, max_words):
        # first: where runs begin that go on with one more word of their text
        on = first + more < len(row)
        on[on] = row[first[on]] == row[first[on] + more]
        first, crc = first[on], crc[on]
        crc = _STEPS[(crc ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        crc = advance(crc, low, start[first + more], size[first + more])
        rows.append(row[first])
        found.append(crc)
    return n_words, np.concatenate(rows), ((np.concatenate(found) ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64)


def buffers(batch: pa.RecordBatch, column: str, limit: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, ends) for runs of rows of about ``limit`` bytes (SLICE_BYTES), out of the Arrow buffers; nulls are empty."""
    col = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
    if not len(col):
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(col):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + (limit or SLICE_BYTES), side="right")) - 1)
        last = min(last, len(col))
        yield first, data[offsets[first] : offsets[last]], offsets[first + 1 : last + 1] - offsets[first]
        first = last


def bucket_counts(docs: DataFrame, *, text_col: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; each task adds up its own before they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, ends in buffers(batch, text_col):
                total += np.bincount(features(data, ends, max_words, buckets)[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = docs.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket, smoothed by one feature a bucket."""
    s, t = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((b + 1) * s / ((a + 1) * t))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """(id, n_words, n_features, weight, place) of every row; ``place`` only tells equal rows of a batch apart."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(id_col))
            for first, data, ends in buffers(batch, text_col):
                n_words, row, bucket = features(data, ends, max_words, len(gain))
                # sums of whole numbers below 2**53 are exact in doubles
                weight = np.bincount(row, weights=gain[bucket], minlength=len(ends)).astype(np.int64)
                columns = [ids.slice(first, len(ends)), pa.array(n_words), pa.array(np.bincount(row, minlength=len(ends))), pa.array(weight), pa.array(np.arange(first, first + len(ends)))]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "n_features", "weight", "place"])

    picked = docs.select(id_col, text_col)
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, n_words long, n_features long, weight long, place long")


def resample(
    spark: SparkSession, docs: DataFrame, target: DataFrame, *, max_words: int = MAX_WORDS, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``.

    The ``percent`` of the texts with at least ``least_words`` words that score highest
    are drawn and ranked from 1, ties to the smaller doc_id; a null doc_id comes last.
    """
    small_batches(spark)
    gain = gains(*(bucket_counts(df, max_words=max_words, buckets=buckets) for df in (docs, target)))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(spark, weights(docs, gain, max_words=max_words).withColumn("score", F.col("weight") + noise), "resampling-scored")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    placed = numbered(able.withColumnRenamed("place", "__row"), F.desc("score"), F.asc_nulls_last("doc_id"), "__row")
    ranked = placed.withColumn("rank", F.when(F.col("place") < drawn, F.col("place") + 1))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionAll(rest.select(columns))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` weighed towards ``benchmark``, a tenth of those with 20 words or more drawn."""
    return resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
