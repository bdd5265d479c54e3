"""Spelling variants: words one edit apart, by an even-partition pigeonhole join.

Two words of equal length that differ in one code point agree in one of the two even
halves of their places, and of two words whose lengths differ by one, the halves of
the shorter stand in the longer, the first where it was or the second one place on.
The half that holds the edit is split evenly once more in the same way, so a join key
is a word's length and three quarters of it, with which quarter is left out: four keys
index a word, four more probe for words shorter by one.  A key travels as a 64-bit
hash; every candidate is verified by its edit distance, and what two keys propose
counts once.

Words are counted within each task before they meet.  Forms are followed to their
root by doubling steps: an n doubles with each form, so a chain has at most log2(n)
words and a few joins settle all.

Defined results: a null or wordless text adds nothing; a null doc_id is written as
empty text where it is hashed; repeated rows count as often as they come; a run of
any length is one word; an empty table gives no rows; columns but the id and the text aren't read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, small_batches, table, text_slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
#: One in so many pairs of document and run loses a code point.
LOSES = 97
#: Distinct words that a task holds before it passes them on.
HELD = 400_000


def counts_of(doc_id: object, text: str, loses: int | None = LOSES) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text, in which some runs have lost a code point by a checksum of id and run."""
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        if loses:
            h = zlib.crc32(run.encode(), before)
            if h % loses == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
        yield run, n


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", loses: int | None = LOSES) -> DataFrame:
    """(word, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(id_col))
            for start, texts in text_slices(batch, text_col):
                for doc_id, text in zip(ids.slice(start, len(texts)).to_pylist(), texts, strict=True):
                    for word, n in counts_of(doc_id, text, loses):
                        held[word] = held.get(word, 0) + n
                    if len(held) >= HELD:
                        yield out()
                        held.clear()
        if held:
            yield out()

    return docs.select(id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _keys(word: Column, length: Column, longer: int) -> Column:
    """The four keys under which words of ``length`` are indexed, as read out of ``word`` that is ``longer`` by 0 or 1."""
    half = F.floor(length / 2).cast("int")
    rest = length - half
    quarter = lambda n: F.floor(n / 2).cast("int")
    first, second = quarter(half), quarter(rest)
    part = lambda at, n: F.substring(word, at + 1, n)
    # (the half kept, the quarter kept of the other half), each where it stands in the longer word
    kept = [
        (part(F.lit(0), half), part(half, second)),
        (part(F.lit(0), half), part(half + second + longer, rest - second)),
        (part(half + longer, rest), part(F.lit(0), first)),
        (part(half + longer, rest), part(first + longer, half - first)),
    ]
    return F.array(*[F.xxhash64(length, F.lit(k), a, F.lit(":"), b) for k, (a, b) in enumerate(kept)])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): the words exactly one edit apart, each pair once, out of distinct ``words`` (word, n)."""
    sized = words.withColumn("size", F.length("word"))
    index = sized.select(F.explode(_keys(F.col("word"), F.col("size"), 0)).alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("size").alias("size_b"))
    own, shorter = _keys(F.col("word"), F.col("size"), 0), _keys(F.col("word"), F.col("size") - 1, 1)
    probe = sized.select(F.explode(F.concat(own, shorter)).alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("size").alias("size_a"))
    ordered = (F.col("size_a") > F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    found = probe.join(index, "key").where(ordered & (F.levenshtein("a", "b", 1) == 1))
    return found.select("a", "b", "n_a", "n_b").distinct()


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of all ``forms`` (word, form): forms followed to the last, by doubling steps."""
    now = cut(spark, forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = cut(spark, now.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return now


def variants(spark: SparkSession, docs: DataFrame, *, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, loses: int | None = LOSES) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word long and frequent enough.

    ``form`` is the most frequent word one edit away (ties: the smallest in code-point
    order) if it is ``ratio`` times as frequent; ``root`` where following forms ends.
    """
    small_batches(spark)
    counted = word_counts(docs, loses=loses).where((F.col("n") >= least_count) & (F.length("word") >= least_length))
    words = cut(spark, counted, "spelling-words")
    pairs = cut(spark, near_pairs(words), "spelling-pairs")
    each = pairs.select("a", "n_a", "b", "n_b").unionAll(pairs.select("b", "n_b", "a", "n_a")).toDF("word", "n", "near", "near_n")
    best = each.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    form = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best.near"))
    told = cut(spark, words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"), F.when(form.isNotNull(), -F.col("best.n")).alias("form_n")), "spelling-forms")
    followed = told.join(roots(spark, told.where("form is not null")), "word", "left")
    return followed.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all ``documents`` with their more frequent spelling, one edit away, and where such forms lead."""
    return variants(spark, table(spark, sf_dir, "documents"))
