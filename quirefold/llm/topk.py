"""Exact top-k inner-product search with a pivot-distance index.

Inner products become distances by one more component that gives every vector
the largest norm.  Vectors are keyed by their nearest pivot and their distance to
it; cells of (pivot, band of distances) are dealt to blocks of about ``BLOCK``
vectors, a cell that is larger alone to several by a hash.  A query first searches
the cells of its nearest pivot in one block.  The k-th score found there bounds
what can still be better in two ways: by the triangle inequality on the distance
to the pivot (an annulus around it), and by q.x <= q.p + |q| |x - p|.  Only blocks
with a cell within both bounds get the query, and in a block only the vectors
within both bounds are scored; ``n_scored`` tells how many that were.  Vectors
spread evenly over a sphere in many dimensions are all within such bounds: then
every vector is scored, and the result is exact all the same.  Equal vectors
collapse to one with its smallest ids before the search, so copies cost nothing.
Beyond ``QUERY_CHUNK`` queries go in chunks, those from one block together; a block is
sent once for each chunk that holds a query within its bounds, and to no other.

Pivots are fitted on at most ``PIVOT_SAMPLE`` vectors; every vector is indexed
and results are exact.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, nor do rows with a null id; shorter vectors count as
padded with zeros; a vector with a scaled component beyond 64 bits takes no part
either, and a score beyond 64 bits is the largest or smallest that the score's
column holds; repeated rows of an id count once; different vectors of one id are
each searched for, and are never neighbours of that id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table

K = 5
EVERY = 50
SCALE = 256
PIVOT_SAMPLE = 8_192
MAX_PIVOTS = 256
#: Bands of distances to a pivot, and vectors in a block on average.
BINS = 128
BLOCK = 16_384
#: Queries that one block's search takes at a time; more are split and the block is read again.
QUERY_CHUNK = 16_384
SLACK = 1e-6


def quantise(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, q binary): floor(scale * x) of each component, without the vectors that take no part.

    ``q`` is the width of its integers (4, or 8 where 31 bits are too few) in one byte and then the integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i is None or not x or None in x:
                    continue
                x = np.asarray(x, np.float64)
                if np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        x = np.floor(scale * x)
                    most = np.abs(x).max()
                    if most >= 2.0**63:
                        continue
                    width = 4 if most < 2.0**31 else 8
                    ids.append(i)
                    out.append(bytes([width]) + x.astype(f"<i{width}").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "q"])

    picked = df.select(F.col(id_col).cast("long").alias("vec_id"), vector_col)
    return picked.mapInArrow(run, "vec_id long, q binary")


def matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    """Vectors as rows: 64-bit integers if one needs them, else floating point, which holds 32 bits exactly."""
    wide = any(b[0] == 8 for b in blobs)
    out = np.zeros((len(blobs), dim), np.int64 if wide else np.float64)
    for row, b in zip(out, blobs, strict=True):
        row[: (len(b) - 1) // b[0]] = np.frombuffer(b, f"<i{b[0]}", offset=1)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where that is exact, in 64-bit integers where they can't overflow, else in Python's, cut to 64 bits."""
    bound = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    out = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    return np.maximum(np.minimum(out, 2**63 - 1), 1 - 2**63).astype(np.int64)


class Index:
    """Pivots in the lifted space, and the block of each cell (pivot, band of distances)."""

    def __init__(self, sample: np.ndarray, dim: int, top: float) -> None:
        self.dim, self.top = dim, top
        lifted = self.lift(sample)
        n = len(lifted)
        count = max(1, min(MAX_PIVOTS, int(2 * np.sqrt(n))))
        self.pivots = lifted[np.linspace(0, n - 1, count).astype(int)].copy() if n else np.zeros((1, dim + 1))
        for _ in range(8):  # Lloyd steps; any pivots give exact results
            near = self.nearest(lifted)[0] if n else np.zeros(0, int)
            for p in range(count if n else 0):
                if (near == p).any():
                    self.pivots[p] = lifted[near == p].mean(0)
        # neighbours in one direction come one after another, so that a block holds pivots near one another
        middle = self.pivots - self.pivots.mean(0)
        along = np.linalg.svd(middle, full_matrices=False)[2][0] if n else np.zeros(dim + 1)
        self.pivots = self.pivots[np.argsort(middle @ along, kind="stable")]
        self.reach = 2 * np.sqrt(top) + 1e-9
        self.band = self.reach / BINS

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.c_[x, np.sqrt(np.maximum(0, self.top - (x * x).sum(1)))]

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        d2 = (lifted * lifted).sum(1)[:, None] + (self.pivots**2).sum(1)[None, :] - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(0, d2))

    def nearest(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self.distances(lifted)
        p = d.argmin(1)
        return p, d[np.arange(len(p)), p]

    def bin_of(self, d: np.ndarray) -> np.ndarray:
        return np.minimum(BINS - 1, (d / self.band).astype(np.int64))

    def set_blocks(self, counts: list[tuple[int, int, int]]) -> None:
        """counts: (pivot, bin, vectors).  Small cells share a block, a large one has several of its own."""
        self.first, self.parts = np.full((len(self.pivots), BINS), -1), np.zeros((len(self.pivots), BINS), np.int64)
        block, held = 0, 0
        for p, b, n in sorted(counts):
            if held and held + n > BLOCK:
                block, held = block + 1, 0
            self.first[p, b], self.parts[p, b] = block, max(1, -(-n // BLOCK))
            block, held = (block + self.parts[p, b], 0) if n > BLOCK else (block, held + n)

    def block_of(self, p: np.ndarray, d: np.ndarray, salt: np.ndarray) -> np.ndarray:
        b = self.bin_of(d)
        return self.first[p, b] + salt % self.parts[p, b]

    def home(self, d: np.ndarray) -> tuple[int, int]:
        """(block, pivot): a block of the cell that is nearest by distance d among those of the nearest pivot that has any."""
        p = int(np.where((self.parts > 0).any(1), d, np.inf).argmin())
        own = np.flatnonzero(self.parts[p])
        return int(self.first[p, own[np.abs(own - int(d[p] / self.band)).argmin()]]), p

    def bounds(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and pivot: the distances to the pivot from and up to which a vector may score ``least`` or more."""
        q = q.astype(np.float64)
        size2 = (q * q).sum(1)
        own, dot, size = self.distances(np.c_[q, np.zeros(len(q))]), q @ self.pivots[:, : self.dim].T, np.sqrt(size2)
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            radius = (np.sqrt(np.maximum(0, size2 + self.top - 2 * least)) * (1 + SLACK) + SLACK * (1 + self.reach))[:, None]
            away = (least[:, None] - dot) / size[:, None]
        away = np.where(np.isfinite(away), away - SLACK * (1 + self.reach), -np.inf)
        return np.maximum(own - radius, away), own + radius

    def within(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Blocks with a cell that meets the bounds of one query."""
        edges = np.arange(BINS)
        up = np.where(edges == BINS - 1, np.inf, (edges + 1) * self.band * (1 + SLACK))
        meets = (self.parts > 0) & (up >= low[:, None]) & (edges * self.band * (1 - SLACK) <= high[:, None])
        first, parts = self.first[meets], self.parts[meets]
        return np.unique(np.concatenate([first, *(first[parts > k] + k for k in range(1, int(parts.max(initial=1))))]))


def best(scores: np.ndarray, at: np.ndarray, ids: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of the vectors ``at`` by score and then smaller id; all ids of an equal vector count."""
    keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) > k else np.arange(len(scores))
    own = [ids[i] for i in at[keep]]
    s, v = np.repeat(scores[keep], [len(x) for x in own]), np.concatenate(own) if own else np.zeros(0, np.int64)
    order = np.lexsort((v, -s))[:k]
    return s[order], v[order]


def copied(spark: SparkSession, blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """The vectors of each block, once for every chunk of queries that asks for it; the list of these is written, so that Spark knows its size."""
    wanted = cut(spark, asked.select("block", "chunk").distinct(), "topk-wanted")
    return blocks.join(wanted, "block")


def in_chunks(spark: SparkSession, homes: DataFrame, most: int) -> DataFrame:
    """homes with a ``chunk`` of about ``most`` queries each, in the order of their home blocks; a block with more has several, by a hash."""
    before, rows = 0, []
    for block, n in sorted(tuple(r) for r in homes.groupBy("block").count().collect()):  # one home block a cell: at most MAX_PIVOTS x BINS rows
        rows.append((block, before, n))
        before += n
    starts = spark.createDataFrame(rows, "block long, __before long, __n long")
    place = F.col("__before") + F.pmod(F.xxhash64("q", F.lit(9)), F.col("__n"))
    return homes.join(F.broadcast(starts), "block").withColumn("chunk", F.floor(place / most)).drop("__before", "__n")


def top_k(spark: SparkSession, vectors: DataFrame, *, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score, n_scored): the k best of each row whose id is divisible by ``every``, against all others.

    ``vectors`` has (vec_id, q) as ``quantise`` makes them.
    """
    rows = cut(spark, vectors.distinct(), "topk-rows")
    asked = rows.where(F.col("vec_id") % every == 0)
    # a query's own vectors may be among the best: as many more are kept
    more = k + (asked.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 1)
    few = rows.withColumn("__n", F.row_number().over(Window.partitionBy("q").orderBy("vec_id"))).where(F.col("__n") <= more)
    distinct = cut(spark, few.groupBy("q").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "topk-distinct")
    dim = distinct.agg(F.max(F.expr("cast((octet_length(q) - 1) / if(substring(q, 1, 1) = X'08', 8, 4) as int)"))).first()[0]
    empty = "query_id long, rank int, vec_id long, score long, n_scored long"
    if dim is None:
        return spark.createDataFrame([], empty)

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = matrix(b.column(0).to_pylist(), dim).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([float((m * m).sum(1).max(initial=0))])], ["n"])

    top = distinct.select("q").mapInArrow(norms, "n double").agg(F.max("n")).first()[0]
    sample = matrix([bytes(r[0]) for r in distinct.select("q").orderBy(F.xxhash64("q"), "q").limit(PIVOT_SAMPLE).collect()], dim)
    index = Index(sample, dim, top)
    sent_pivots = spark.sparkContext.broadcast(index)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, d = sent_pivots.value.nearest(sent_pivots.value.lift(matrix(b.column(0).to_pylist(), dim)))
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(sent_pivots.value.bin_of(d), pa.int64())], ["p", "b"])

    # at most MAX_PIVOTS x BINS rows
    index.set_blocks([tuple(r) for r in distinct.select("q").mapInArrow(key, "p long, b long").groupBy("p", "b").count().collect()])
    sent = spark.sparkContext.broadcast(index)

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        for b in batches:
            p, d = ix.nearest(ix.lift(matrix(b.column(0).to_pylist(), dim)))
            block = ix.block_of(p, d, b.column(2).to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(p, pa.int64()), pa.array(d), b.column(0), b.column(1)], ["block", "p", "d", "q", "ids"])

    salted = distinct.select("q", "ids", F.pmod(F.xxhash64("q"), F.lit(1 << 30)).alias("salt"))
    blocks = salted.mapInArrow(to_blocks, "block long, p long, d double, q binary, ids array<long>")
    queries = asked.select("q").distinct()

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """left: a block's vectors; right: its queries, each with a score to reach and the one pivot it is for (-1: all)."""
        ix, out = sent.value, []
        if len(left) and len(right):
            left = left.sort_values(["p", "d", "q"])
            pivot, d, ids = left["p"].to_numpy(), left["d"].to_numpy(), list(left["ids"])
            vectors = matrix(list(left["q"]), dim)
            heads = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1], True])
            for lo in range(0, len(right), 512):
                part = right.iloc[lo : lo + 512]
                q, only = matrix(list(part["q"]), dim), part["only"].to_numpy()
                low, high = ix.bounds(q, part["least"].to_numpy())
                found: list[list[tuple[np.ndarray, int]]] = [[] for _ in range(len(part))]
                for x, y in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                    p = int(pivot[x])
                    a, b = x + np.searchsorted(d[x:y], low[:, p], "left"), x + np.searchsorted(d[x:y], high[:, p], "right")
                    who = np.flatnonzero((b > a) & ((only < 0) | (only == p)))
                    if len(who):
                        first, last = int(a[who].min()), int(b[who].max())
                        scores = products(q[who], vectors[first:last])
                        for i, row in zip(who.tolist(), scores, strict=True):
                            found[i].append((row[a[i] - first : b[i] - first], int(a[i])))
                for name, pieces in zip(part["q"], found, strict=True):
                    if pieces:
                        at = np.concatenate([np.arange(a, a + len(s)) for s, a in pieces])
                        s, v = best(np.concatenate([s for s, _ in pieces]), at, ids, more)
                        out.append((name, s, v, len(at)))
        return pd.DataFrame(out, columns=["q", "scores", "ids", "n"])

    def searched(asked: DataFrame) -> DataFrame:
        return copied(spark, blocks, asked).groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInPandas(search, "q binary, scores array<long>, ids array<long>, n long")

    def go_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        for b in batches:
            m = matrix(b.column(0).to_pylist(), dim).astype(np.float64)
            home = [ix.home(d) for d in ix.distances(np.c_[m, np.zeros(len(m))])]
            block, only = zip(*home, strict=True) if home else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(block, pa.int64()), pa.array(np.full(len(m), -np.inf)), pa.array(only, pa.int64())], ["q", "block", "least", "only"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        for b in batches:
            m = matrix(b.column(0).to_pylist(), dim)
            least = np.array([s[more - 1] if s and len(s) >= more else -np.inf for s in b.column(2).to_pylist()], np.float64)
            low, high = ix.bounds(m, least)
            for i, (name, chunk) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                to = ix.within(low[i], high[i])
                n = len(to)
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.binary()), pa.array([chunk] * n, pa.int64()), pa.array(to, pa.int64()), pa.array(np.full(n, least[i])), pa.array(np.full(n, -1))], ["q", "chunk", "block", "least", "only"])

    shape = "q binary, chunk long, block long, least double, only long"
    homes = in_chunks(spark, cut(spark, queries.mapInArrow(go_home, "q binary, block long, least double, only long"), "topk-homes"), QUERY_CHUNK)
    found = cut(spark, searched(homes), "topk-home")
    bound = homes.select("q", "chunk").join(found.select("q", "scores"), "q", "left").select("q", "chunk", "scores")
    near = searched(bound.mapInArrow(expand, shape))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        s, v = np.concatenate(list(pdf["scores"])), np.concatenate(list(pdf["ids"]))
        order = np.lexsort((v, -s))[:more]
        return pd.DataFrame({"q": pdf["q"].iloc[:1], "scores": [s[order]], "ids": [v[order]], "n": [pdf["n"].sum()]})

    merged = near.groupBy("q").applyInPandas(merge, "q binary, scores array<long>, ids array<long>, n long")
    named = asked.select(F.col("vec_id").alias("query_id"), "q")
    paired = named.join(merged, "q").select("query_id", "n", F.slice(F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] != F.col("query_id")), 1, k).alias("best"))
    return paired.select("query_id", "n", F.posexplode("best").alias("pos", "b")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.ids").alias("vec_id"), F.col("b.scores").alias("score"), F.col("n").alias("n_scored"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every query among ``embeddings``."""
    return top_k(spark, quantise(table(spark, sf_dir, "embeddings"))).drop("n_scored")
