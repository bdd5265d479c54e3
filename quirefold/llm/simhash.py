"""Near-duplicates by SimHash fingerprints and vantage-point trees.

Each text gets a 64-bit fingerprint of its word shingles.  Equal fingerprints
collapse first.  A vantage-point tree fitted on a bounded sample deals the
distinct fingerprints to shards: a node sends what lies within its radius to one
side and the rest to the other, and what lies just outside the radius, within
the linking distance, to both, so that every linked pair meets in some shard
(triangle inequality).  A shard splits its fingerprints in the same way down to
small leaves and emits a spanning forest, never all pairs.  Forests are joined to
components by alternating large-star and small-star steps with checkpoints.

Defined results: a null or blank text has fingerprint zero and links like any
other; a null id never names a component unless all its members have none;
repeated rows are returned as often as they come; a very long text counts whole, with
all its shingles held by one task at a time; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, rows_of, shared_dir, table, text_slices

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Fingerprints on which the dealing tree is fitted, at most.
TREE_SAMPLE = 1 << 20
#: Distinct fingerprints in a shard, on average, up to 2**29 of them; beyond, shards grow, by 8 bytes in a task for each.
SHARD = 8_192
MAX_SHARDS = 65_536
LEAF = 192
_LANES = np.array([sum(((v >> i) & 1) << (8 * i) for i in range(8)) for v in range(256)], np.uint64)


def fingerprints_of(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Fingerprints of lower-cased (A-Z) texts: a bit is 1 if set in over half the shingle hashes."""
    hashes, counts = [], []
    for t in texts:
        words = t.lower().split()
        if len(words) > size:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
            n = len(words) - size + 1
        else:
            shingles, n = iter([b" ".join(words)]), 1 if words else 0
        if n:
            hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n))
        counts.append(n)
    out = np.zeros(len(texts), np.uint64)
    if not hashes:
        return out
    counts = np.array(counts, np.int64)
    some = np.flatnonzero(counts)
    n = counts[some]
    lanes = _LANES[np.concatenate(hashes).view(np.uint8).reshape(-1, 8)]
    # sums of up to 255 rows fit the one-byte lanes
    blocks = -(-n // 255)
    owner = np.repeat(np.arange(len(n)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    sums = np.add.reduceat(lanes, (np.cumsum(n) - n)[owner] + 255 * nth, axis=0).view(np.uint8)
    bits = np.add.reduceat(sums.astype(np.int64), np.cumsum(blocks) - blocks, axis=0)
    out[some] = np.packbits(bits * 2 > n[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch, text_col):
                fps = fingerprints_of([t.encode() for t in texts], size)
                yield pa.RecordBatch.from_arrays([rows_of(batch, start, len(texts), id_col), pa.array(fps.view(np.int64))], [id_col, "fp"])

    picked = docs.select(id_col, text_col)
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, fp long")


def split(fps: np.ndarray, radius: int, tries: int = 4) -> tuple[np.uint64, int] | None:
    """A vantage point and the distance to cut at, with few fingerprints near the cut; None if no cut helps."""
    best = None
    for k in range(tries):
        v = fps[(len(fps) * (2 * k + 1)) // (2 * tries)]
        d = np.bitwise_count(fps ^ v)
        hist = np.cumsum(np.bincount(d, minlength=65))
        left = np.r_[hist[radius:], np.full(radius, hist[-1])][:64]  # within cut + radius
        worse = np.maximum(left, len(fps) - hist[:64])
        cost = worse + (left + len(fps) - hist[:64] - len(fps))  # size of the larger side and what is doubled
        at = int(np.argmin(cost))
        if worse[at] < 0.9 * len(fps) and (best is None or cost[at] < best[0]):
            best = (cost[at], v, at)
    return best and best[1:]


def fit_tree(sample: np.ndarray, shards: int, radius: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, cut, left, right); a negative child -s-1 is shard s."""
    nodes: list[tuple[int, int, int, int]] = []
    made = 0

    def grow(fps: np.ndarray, want: int) -> int:
        nonlocal made
        found = split(fps, radius, 8) if want > 1 and len(fps) > 8 else None
        if found is None:
            made += 1
            return -made
        v, at = found
        inside = np.bitwise_count(fps ^ v) <= at
        me = len(nodes)
        nodes.append((int(v), at, 0, 0))
        share = min(want - 1, max(1, round(want * inside.mean())))
        left = grow(fps[inside], share)
        nodes[me] = (int(v), at, left, grow(fps[~inside], want - share))
        return me

    grow(sample, shards)
    return nodes


def route(fps: np.ndarray, nodes: list, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, index) pairs: each fingerprint in every shard whose region or its margin holds it."""
    if not nodes:
        return np.zeros(len(fps), np.int64), np.arange(len(fps))
    shard, index, todo = [], [], [(0, np.arange(len(fps)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node < 0:
            shard.append(np.full(len(at), -node - 1))
            index.append(at)
            continue
        v, cut_at, left, right = nodes[node]
        d = np.bitwise_count(fps[at] ^ np.uint64(v)).astype(np.int64)
        todo += [(left, at[d <= cut_at + radius]), (right, at[d > cut_at])]
    return np.concatenate(shard), np.concatenate(index)


class Forest:
    """Union-find over positions; the root is the smallest position."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def leaf_links(fps: np.ndarray, at: np.ndarray, radius: int, forest: Forest) -> None:
    """Links all pairs within ``radius`` by growing one component after another from what is left."""
    if len(at) <= LEAF:
        near = np.bitwise_count(fps[at][:, None] ^ fps[at][None, :]) <= radius
        a, b = np.nonzero(np.triu(near, 1))
        if len(a) <= 4 * len(at):
            for x, y in zip(at[a].tolist(), at[b].tolist(), strict=True):
                forest.link(x, y)
            return
    left = at
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(fps[left] ^ fps[x]) <= radius
            if near.any():
                for y in left[near].tolist():
                    forest.link(int(x), y)
                frontier += left[near].tolist()
                left = left[~near]


def linked(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For distinct ``fps``: the position of each one's component root under pairs within ``radius``."""
    forest, todo = Forest(len(fps)), [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        found = split(fps[at], radius) if len(at) > LEAF else None
        if found is None:
            leaf_links(fps, at, radius, forest)
            continue
        v, cut_at = found
        d = np.bitwise_count(fps[at] ^ v)
        todo += [at[d <= cut_at + radius], at[d > cut_at]]
    return np.array([forest.root(i) for i in range(len(fps))], np.int64)


def links(spark: SparkSession, distinct: DataFrame, *, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b), a > b: a spanning forest of each shard over the distinct ``fp`` values.

    At most TREE_SAMPLE fingerprints come to the driver, whatever the input.
    """
    n = distinct.count()
    shards = min(MAX_SHARDS, max(1, -(-n // shard)))
    sample = [r[0] for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(min(TREE_SAMPLE, 32 * shards)).collect()] if shards > 1 else []
    nodes = spark.sparkContext.broadcast(fit_tree(np.array(sample, np.int64).view(np.uint64), shards, radius))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            where, index = route(fps, nodes.value, radius)
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(fps[index].view(np.int64))], ["shard", "fp"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(pdf["fp"].to_numpy())
        root = linked(fps.view(np.uint64), radius)
        off = root != np.arange(len(fps))
        return pd.DataFrame({"a": fps[off], "b": fps[root[off]]})

    return distinct.select("fp").mapInArrow(deal, "shard long, fp long").groupBy("shard").applyInPandas(solve, "a long, b long")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the component's smallest node.

    Alternating large-star and small-star until no edge changes, which the stars
    reach in about log(nodes) rounds; minima are aggregated before they are joined
    back, so a node with very many links is a skewed join and not a group.
    """
    shared_dir(spark)
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = mark(now)
    while before[0]:
        # large star: each neighbour above a node points at the least of the node and its neighbours
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a node and its smaller neighbours point at the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        now = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct().checkpoint()
        after = mark(now)
        if after == before:
            break
        before = after
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")


def near_duplicates(spark: SparkSession, docs: DataFrame, *, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp long, component_id of every row; component_id is the smallest doc_id reachable by links."""
    fps = cut(spark, fingerprint(docs, size=size), "simhash")
    distinct = cut(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    root = components(spark, links(spark, distinct, radius=radius))
    named = distinct.join(root, distinct["fp"] == root["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(named.select("fp", "root").join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with their fingerprint and the component of links at two or fewer differing bits."""
    found = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
