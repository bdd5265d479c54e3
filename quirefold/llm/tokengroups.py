"""Exact Jaccard join of word shingles over a token-group matrix.

A text is the set of its lower-cased (A-Z) word shingles, each a 64-bit hash; texts
with equal sets are one node.  Links are found in four steps, none of which drops one:

1. Shingles are dealt out by their hash and those that one text alone holds are
   counted.  A text with too many of them can't be similar to any other and is done.
2. What is left is sorted by least hash and size and cut into groups of similar sets.
   Members are compared within their group, and each group with the next.
3. The matrix: for each group the union of its members' shingles, as a hashed bitmap
   that never misses one, and under each shingle of its members' prefixes the groups
   that hold it.  Two sets of the asked similarity share a shingle of their prefixes,
   so groups that meet under none have no link between them, and neither have those
   whose members are linked already.  First each group meets only its next two.
4. For groups that meet, each member's overlap with the other's union is bounded by
   the bitmaps.  Only groups that some member reaches the similarity with are opened,
   and in those only pairs that their own bitmaps allow are counted out, on whole sets.

Large groups of close copies are linked along the sorted order, so pairs follow the
number of groups that are still apart, never the square of a group of copies.

Defined results: a null, empty or blank text has an empty set and links with nothing;
a text with fewer words than a shingle is one shingle; a null doc_id names a component
only if all its members have none; repeated rows are one node and come back as often as
they come; texts of any length are whole sets (memory follows the longest single text);
an empty table gives no rows; columns but the id and the text aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import simhash
from .common import cut, small_batches, table
from .resampling import _LOWER, buffers, words_of

SHINGLE = 3
PERCENT = 90
#: Shingles dealt to one bucket, on average, when single ones are looked for, and prefix shingles when groups meet.
BUCKET, PREFIX_BUCKET = 2_000_000, 200_000
#: Sets in a group at most, and shingles of all its members beyond which it gets no more.
GROUP, GROUP_SHINGLES = 64, 1_000_000
#: Bytes of texts whose shingles are made at a time, shingles that are dealt out together, and bytes of a batch that goes to Python.
SLICE_BYTES, CHUNK, BATCH_BYTES = 1_000_000, 500_000, 8 << 20
#: Nodes (8 bytes each) that are broadcast at most; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Sets among those left that hold a shingle which goes last in the prefixes' order, and such shingles at most (8 bytes each); they change the cost alone.
COMMON, MAX_COMMON = 32, 262_144
#: Places between groups that meet at first, in the order of size among those that share a shingle.
NEIGHBOURS = 2
_SPACE = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_EIGHT = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mixed(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Hashes that go on with x."""
    h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def word_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight of all words at a time."""
    padded = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    h, lanes, done = size.astype(np.uint64), np.arange(len(start)), 0
    while len(lanes):
        left = size[lanes] - done
        h[lanes] = mixed(h[lanes], eight[start[lanes] + done] & _EIGHT[np.minimum(left, 8)])
        lanes, done = lanes[left > 8], done + 8
    return h


def shingle_sets(data: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the distinct shingles of each text in ascending order, and where each text's end."""
    row, start, length = words_of(data, ends, _SPACE)
    words = word_hashes(data, start, length)
    n_words = np.bincount(row, minlength=len(ends))
    first = np.cumsum(n_words) - n_words
    n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    h = np.zeros(len(words), np.uint64)
    for k in range(size):
        h[: len(h) - k] = mixed(h[: len(h) - k], words[k:])
    for m in range(1, size):  # texts of m words: one shingle of them all
        at = first[n_words == m]
        own = np.full(len(at), m, np.uint64)
        for k in range(m):
            own = mixed(own, words[at + k])
        h[at] = own
    owner = np.repeat(np.arange(len(ends)), n)
    h = h[first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)]
    lo = 0
    for hi in np.cumsum(n).tolist():
        h[lo:hi].sort()
        lo = hi
    new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])] if len(h) else np.zeros(0, bool)
    return h[new], np.cumsum(np.bincount(owner[new], minlength=len(ends)))


def node_of(hashes: np.ndarray) -> int:
    """The set's own 64-bit key, as a signed number."""
    return xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63)


def own_sets(batch: pa.RecordBatch, size: int, most: int = 65_536) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, set of each text) for runs of at most ``most`` rows of column ``text``."""
    for lo in range(0, batch.num_rows, most):
        for first, data, ends in buffers(batch.slice(lo, most), "text", SLICE_BYTES):
            h, at = shingle_sets(data, ends, size)
            yield lo + first, np.split(h, at[:-1])


def facts(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, node, n): each row's set and its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in own_sets(batch, size):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), pa.array(map(node_of, sets), pa.int64()), pa.array(map(len, sets), pa.int64())], ["doc_id", "node", "n"])

    picked = docs.select("doc_id", "text")
    return picked.mapInArrow(run, f"doc_id {picked.schema[0].dataType.simpleString()}, node long, n long")


def distinct_sets(sets: list[np.ndarray]) -> dict[int, np.ndarray]:
    return {node_of(s): s for s in sets if len(s)}


def _blobs(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def not_alone(docs: DataFrame, size: int, percent: int, shingles: int) -> DataFrame:
    """(node): the sets of which at least ``percent`` of 100 shingles are in other rows' sets too.

    A shingle travels as four bytes: its bucket stands for the rest.  Two that agree in
    these by chance count as shared, so none is lost.  A row's copies share all they have.
    ``shingles``: how many the sets of all rows hold together; copies are dealt out like
    other rows, so that buckets of the same size need more of them.
    """
    buckets = max(8, -(-shingles // BUCKET))

    def dealt_out(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        nodes, n = np.array(list(sets), np.int64), np.array([len(s) for s in sets.values()])
        h, index = np.concatenate(list(sets.values())), np.repeat(np.arange(len(n), dtype=np.uint16), n)
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        key, index, bucket = (h // np.uint64(buckets)).astype(np.uint32)[order], index[order], bucket[order]
        used, at = np.unique(bucket, return_index=True)
        # one row more has the nodes themselves; it goes through any bucket
        return pa.RecordBatch.from_arrays(
            [pa.array([*used.tolist(), int(used[0])]), pa.array([node_of(nodes)] * (len(used) + 1), pa.int64()), _blobs([*np.split(key, at[1:]), nodes]), _blobs([*np.split(index, at[1:]), n]), pa.array([False] * len(used) + [True])],
            ["bucket", "chunk", "keys", "at", "whole"],
        )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        total = 0
        for batch in batches:
            for _, rows in own_sets(batch, size):
                for node, own in distinct_sets(rows).items():
                    if node not in held:
                        if held and (total + len(own) > CHUNK or len(held) == 1 << 16):
                            yield dealt_out(held)
                            held, total = {}, 0
                        held[node] = own
                        total += len(own)
        if held:
            yield dealt_out(held)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each chunk, how many of the keys of each of its sets occur once."""
        held: list[tuple[int, bytes, bytes]] = []
        bucket = None

        def once_each() -> Iterator[pa.RecordBatch]:
            keys = np.frombuffer(b"".join(r[1] for r in held), np.uint32)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            other = np.r_[True, keys[1:] != keys[:-1], True]
            once = np.zeros(len(keys), bool)
            once[order[other[1:] & other[:-1]]] = True
            out, lo = [], 0
            for chunk, _, at in held:
                index = np.frombuffer(at, np.uint16)
                which, n = np.unique(index[once[lo : lo + len(index)]], return_counts=True)
                lo += len(index)
                if len(which):
                    out.append((chunk, which.tobytes(), n.astype(np.uint32).tobytes()))
            if out:
                chunks, which, n = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(which, pa.binary()), pa.array(n, pa.binary()), pa.array([False] * len(out))], ["chunk", "keys", "at", "whole"])

        # rows come in the order of buckets, so one bucket is held at a time
        for batch in batches:
            yield batch.filter(batch.column(4)).select([1, 2, 3, 4])
            for b, *row in zip(*(batch.filter(pc.invert(batch.column(4))).column(k).to_pylist() for k in range(4)), strict=True):
                if held and b != bucket:
                    yield from once_each()
                    held = []
                bucket = b
                held.append(tuple(row))
        if held:
            yield from once_each()

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        single: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, keys, at, whole in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if whole:
                    nodes[chunk] = np.frombuffer(keys, np.int64), np.frombuffer(at, np.int64)
                else:
                    which = np.frombuffer(keys, np.uint16)
                    add = np.zeros(int(which[-1]) + 1, np.int64)
                    add[which] = np.frombuffer(at, np.uint32)
                    had = single.get(chunk, add[:0])
                    if len(had) < len(add):
                        had, add = add, had
                    had[: len(add)] += add
                    single[chunk] = had
        for chunk, (own, n) in nodes.items():
            alone_in = np.zeros(len(own), np.int64)
            had = single.get(chunk, alone_in[:0])
            alone_in[: len(had)] = had
            yield pa.RecordBatch.from_arrays([pa.array(own[100 * alone_in <= (100 - percent) * n])], ["node"])

    dealt = docs.select("text").mapInArrow(deal, "bucket long, chunk long, keys binary, at binary, whole boolean").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    counted = dealt.mapInArrow(alone, "chunk long, keys binary, at binary, whole boolean").repartition(buckets, "chunk")
    return counted.mapInArrow(left, "node long").distinct()


def sets_of(spark: SparkSession, docs: DataFrame, need: DataFrame, size: int) -> DataFrame:
    """(node, n, m, data): the whole sets of the nodes in ``need``, each once, with the least of their hashes under another order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows in own_sets(batch, size):
                sets = distinct_sets(rows)
                least = [int((s * np.uint64(0xD6E8FEB86659FD93)).min() >> np.uint64(1)) for s in sets.values()]
                yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array(map(len, sets.values()), pa.int64()), pa.array(least, pa.int64()), _blobs(list(sets.values()))], ["node", "n", "m", "data"])

    side = F.broadcast(need) if need.count() <= BROADCAST_ROWS else need
    held = docs.select("text").mapInArrow(run, "node long, n long, m long, data binary").join(side, "node", "left_semi")
    return held.groupBy("node").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.first("data").alias("data"))


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets' similarity is at least ``percent`` of 100."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(both) - same)


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit h modulo ``bits`` (a power of two, 64 or more) is set for each hash h."""
    out = np.zeros(bits, bool)
    out[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(np.uint64)


def folded(rows: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (one a row) as they would be with only ``words`` 64-bit words."""
    return np.bitwise_or.reduce(rows.reshape(len(rows), -1, words), axis=1)


def group_row(members: list[tuple[int, np.ndarray]], before: tuple[int, np.ndarray] | None, percent: int) -> tuple:
    """(g, nodes, sizes, sets, bitmaps, union, links) of one group; ``before``: the last member of the group before it."""
    forest, links = simhash.Forest(len(members)), []
    for i, (a, x) in enumerate(members):
        for j in range(i - 1, -1, -1):
            b, y = members[j]
            if forest.root(i) != forest.root(j) and linked(x, y, percent):
                forest.link(i, j)
                links.append((a, b))
    if before and linked(before[1], members[0][1], percent):
        links.append((before[0], members[0][0]))
    union = np.unique(np.concatenate([s for _, s in members]))
    bits = max(64, 1 << (max(8 * max(len(s) for _, s in members), 4 * len(union)) - 1).bit_length())
    own = [bitmap(s, bits) for _, s in members]
    return members[0][0], [m[0] for m in members], [len(s) for _, s in members], [s.tobytes() for _, s in members], np.concatenate(own).tobytes(), np.bitwise_or.reduce(own).tobytes(), [{"a": a, "b": b} for a, b in links]


GROUPS = "g long, nodes array<long>, sizes array<long>, sets array<binary>, bits binary, matrix binary, links array<struct<a:long,b:long>>"


def groups(sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """Sets in groups (columns of GROUPS): runs of one least hash in the order of size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("g", pa.int64()), ("nodes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("sets", pa.list_(pa.binary())), ("bits", pa.binary()), ("matrix", pa.binary()), ("links", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])
        held: list[tuple[int, np.ndarray]] = []
        least, total, before, out, size = None, 0, None, [], 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)

        for batch in batches:
            for node, m, data in zip(*(batch.column(k) for k in range(3)), strict=True):
                m, s = m.as_py(), np.frombuffer(data.as_buffer(), np.uint64)
                if held and (m != least or len(held) >= GROUP or total + len(s) > GROUP_SHINGLES):
                    out.append(group_row(held, before, percent))
                    before = held[-1] if m == least else None
                    size += total
                    held, total = [], 0
                    if size >= GROUP_SHINGLES:
                        yield batch_of(out)
                        out, size = [], 0
                held.append((node.as_py(), s))
                total += len(s)
                least = m
        if held:
            out.append(group_row(held, before, percent))
        if out:
            yield batch_of(out)

    return sets.repartitionByRange(parts, "m", "n", "node").sortWithinPartitions("m", "n", "node").select("node", "m", "data").mapInArrow(run, GROUPS)


def common_shingles(sets: DataFrame, shingles: int) -> np.ndarray:
    """The hashes that most of ``sets`` hold, MAX_COMMON at most."""
    buckets = max(8, -(-shingles // BUCKET))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                yield dealt(np.frombuffer(b"".join(b.column(0).slice(lo, 1024).to_pylist()), np.uint64), [], buckets)

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, n = np.unique(np.frombuffer(b"".join(x for b in batches for x in b.column(1).to_pylist()), np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h[n >= COMMON]), pa.array(n[n >= COMMON])], ["h", "n"])

    counted = sets.select("data").mapInArrow(deal, "bucket long, data binary").repartition(buckets, "bucket").mapInArrow(often, "h long, n long")
    return np.sort(counted.orderBy(F.desc("n"), "h").limit(MAX_COMMON).select("h").toArrow().column(0).to_numpy().view(np.uint64))


def dealt(h: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """(bucket, data): hashes and ``columns`` by the hash, one column of a bucket after another."""
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    used, at = np.unique(bucket[order], return_index=True)
    parts = [np.split(c[order], at[1:]) for c in (h, *columns)]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([b"".join(c.tobytes() for c in each) for each in zip(*parts, strict=True)][: len(used)], pa.binary())], ["bucket", "data"])


def prefix(hashes: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """As many of a set's shingles as any set of the asked similarity must meet one of, under one order: ascending, common ones last."""
    n = (100 - percent) * len(hashes) // 100 + 1
    common = often[np.minimum(np.searchsorted(often, hashes), len(often) - 1)] == hashes if len(often) else np.zeros(len(hashes), bool)
    rare = hashes[~common][:n]
    return np.r_[rare, hashes[common][: n - len(rare)]]


def meetings(h: np.ndarray, g: np.ndarray, root: np.ndarray, n: np.ndarray, percent: int, steps: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b), a < b: groups that hold a hash in common, under different roots and in sizes of the asked similarity; ``steps``: only so near in the order of size."""
    # a group's entries of one hash and root as one, with the span of their sizes
    order = np.lexsort((n, root, g, h))
    h, g, root, n = h[order], g[order], root[order], n[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (root[1:] != root[:-1])])
    most = np.maximum.reduceat(n, first)
    h, g, root, n = h[first], g[first], root[first], n[first]
    # hashes with one root only are done
    at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    spread = np.maximum.reduceat(root, at) != np.minimum.reduceat(root, at)
    keep = np.repeat(spread, np.diff(np.r_[at, len(h)]))
    h, g, root, n, most = h[keep], g[keep], root[keep], n[keep], most[keep]
    order = np.lexsort((g, n, h))
    h, g, root, n, most = h[order], g[order], root[order], n[order], most[order]
    at, step = np.arange(len(h)), 1
    while len(at) and (steps is None or step <= steps):
        at = at[at + step < len(h)]
        # sizes ascend within a hash: one that is too large ends its row
        at = at[(h[at] == h[at + step]) & (100 * most[at] >= percent * n[at + step])]
        new = at[(root[at] != root[at + step]) & (g[at] != g[at + step])]
        if len(new):
            yield np.minimum(g[new], g[new + step]), np.maximum(g[new], g[new + step])
        step += 1


def meeting(members: DataFrame, percent: int, buckets: int, steps: int | None) -> DataFrame:
    """Distinct (a, b): groups that meet under a shingle of ``members`` (g, root, n, data: prefixes)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                some = b.slice(lo, 2048)
                data = some.column(3).to_pylist()
                each = [len(x) // 8 for x in data]
                g, root, n = (np.repeat(some.column(k).to_numpy(), each) for k in range(3))
                yield dealt(np.frombuffer(b"".join(data), np.uint64), [g, root, n], buckets)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list] = [[], [], [], []]
        for b in batches:
            for x in b.column(1).to_pylist():
                rows = len(x) // 32
                for column, kind, at in zip(parts, ("<u8", "<i8", "<i8", "<i8"), (0, 8, 16, 24), strict=True):
                    column.append(np.frombuffer(x, kind, rows, at * rows))
        if not parts[0]:
            return
        held, size = [], 0

        def pairs() -> pa.RecordBatch:
            a, b = np.unique(np.concatenate(held, axis=1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for a, b in meetings(*map(np.concatenate, parts), percent, steps):
            held.append(np.stack([a, b]))
            size += len(a)
            if size >= 1_000_000:
                held = [np.unique(np.concatenate(held, axis=1), axis=1)]
                size = held[0].shape[1]
                if size >= 500_000:
                    yield pairs()
                    held, size = [], 0
        if held:
            yield pairs()

    rows = members.select("g", "root", "n", "data").mapInArrow(deal, "bucket long, data binary").repartition(buckets, "bucket")
    return rows.mapInArrow(find, "a long, b long").distinct()


def reaching(bits: np.ndarray, sizes: np.ndarray, matrix: np.ndarray, percent: int) -> np.ndarray:
    """Which members (bitmaps by row) can have a set of the asked similarity in the group whose union is ``matrix``."""
    missing = np.bitwise_count(bits & ~matrix).sum(axis=1, dtype=np.int64)
    return np.flatnonzero(100 * missing <= (100 - percent) * sizes)


def qualifying(pairs: DataFrame, table_: DataFrame, percent: int) -> DataFrame:
    """(a, b, x, y): the pairs of groups that have to be opened, and the places of the members to compare, by bitmaps alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                sides = []
                words = min(len(row["matrix_a"]), len(row["matrix_b"])) // 8
                for s in "ab":
                    sizes = np.array(row[f"sizes_{s}"], np.int64)
                    bits = np.frombuffer(row[f"bits_{s}"], np.uint64).reshape(len(sizes), -1)
                    sides.append((folded(bits, words), sizes, folded(np.frombuffer(row[f"matrix_{s}"], np.uint64)[None], words)[0], np.array(row[f"roots_{s}"], np.int64)))
                (p, n, u, r), (q, m, v, t) = sides
                i, j = reaching(p, n, v, percent), reaching(q, m, u, percent)
                found = []
                for k in i.tolist():
                    # what one side has and the other has not bounds the overlap from both sides
                    over = np.minimum(n[k] - np.bitwise_count(p[k] & ~q[j]).sum(axis=1, dtype=np.int64), m[j] - np.bitwise_count(q[j] & ~p[k]).sum(axis=1, dtype=np.int64))
                    fit = j[(100 * over >= percent * (n[k] + m[j] - over)) & (t[j] != r[k])]
                    found += [(k, x) for x in fit.tolist()]
                if found:
                    x, y = np.array(found, np.uint16).T
                    out.append((row["a"], row["b"], x.tobytes(), y.tobytes()))
            if out:
                a, b, x, y = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], ["a", "b", "x", "y"])

    side = lambda s: table_.select(F.col("g").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("sizes", "bits", "matrix", "roots")])
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long, x binary, y binary")


def opened(pairs: DataFrame, table_: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between the members to compare of two groups each, on whole sets; no more than join what is apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for row in batch.to_pylist():
                place = {r: k for k, r in enumerate(dict.fromkeys([*row["roots_a"], *row["roots_b"]]))}
                forest = simhash.Forest(len(place))
                sets = [[np.frombuffer(s, np.uint64) for s in row[f"sets_{s}"]] for s in "ab"]
                for i, j in zip(np.frombuffer(row["x"], np.uint16).tolist(), np.frombuffer(row["y"], np.uint16).tolist(), strict=True):
                    r, t = place[row["roots_a"][i]], place[row["roots_b"][j]]
                    if forest.root(r) != forest.root(t) and linked(sets[0][i], sets[1][j], percent):
                        forest.link(r, t)
                        links.append((row["nodes_a"][i], row["nodes_b"][j]))
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    side = lambda s: table_.select(F.col("g").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "sets", "roots")])
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose ``sets`` (node, data) are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    own = sets.select("node", "data")
    return pairs.join(own.toDF("a", "of_a"), "a").join(own.toDF("b", "of_b"), "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def links(spark: SparkSession, docs: DataFrame, *, size: int, percent: int, shingles: int, proposed: DataFrame | None = None) -> DataFrame:
    """(a, b): pairs of nodes at ``percent`` of 100 or more, enough to join all that such pairs join.

    ``shingles``: how many the sets of all rows hold together, copies too.  ``proposed`` pairs (a, b) are compared first.
    """
    small_batches(spark, BATCH_BYTES)
    need = cut(spark, not_alone(docs, size, percent, shingles), "groups-need")
    sets = cut(spark, sets_of(spark, docs, need, size), "groups-sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    often = spark.sparkContext.broadcast(common_shingles(sets, total))
    table_ = cut(spark, groups(sets, percent, max(8, -(-total // BUCKET))), "groups-table")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [prefix(np.frombuffer(x.as_buffer(), np.uint64), often.value, percent) for x in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], _blobs(data)], ["g", "node", "n", "data"])

    each = table_.select("g", F.explode(F.arrays_zip("nodes", "sizes", "sets")).alias("m")).select("g", "m.nodes", "m.sizes", "m.sets")
    members = cut(spark, each.mapInArrow(prefixes, "g long, node long, n long, data binary"), "groups-prefixes")
    found = table_.select(F.explode("links").alias("l")).select("l.*")
    found = cut(spark, found if proposed is None else found.unionByName(verified(proposed, sets, percent)), "groups-links")
    buckets = max(8, -(-((100 - percent) * total // 100) // PREFIX_BUCKET))
    for steps in (NEIGHBOURS, None):
        root = cut(spark, simhash.components(spark, found), "groups-roots")
        rooted = cut(spark, members.join(root, "node", "left").select("g", "node", F.coalesce("root", "node").alias("root"), "n", "data"), "groups-members")
        pairs = cut(spark, meeting(rooted, percent, buckets, steps), "groups-meeting")
        roots = rooted.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("node", "root"))).alias("r"))
        with_roots = table_.join(roots, "g").withColumn("roots", F.transform("nodes", lambda x: F.col("r")[x]))
        to_open = cut(spark, qualifying(pairs, with_roots, percent), "groups-open")
        found = cut(spark, found.unionByName(opened(to_open, with_roots, percent)), "groups-links")
    return found


def similar(spark: SparkSession, docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; component_id is the smallest doc_id reachable by links."""
    small_batches(spark, BATCH_BYTES)
    rows = cut(spark, facts(docs, size), "groups-facts")
    nodes = cut(spark, rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n")), "groups-nodes")
    shingles = rows.agg(F.sum("n")).first()[0] or 0
    root = simhash.components(spark, links(spark, docs, size=size, percent=percent, shingles=shingles))
    named = nodes.join(root, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = rows.join(named.join(ids, "root").select("node", "component_id"), "node", "left")
    return told.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op12_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with the size of their set of three-word shingles and the component of links at 90 of 100 or above."""
    return similar(spark, table(spark, sf_dir, "documents"))
