"""Language-model scoring by a hierarchical Pitman-Yor model.

The model has three levels: a base distribution over the training vocabulary and
one unknown type, a restaurant of words without context, and a restaurant for
every previous word seen in training (and for the start of a text); all of these
share that parent.  A customer of a context restaurant is a training token; each
of its tables sends one customer to the parent.

Seating is sampled by blocked Gibbs steps: the number of tables that serve a word
in a restaurant is drawn from its conditional given everything else, exactly (by
generalised Stirling numbers) up to ``EXACT`` customers and customer by customer
in small groups beyond.  Predictive probabilities are averaged over the sweeps
kept, each with the table totals of that very sweep, so they sum to one.

Spark: texts are read in slices.  A slice sends its distinct (word, previous word)
pairs with their counts, packed, to buckets; a bucket holds whole words (a frequent
word is split over several by its previous words), adds the counts up and seats
them.  What a bucket needs of contexts and of split words beyond its own pairs are
sums over all buckets.  For words of the frequent list (at most ``FREQUENT``) they
are gathered, for all others they are exchanged by a shuffle, packed.  Each slice
gets a log probability for each of its pairs back.  Buckets and slices are stored
as a table bucketed by their key, so only what is new is shuffled.

The frequent list comes from a sample drawn by text hash.  It decides how words
are coded and dealt, and all counts are exact, so scores don't depend on how the
table is partitioned.  Log probabilities travel as 32-bit fixed point numbers of
step 2**-26 (within 1e-8 of the double) and are added up as integers.

Defined results: a null or empty text is its end token alone; without training
text every token is the unknown type; a null doc_id counts as id text ''; rows
are scored one by one, so repeated rows get equal results; a very long text is learnt
and scored whole; other columns of the input are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bpe import Numbers
from .common import cut, fold, scratch, table, text_slices, thinned

FOLDS = 10
#: Words coded by their place in the frequent list, and texts of the sample that they are found in, at most.
FREQUENT, SAMPLE_TEXTS = 131_071, 16_384
#: Tokens for each bucket, and tokens of one word beyond which it is split.
BUCKET, SPLIT = 2_000_000, 250_000
SLICE_CHARS = 8_000_000
EXACT = 64
BURN_IN, KEEP = 5, 3
THETA = 1.0
UNKNOWN = 0.5
ADD = 0.1
CACHE_WORDS = 250_000
FIXED_POINT = float(1 << 26)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Tokens:
    """Words of whole texts as numbers, with a 64-bit key for each number."""

    def __init__(self) -> None:
        self.numbers, self.keys = Numbers(), np.zeros(0, np.uint64)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts with an end token each, tokens per text); number 0 is the end."""
        if len(self.numbers) > CACHE_WORDS or not self.numbers:
            self.__init__()
            self.numbers[b""]
        get, found, sizes = self.numbers.__getitem__, [], []
        for t in texts:
            words = t.encode().lower().split()
            words.append(b"")
            found += map(get, words)
            sizes.append(len(words))
        new = self.numbers.fresh()
        self.keys = np.r_[self.keys, np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))]
        return np.array(found, np.int64), np.array(sizes, np.int64)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers as one compressed blob, their byte planes apart."""
    head = np.array([x for a in arrays for x in (len(a), a.itemsize)], "<u4").tobytes()
    body = b"".join(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays)
    return len(arrays).to_bytes(4, "little") + head + (pa.compress(body, codec="zstd", asbytes=True) if body else b"")


def unpacked(blob: bytes) -> list[np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    shapes = np.frombuffer(blob, "<u4", 2 * n, 4).reshape(n, 2).tolist()
    total, at, out = sum(a * b for a, b in shapes), 0, []
    body = np.frombuffer(pa.decompress(blob[4 + 8 * n :], total, codec="zstd"), np.uint8) if total else np.zeros(0, np.uint8)
    for size, width in shapes:
        out.append(np.ascontiguousarray(body[at : at + size * width].reshape(width, size).T).view(f"<u{width}").ravel())
        at += size * width
    return out


def steps_of(a: np.ndarray) -> np.ndarray:
    """Differences of neighbours, modulo the width: small, and so well compressed, where numbers ascend in runs."""
    return np.diff(a, prepend=a.dtype.type(0)).astype(a.dtype)


class Words:
    """The frequent words: how keys are coded, and over how many buckets each word is split.

    Built on the driver from at most FREQUENT rows and broadcast (8 bytes a word).
    """

    def __init__(self, counts: list[tuple[int, int]], tokens: int) -> None:
        """``counts``: (key, estimated tokens) of frequent words; ``tokens``: estimated tokens of the table."""
        found = sorted((k & (1 << 64) - 1, n) for k, n in counts)
        self.keys = np.array([k for k, _ in found], np.uint64)
        self.parts = np.array([max(1, -(-n // SPLIT)) for _, n in found], np.int64)
        self.buckets = max(4, -(-tokens // BUCKET))

    def code(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the list; FREQUENT for others."""
        if not len(self.keys):
            return np.full(len(keys), FREQUENT, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, FREQUENT)

    def coded(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code = self.code(keys)
        return steps_of(code.astype("<u4")), keys[code == FREQUENT]

    def decoded(self, steps: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, key) of what ``coded`` gave."""
        code = np.cumsum(steps, dtype=np.uint32).astype(np.int64)
        out = np.empty(len(code), np.uint64)
        own = code == FREQUENT
        out[own], out[~own] = others, self.keys[code[~own]]
        return code, out

    def split(self, code: np.ndarray) -> np.ndarray:
        """Over how many buckets the words of these codes are split."""
        return np.where(code == FREQUENT, 1, np.r_[self.parts, 1][np.minimum(code, len(self.parts))])

    def bucket(self, word: np.ndarray, code: np.ndarray, context: np.ndarray) -> np.ndarray:
        part = (context * _MIX >> np.uint64(33)) % self.split(code).astype(np.uint64)
        return ((word + part * _MIX) % np.uint64(self.buckets)).astype(np.int64)


def word_list(train: DataFrame) -> Words:
    rows, chars = train.agg(F.count("*"), F.sum(F.octet_length("text"))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            for _, texts in text_slices(batch, limit=SLICE_CHARS):
                at, _ = tokens.read(texts)
                seen, n = np.unique(at, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.keys[seen].view(np.int64)), pa.array(n)], ["key", "n"])

    sample = thinned(train.select("text"), SAMPLE_TEXTS, "text", count=rows).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = [(r["key"], r["n"]) for r in sample.orderBy(F.desc("n"), "key").limit(FREQUENT).collect()]
    # six bytes a token; the sample's shares hold for the table
    tokens, sampled = (chars or 0) // 6 + rows, sum(n for _, n in top)
    return Words([(k, n * tokens // sampled) for k, n in top], tokens)


def slice_row(words: Words, tokens: Tokens, texts: list[str], out: np.ndarray) -> tuple[bytes, np.ndarray, list[tuple[int, bytes]]]:
    """(occurrences of each pair and the text of each occurrence, packed; tokens of each text; (bucket, pairs) blocks).

    Pairs are in the order of (bucket, word key, context key).
    """
    at, sizes = tokens.read(texts)
    order = np.argsort(tokens.keys)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    keys, width = tokens.keys[order], len(order)
    word = rank[at]
    context = np.r_[rank[0], word[:-1]]
    context[np.cumsum(sizes) - sizes] = rank[0]  # only a text's start has the end token as its context
    text_of = np.repeat(np.arange(len(texts)), sizes)
    pair, place, times = np.unique(word * width + context, return_inverse=True, return_counts=True)
    learn = np.bincount(place[~out[text_of]], minlength=len(pair))
    w, u = pair // width, pair % width
    code = words.code(keys)
    bucket = words.bucket(keys[w], code[w], keys[u])
    order = np.argsort(bucket, kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    bucket, w, u, learn = bucket[order], w[order], u[order], learn[order]
    by_pair = np.argsort(back[place], kind="stable")
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else [0]
    blocks = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        heads = np.flatnonzero(np.r_[True, w[a + 1 : b] != w[a : b - 1]])
        blocks.append((int(bucket[a]), packed(*words.coded(keys[w[a:b][heads]]), np.diff(np.r_[heads, b - a]).astype("<u4"), *words.coded(keys[u[a:b]]), learn[a:b].astype("<u4"))))
    return packed(times[order].astype("<u4"), text_of[by_pair].astype("<u4")), sizes, blocks


def deal(docs: DataFrame, words) -> DataFrame:
    """Rows by key: a slice (key -1 - uid: its texts, their occurrences) or a block (key: its bucket, data: pairs of slice uid).

    A slice's uid is made of its partition and place, so a task that is run again makes the same rows.
    """
    picked = docs.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "text")
    id_type = to_arrow_type(picked.schema["doc_id"].dataType)
    kinds = [pa.int64(), pa.int64(), pa.list_(id_type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, uid = Tokens(), TaskContext.get().partitionId() << 28
        for batch in batches:
            ids, held = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for start, texts in text_slices(batch, limit=SLICE_CHARS):
                n = len(texts)
                data, sizes, blocks = slice_row(words.value, tokens, texts, held[start : start + n])
                lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x) for x in (ids.slice(start, n), pa.array(held[start : start + n]), pa.array(sizes))]
                m = len(blocks)
                columns = [[-1 - uid] + [k for k, _ in blocks], [uid] * (m + 1), *(pa.concat_arrays([x, pa.nulls(m, x.type)]) for x in lists), [data] + [x for _, x in blocks]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
                uid += 1

    names = ["key", "uid", "ids", "held", "sizes", "data"]
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"key long, uid long, ids array<{kind}>, held array<boolean>, sizes array<long>, data binary")


def gather(words, t: pa.Table) -> pa.Table:
    """A slice's row as it is; the blocks of a bucket as one row, their equal pairs added up.

    A bucket's data: words, their numbers of pairs, contexts, the context and count of each pair, pairs of each
    slice and the steps from one to the next, all sorted by key.
    """
    if t.column("key")[0].as_py() < 0:
        return t.append_column("uids", pa.nulls(t.num_rows, pa.list_(pa.int64())))
    t = t.sort_by("uid")
    w, u, n, sizes = [], [], [], []
    for x in t.column("data"):
        wc, wo, each, uc, uo, learn = unpacked(x.as_py())
        w.append(np.repeat(words.value.decoded(wc, wo)[1], each))
        u.append(words.value.decoded(uc, uo)[1])
        n.append(learn)
        sizes.append(len(learn))
    w, u, n = map(np.concatenate, (w, u, n))
    order = np.lexsort((u, w))
    ws, us = w[order], u[order]
    first = np.r_[True, (ws[1:] != ws[:-1]) | (us[1:] != us[:-1])]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(first) - 1
    count = np.bincount(place, weights=n).astype("<u4")
    ws, us = ws[first], us[first]
    contexts, context = np.unique(us, return_inverse=True)
    own, each = np.unique(ws, return_counts=True)
    sizes = np.array(sizes, np.int64)
    starts = np.cumsum(sizes) - sizes
    steps = np.diff(np.r_[0, place])
    steps[starts] = place[starts]  # within a slice places ascend
    data = packed(own, each.astype("<u4"), *words.value.coded(contexts), steps_of(context.astype("<u4")), count, sizes.astype("<u4"), steps.astype("<u4"))
    uids = pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column("uid").combine_chunks())
    return t.slice(0, 1).set_column(5, "data", pa.array([data], pa.binary())).append_column("uids", uids)


class Bucket:
    """The pairs of a bucket, sorted by word and context."""

    def __init__(self, words: Words, data: bytes) -> None:
        self.keys, each, code, others, self.context, self.count, self.sizes, steps = unpacked(data)
        self.word = np.repeat(np.arange(len(self.keys)), each)
        self.n = len(self.keys)
        self.code, self.contexts = words.decoded(code, others)
        self.rare = np.flatnonzero(self.code == FREQUENT)
        self.context, self.count = np.cumsum(self.context, dtype=np.uint32).astype(np.int64), self.count.astype(np.int64)
        self.word_code = words.code(self.keys)
        self.is_split = words.split(self.word_code) > 1
        self.place = steps.astype(np.int64)
        self.word_count = np.bincount(self.word, weights=self.count, minlength=self.n).astype(np.int64)

    def places(self) -> Iterator[np.ndarray]:
        """For each slice: the bucket's pair that each of its pairs is."""
        ends = np.cumsum(self.sizes, dtype=np.int64)
        for a, b in zip(ends - self.sizes, ends, strict=True):
            yield np.cumsum(self.place[a:b])

    def by_context(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, weights=weights, minlength=len(self.contexts)).astype(np.int64)

    def by_word(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=weights, minlength=self.n).astype(np.int64)


def told(bucket: Bucket, key: int, parts: int, of_context: list[np.ndarray], of_word: list[np.ndarray], sums: list[float]) -> pa.RecordBatch:
    """What a bucket tells: numbers of its rare contexts to the exchange's parts, of frequent contexts and split words and plain sums to all (part -1)."""
    rare = bucket.contexts[bucket.rare]
    part = (rare % np.uint64(parts)).astype(np.int64)
    rows = []
    for p in np.unique(part).tolist():
        at = np.flatnonzero(part == p)
        rows.append((p, packed(rare[at], *(x[bucket.rare[at]].astype("<u4") for x in of_context))))
    often, cut_up = np.flatnonzero(bucket.code != FREQUENT), np.flatnonzero(bucket.is_split)
    common = packed(bucket.code[often].astype("<u4"), *(x[often].astype("<u8") for x in of_context), bucket.word_code[cut_up].astype("<u4"), *(x[cut_up].astype("<u8") for x in of_word), np.array(sums, "<f8").view("<u8"))
    rows.append((-1, common))
    return pa.RecordBatch.from_arrays([pa.array([key] * len(rows), pa.int64()), pa.array([p for p, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], ["key", "part", "data"])


TOLD = "key long, part long, data binary"


def exchanged(rows: DataFrame) -> DataFrame:
    """For each (key, part) of ``told``: the same contexts' sums over all buckets, in the same order."""

    def add(t: pa.Table) -> pa.Table:
        blobs = [unpacked(x.as_py()) for x in t.column("data")]
        ends = np.cumsum([len(b[0]) for b in blobs])
        _, own = np.unique(np.concatenate([b[0] for b in blobs]), return_inverse=True)
        sums = [np.bincount(own, weights=np.concatenate(x))[own].astype("<u8") for x in list(zip(*blobs, strict=True))[1:]]
        data = [packed(*(s[e - len(b[0]) : e] for s in sums)) for b, e in zip(blobs, ends, strict=True)]
        return t.set_column(2, "data", pa.array(data, pa.binary()))

    return rows.where("part >= 0").groupBy("part").applyInArrow(add, TOLD)


class Common:
    """Sums over all buckets: ``of_context`` and ``of_word`` by frequent code (FREQUENT + 1 rows), and plain ``sums``."""

    def __init__(self, rows: DataFrame, n_context: int, n_word: int, n_sums: int) -> None:
        shape = (n_context + n_word, FREQUENT + 1)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, sums = np.zeros(shape, np.int64), np.zeros(n_sums)
            for b in batches:
                for x in b.column(0):
                    code, *of_context = (arrays := unpacked(x.as_py()))[: 1 + n_context]
                    word, *of_word = arrays[1 + n_context : -1]
                    for row, own in zip(total, [(code, v) for v in of_context] + [(word, v) for v in of_word], strict=True):
                        np.add.at(row, own[0], own[1].astype(np.int64))
                    sums += arrays[-1].view("<f8")
            yield pa.RecordBatch.from_arrays([pa.array([packed(total.ravel().astype("<u8"), sums.view("<u8"))], pa.binary())], ["data"])

        self.total, self.sums = np.zeros(shape, np.int64), np.zeros(n_sums)
        # one row a task, added up in a few tasks before the driver adds those
        again = rows.where("part = -1").select("data").mapInArrow(add, "data binary")
        for r in again.select("data", F.pmod(F.xxhash64("data"), F.lit(8)).alias("g")).groupBy("g").applyInArrow(_added, "data binary").toLocalIterator():
            total, sums = unpacked(bytes(r["data"]))
            self.total += total.view("<i8").reshape(shape)
            self.sums += sums.view("<f8")
        self.of_context, self.of_word = self.total[:n_context], self.total[n_context:]


def _added(t: pa.Table) -> pa.Table:
    parts = [unpacked(x.as_py()) for x in t.column("data")]
    sums = np.sum([s.view("<f8") for _, s in parts], axis=0)
    return pa.table({"data": pa.array([packed(np.sum([x for x, _ in parts], axis=0, dtype=np.uint64), sums.view("<u8"))], pa.binary())})


_log_stirling: dict[float, np.ndarray] = {}


def log_stirling(d: float) -> np.ndarray:
    """log of the generalised Stirling numbers S(c, t) for c and t up to EXACT."""
    d = round(d, 6)
    if d not in _log_stirling:
        s = np.full((EXACT + 1, EXACT + 1), -np.inf)
        s[0, 0] = 0
        for c in range(EXACT):
            t = np.arange(EXACT + 1)
            stay = s[c] + np.log(np.maximum(c - d * t, 1e-300))
            stay[t > c] = -np.inf
            s[c + 1] = np.logaddexp(stay, np.r_[-np.inf, s[c][:-1]])
        _log_stirling[d] = s
    return _log_stirling[d]


def draw_tables(rng: np.random.Generator, count: np.ndarray, weight: np.ndarray, d: float) -> np.ndarray:
    """Tables that serve ``count`` customers each; ``weight`` is a new table's weight against count - d t for the old ones."""
    tables = np.minimum(count, 1).astype(np.int64)
    more = np.flatnonzero(count > 1)
    if not len(more):
        return tables
    logs = log_stirling(d)
    c = np.minimum(count[more], EXACT)
    w = np.log(np.maximum(weight[more], 1e-300))
    order = np.argsort(c, kind="stable")
    cs = c[order]
    bounds = np.searchsorted(cs, np.arange(2, EXACT + 2))
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), 2):
        for lo in range(a, b, 200_000):
            at = order[lo : min(b, lo + 200_000)]
            logit = logs[k, 1 : k + 1][None, :] + w[at][:, None] * np.arange(1, k + 1)
            p = np.cumsum(np.exp(logit - logit.max(1, keepdims=True)), axis=1)
            u = rng.random(len(at)) * p[:, -1]
            tables[more[at]] = 1 + np.minimum((p < u[:, None]).sum(1), k - 1)
    # the customers beyond, in groups of an eighth of those seated
    at = more[count[more] > EXACT]
    seated = np.full(len(at), EXACT, np.int64)
    while len(at):
        group = np.minimum(np.maximum(1, seated // 8), count[at] - seated)
        p = weight[at] / (weight[at] + seated - d * tables[at])
        tables[at] += rng.binomial(group, np.clip(p, 0, 1))
        seated += group
        left = seated < count[at]
        at, seated = at[left], seated[left]
    return tables


def discount(once: float, twice: float) -> float:
    return float(np.clip(once / max(1.0, once + 2 * twice), 0.05, 0.95))


class Plan:
    """What all buckets start from: sums by frequent context and split word, discounts, vocabulary, tokens, first tables."""

    def __init__(self, words: Words, common: Common) -> None:
        """``common.sums``: pairs seen once and twice, unsplit words met in one and two contexts, unsplit words known, tokens, pairs known."""
        (self.customers, self.tables), (self.word_count, self.spread) = common.of_context, common.of_word
        ones, twos, one, two, known, tokens, pairs = common.sums
        self.d, self.d_top = discount(ones, twos), discount(one, two)
        self.vocabulary, self.tokens, self.pairs = int(known) + int((self.word_count > 0).sum()), int(tokens), int(pairs)
        self.unknown = UNKNOWN if self.vocabulary else 1.0
        self.base = (1 - self.unknown) / max(1, self.vocabulary)


def first_facts(bucket: Bucket) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    seen = np.minimum(bucket.count, 1)
    spread = bucket.by_word(seen)
    whole = spread[~bucket.is_split]
    sums = [(bucket.count == 1).sum(), (bucket.count == 2).sum(), (whole == 1).sum(), (whole == 2).sum(), (whole > 0).sum(), bucket.count.sum(), seen.sum()]
    return [bucket.by_context(bucket.count), bucket.by_context(seen)], [bucket.word_count, spread], [float(x) for x in sums]


def chain(plan: Plan, seed: int, bucket: Bucket, tables: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gibbs sweeps over a bucket: (tables of each pair, customers and tables of each word in the parent), for the sweeps kept.

    ``tables``: first tables of each context in all buckets; ``others``: first customers in the parent of each word in
    other buckets.  What lies in other buckets is held there, scaled as the bucket's own totals change.
    """
    rng = np.random.default_rng([seed, 20_010])
    word, context, count, words = bucket.word, bucket.context, bucket.count, bucket.n
    t = np.minimum(count, 1)
    first = max(1, int(t.sum()))
    up = bucket.by_word(t)
    top = np.minimum(up, 1)
    first_top = max(1, int(top.sum()))
    all_up, all_top = max(1.0, float(plan.pairs)), max(1.0, float(plan.vocabulary))
    for sweep in range(BURN_IN + KEEP):
        ratio = t.sum() / first
        customers, tops = all_up * ratio, all_top * top.sum() / first_top
        parent = (np.maximum(up + others * ratio - plan.d_top * top, 0) + (THETA + plan.d_top * tops) * plan.base) / (THETA + customers)
        rest = np.maximum(tables[context] * ratio - t, 0)
        t = draw_tables(rng, count, (THETA + plan.d * rest) * parent[word], plan.d)
        up = bucket.by_word(t)
        top = draw_tables(rng, up + (others * ratio).astype(np.int64), np.full(words, (THETA + plan.d_top * tops) * plan.base), plan.d_top)
        if sweep >= BURN_IN:
            yield t, up, top


class Sweeps:
    """Exact totals of the kept sweeps over all buckets: tables by frequent context, customers and tables of split words, customers and tables in the parent."""

    def __init__(self, plan: Plan, common: Common) -> None:
        self.tables, self.up = common.of_context, common.of_word
        customers, tops = common.sums[:KEEP], common.sums[KEEP:]
        self.customers, self.top, self.tops = customers, [], []
        for s in range(KEEP):
            # a split word's tables in the parent are drawn once for all its buckets
            rng = np.random.default_rng([s, 20_011])
            weight = np.full(FREQUENT + 1, (THETA + plan.d_top * max(tops[s], 1.0)) * plan.base)
            self.top.append(draw_tables(rng, self.up[s], weight, plan.d_top))
            self.tops.append(tops[s] + self.top[s].sum())

    def parent(self, plan: Plan, s: int, bucket: Bucket, up: np.ndarray, top: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Probability of each word of a bucket without context."""
        up = np.where(bucket.is_split, self.up[s][bucket.word_code], up)
        top = np.where(bucket.is_split, self.top[s][bucket.word_code], top)
        base = np.where(known, plan.base, plan.unknown)
        if not self.customers[s]:
            return base
        return (np.maximum(up - plan.d_top * top, 0) + (THETA + plan.d_top * self.tops[s]) * base) / (THETA + self.customers[s])


def of_contexts(bucket: Bucket, common: np.ndarray, parts: int, rows: pa.Table, k: int) -> np.ndarray:
    """The k-th number of each context: frequent ones from ``common``, rare ones from what the exchange gave back."""
    out = common[bucket.code].astype(np.int64)
    rare = bucket.contexts[bucket.rare] % np.uint64(parts)
    for p, data in zip(rows.column("part").to_pylist(), rows.column("data"), strict=True):
        out[bucket.rare[rare == p]] = unpacked(data.as_py())[k]
    return out


def score_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs."""
    list_ = word_list(docs.where(fold("doc_id", FOLDS) != 0))
    words = spark.sparkContext.broadcast(list_)
    kind = docs.schema["doc_id"].dataType.simpleString()
    row = f"key long, uid long, ids array<{kind}>, held array<boolean>, sizes array<long>, data binary, uids array<long>"
    # buckets and slices, dealt by key for good: what is joined to them later comes to where they are
    name, files = f"quirefold_lm_{uuid.uuid4().hex}", max(8, -(-list_.buckets // 2))
    dealt = deal(docs, words).groupBy("key").applyInArrow(lambda t: gather(words, t), row)
    dealt.write.bucketBy(min(files, 50_000), "key").sortBy("key").options(path=scratch(spark, "lm-dealt"), maxRecordsPerFile=4, compression="zstd").saveAsTable(name)
    buckets, slices = spark.table(name).where("key >= 0").select("key", "data", "uids"), spark.table(name).where("key < 0").drop("uids", "uid")
    parts = max(4, list_.buckets // 2)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                bucket = Bucket(words.value, b.column(1)[k].as_py())
                yield told(bucket, b.column(0)[k].as_py(), parts, *first_facts(bucket))

    began = cut(spark, buckets.select("key", "data").mapInArrow(first, TOLD), "lm-first", compression="zstd")
    plan = spark.sparkContext.broadcast(Plan(list_, Common(began, 2, 2, 7)))
    totals = cut(spark, exchanged(began), "lm-totals", compression="zstd")

    def seated(bucket: Bucket, key: int, given: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        p = plan.value
        tables = of_contexts(bucket, p.tables, parts, given, 1)
        others = np.where(bucket.is_split, p.spread[bucket.word_code] - bucket.by_word(np.minimum(bucket.count, 1)), 0)
        return chain(p, key, bucket, tables, others)

    def sample(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for key, data in zip(left.column("key").to_pylist(), left.column("data"), strict=True):
            bucket = Bucket(words.value, data.as_py())
            kept = list(seated(bucket, key, right))
            sums = [float(up.sum()) for _, up, _ in kept] + [float(top[~bucket.is_split].sum()) for _, _, top in kept]
            out.append(told(bucket, key, parts, [bucket.by_context(t) for t, _, _ in kept], [up for _, up, _ in kept], sums))
        return pa.Table.from_batches(out) if out else pa.table({"key": pa.array([], pa.int64()), "part": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})

    sat = cut(spark, buckets.select("key", "data").groupBy("key").cogroup(totals.groupBy("key")).applyInArrow(sample, TOLD), "lm-sampled", compression="zstd")
    sweeps = spark.sparkContext.broadcast(Sweeps(plan.value, Common(sat, KEEP, KEEP, 2 * KEEP)))
    known = totals.select("key", "part", "data", F.lit(0).alias("round")).unionByName(exchanged(sat).select("key", "part", "data", F.lit(1).alias("round")))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        """For each slice that has pairs in the bucket: training counts of its words, and the pairs' log probabilities."""
        p, all_ = plan.value, sweeps.value
        keys, own, out = [], [], []
        for key, data, uids in zip(left.column("key").to_pylist(), left.column("data"), left.column("uids").to_pylist(), strict=True):
            bucket = Bucket(words.value, data.as_py())
            rounds = [right.filter(pa.array(np.asarray(right.column("round")) == r)) for r in (0, 1)]
            count = np.where(bucket.is_split, p.word_count[bucket.word_code], bucket.word_count)
            customers = of_contexts(bucket, p.customers, parts, rounds[0], 0)[bucket.context]
            sum_p = np.zeros(len(bucket.word))
            for s, (t, up, top) in enumerate(seated(bucket, key, rounds[0])):
                tables = of_contexts(bucket, all_.tables[s], parts, rounds[1], s)[bucket.context]
                parent = all_.parent(p, s, bucket, up, top, count > 0)[bucket.word]
                sum_p += (np.maximum(bucket.count - p.d * t, 0) + (THETA + p.d * tables) * parent) / (THETA + customers)
            steps = np.rint(np.log10(sum_p / KEEP) * -FIXED_POINT)
            if len(steps) and not 0 <= steps.min() <= steps.max() < 1 << 32:
                raise OverflowError("a log probability beyond fixed point")
            steps = steps.astype("<u4")
            for uid, place in zip(uids, bucket.places(), strict=True):
                w = bucket.word[place]
                heads = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
                keys.append(-1 - uid)
                own.append(key)
                out.append(packed(count[w[heads]].astype("<u8"), np.diff(np.r_[heads, len(w)]).astype("<u4"), steps[place]))
        return pa.table({"key": pa.array(keys, pa.int64()), "bucket": pa.array(own, pa.int64()), "data": pa.array(out, pa.binary())})

    answers = buckets.groupBy("key").cogroup(known.groupBy("key")).applyInArrow(scored, "key long, bucket long, data binary")
    out_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        p, rows = plan.value, []
        right = [unpacked(x.as_py()) for x in right.sort_by("bucket").column("data")]
        for k in range(left.num_rows):
            times, text = unpacked(left.column("data")[k].as_py())
            counts, each, steps = (np.concatenate(x) for x in zip(*right, strict=True))
            counts, steps = np.repeat(np.repeat(counts, each).astype(float), times), np.repeat(steps, times)
            n = len(left.column("ids")[k])
            base = np.bincount(text, weights=np.log10((counts + ADD) / (p.tokens + ADD * (p.vocabulary + 1))), minlength=n)
            score = np.bincount(text, weights=steps, minlength=n) / -FIXED_POINT
            seen = np.bincount(text, weights=counts > 0, minlength=n).astype(np.int64)
            lists = [left.column(c)[k].values for c in ("ids", "held", "sizes")]
            rows.append(pa.table([*lists, pa.array(seen), pa.array(np.full(n, p.tokens)), pa.array(base), pa.array(score)], names=names))
        return pa.concat_tables(rows) if rows else pa.table([pa.array([], k) for k in (out_type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return slices.groupBy("key").cogroup(answers.groupBy("key")).applyInArrow(finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, texts, tokens, perplexity, base_perplexity) of ``score_texts``' rows: ten to the mean negative log10 probability of a token."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.count("*").alias("texts"), F.sum("n_tokens").alias("tokens"), per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability and perplexity of every whole text of ``documents``, learnt from nine folds of ten."""
    found = score_texts(spark, table(spark, sf_dir, "documents"))
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
