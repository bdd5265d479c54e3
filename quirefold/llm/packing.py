"""Packing documents into fixed-length sequences.

First-fit decreasing with a tournament tree over bin capacities, run on its own
in each randomised group of pieces.  A document longer than a sequence is cut
into full pieces and a rest.  Full pieces are sequences of their own and aren't
shuffled.  The others are written, then dealt to groups by a hash of what they are
and of their place in what was written, so that repeated rows don't meet in one
group either; the number of groups follows the number of these pieces, so a group
stays at about ``GROUP_PIECES`` at any input size.  Only (id, start, length,
checksum) rows are written and shuffled, never tokens.

Defined results: a null text counts as empty and is its end token alone;
repeated rows are packed once each; null ids are kept as they are; other
columns of the input are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import groupby, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import KEY_BYTES, SPACE, ByteBPE, Segments
from .common import cut, rows_of, table, text_slices

SEQUENCE = 4096
#: Pieces in a packing group, on average.
GROUP_PIECES = 2048
SEED = 20_011
END_ID = 2
#: Bytes that a worker's cached words and their ids may take, about.
CACHE_BYTES = 64 << 20
#: Characters of texts encoded at a time.
SLICE_CHARS = 1_000_000
SPACES = re.compile(f"[{SPACE}]+")
#: The vocabulary cuts a lower-cased text into words by
#: 's|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+, so kinds of characters are enough to find them.
GAP, LETTER, DIGIT, OTHER, ODD = range(5)


def tournament_first_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item by first-fit decreasing; no item may exceed ``capacity``.

    The leaves of a complete binary tree hold the room left in each bin, an inner
    node the larger of its children.  Descending to the left child whenever it has
    enough room reaches the first bin that fits, in log(bins) steps.
    """
    n = len(sizes)
    if n and int(sizes.max()) > capacity:
        raise ValueError("an item exceeds the capacity")
    order = np.argsort(-sizes, kind="stable").tolist()
    leaves = 1 << max(0, (max(n, 1) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets, size = [0] * n, [0] * n, sizes.tolist()
    for item in order:
        need, node = size[item], 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - tree[node]
        tree[node] -= need
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            best = left if left > right else right
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def pack(spark: SparkSession, pieces: DataFrame, *, capacity: int = SEQUENCE, group_pieces: int = GROUP_PIECES, seed: int = SEED) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Sequence ids are unique across groups; those of full pieces are below zero.
    """
    written = cut(spark, pieces, "packing-pieces")
    part = written.where(F.col("length") < capacity)
    groups = max(1, -(-part.count() // group_pieces))
    names = pieces.columns
    # written rows keep their places, so a task that is run again deals them alike
    key = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in names], F.monotonically_increasing_id())
    dealt = part.withColumn("__group", F.pmod(key, F.lit(groups)).cast("long"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([c for c in names if not isinstance(pdf[c].iloc[0], (list, np.ndarray, dict))], kind="stable")
        bins, offsets = tournament_first_fit(pdf["length"].to_numpy(np.int64), capacity)
        return pdf.drop(columns="__group").assign(sequence_id=pdf["__group"].to_numpy() * (1 << 32) + bins, offset=offsets)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    packed = dealt.groupBy("__group").applyInPandas(run, f"{fields}, sequence_id long, offset long")
    full = written.where(F.col("length") >= capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def character_kinds() -> np.ndarray:
    """What each code point is to the vocabulary's cut; ``ODD`` where regex knows a letter or a digit and Python's tables don't yet, so that the library may not either."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    kinds = np.full(len(every), OTHER, np.uint8)
    for kind, run in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (GAP, f"[{SPACE}]+")):
        for m in regex.finditer(run, every):
            kinds[m.start() : m.end()] = kind
    named = np.flatnonzero((kinds == LETTER) | (kinds == DIGIT))
    kinds[[c for c in named.tolist() if unicodedata.category(every[c]) == "Cn"]] = ODD
    return kinds


class WordIds:
    """Ids of whole texts for the lower-casing tokenizer.

    Texts are composed, lower-cased character by character and laid end to end as
    bytes.  A word begins where the kind of character changes, at each digit, and
    behind a short ending such as ``'s``; without the gaps the words lie end to end
    too, so that Arrow numbers them as they are.  Only words that differ become
    Python objects, and each is merged once, in batched rounds.  Chunks between
    white space that may hold an added token, or letters and digits newer than
    Python's own tables of Unicode, go through the tokenizers library itself.
    """

    def __init__(self, spec: str) -> None:
        self.spec, self.tokenizer = spec, None
        self.bpe = ByteBPE(spec)  # for its merges; its own caches stay empty
        self.kinds = character_kinds()
        self.plain = self.kinds[:256].tobytes()
        self._fresh()

    def _fresh(self) -> None:
        self.numbers, self.lists, self.held = {}, Segments(), 0

    def _library(self, chunk: str) -> list[int]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.spec)
            self.tokenizer.no_padding()
            self.tokenizer.no_truncation()
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _kinds(self, joined: bytes) -> np.ndarray:
        """The kind of each byte of UTF-8: that of its character."""
        kind = np.frombuffer(joined.translate(self.plain), np.uint8)
        if joined.isascii():
            return kind
        raw, kind = np.frombuffer(joined, np.uint8), kind.copy()
        lead = np.flatnonzero(raw >= 0xC0)
        size = 2 + (raw[lead] >= 0xE0) + (raw[lead] >= 0xF0)
        code = raw[lead].astype(np.int32) & (0x7F >> size)
        for k in (1, 2, 3):
            more = size > k
            code[more] = code[more] << 6 | raw[lead[more] + k] & 0x3F
        own = self.kinds[code]
        for k in range(4):
            more = size > k
            kind[lead[more] + k] = own[more]
        return kind

    def _cut(self, joined: bytes, kind: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Where words begin, and the words.  ``joined`` ends with two gaps."""
        raw = np.frombuffer(joined, np.uint8)
        solid = kind != GAP
        start = solid.copy()
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        if not joined.isascii():
            start &= (raw & 0xC0) != 0x80
        quote = np.flatnonzero(start & (raw == ord("'")))
        one, two = raw[quote + 1], raw[np.minimum(quote + 2, len(raw) - 1)]
        short = np.isin(one, list(b"stmd"))
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        behind = np.r_[quote[short] + 2, quote[long] + 3]
        start[quote[short | long] + 1] = False
        start[behind] = solid[behind]
        begin = np.flatnonzero(start[solid])
        bounds = np.append(begin, np.count_nonzero(solid)).astype(np.int32)
        return np.flatnonzero(start), pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(raw[solid])])

    def _plain(self, low: list[bytes], joined: bytes, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without odd chunks, one after another, and how many each has."""
        if self.held + 4 * self.lists.used > CACHE_BYTES:
            self._fresh()
        at, words = self._cut(joined, kind)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.numbers.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = np.arange(len(self.numbers), len(self.numbers) + len(new))
            fresh = distinct[new].tolist()
            self.numbers.update(zip(fresh, number[new].tolist(), strict=True))
            self.lists.add(*self.bpe.merged(fresh))
            self.held += KEY_BYTES * len(new) + sum(map(len, fresh))
        ids, sizes = self.lists.gather(number[coded.indices.to_numpy()])
        bounds = np.searchsorted(at, np.cumsum([0, *(len(x) + 1 for x in low)]))
        return ids, np.diff(np.r_[0, np.cumsum(sizes)][bounds])

    def _is_odd(self, chunk: str) -> bool:
        return "<|" in chunk or not chunk.isascii() and bool((self.kinds[np.frombuffer(chunk.encode("utf-32-le"), np.uint32)] == ODD).any())

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        low = [(t if t.isascii() else unicodedata.normalize("NFC", t).replace("\u03a3", "\u03c3")).lower().encode() for t in texts]
        joined = b"\n".join(low) + b"\n\n"
        kind = self._kinds(joined)
        odd = [k for k, t in enumerate(texts) if "<|" in t]
        if not joined.isascii() and (new := np.flatnonzero(kind == ODD)).size:
            odd = sorted({*odd, *np.searchsorted(np.cumsum([len(x) + 1 for x in low]), new, side="right").tolist()})
        if not odd:
            return self._plain(low, joined, kind)
        apart, runs, owner, known = set(odd), [], [], {}
        for k, t in enumerate(texts):  # runs of plain text, and the ids of odd chunks
            if k not in apart:
                runs.append(t)
                owner.append(k)
                continue
            for is_odd, chunks in groupby(SPACES.split(t), self._is_odd):
                for run in chunks if is_odd else [" ".join(chunks)]:
                    if is_odd and run not in known:
                        known[run] = np.array(self._library(run), np.int32)
                    runs.append(known[run] if is_odd else run)
                    owner.append(k)
        ids, each = self._whole([r if isinstance(r, str) else "" for r in runs])
        ends, total = np.cumsum(each), np.zeros(len(texts), np.int64)
        parts = [ids[e - n : e] if isinstance(r, str) else r for r, e, n in zip(runs, ends.tolist(), each.tolist(), strict=True)]
        np.add.at(total, owner, [len(p) for p in parts])
        return np.concatenate(parts), total

    def encode(self, texts: list[str], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, each closed by ``end_id``, and how many each has."""
        ids, total = self._whole(texts)
        if end_id is None:
            return ids, total
        return np.insert(ids, np.cumsum(total), end_id), total + 1


_made: dict[int, WordIds] = {}


def _word_ids(spec: str) -> WordIds:
    key = hash(spec)
    if key not in _made:
        _made.clear()
        _made[key] = WordIds(spec)
    return _made[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut_pieces(spark: SparkSession, docs: DataFrame, *, vocabulary: str | None = None, capacity: int = SEQUENCE, end_id: int | None = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenizes whole texts and cuts each into pieces of at most ``capacity`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked
    for, the ids.  The vocabulary file (about 2 MB) is read once and broadcast.
    """
    spec = spark.sparkContext.broadcast(open(vocabulary or default_vocabulary(), encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _word_ids(spec.value)
        for batch in batches:
            for first, texts in text_slices(batch, limit=SLICE_CHARS):
                ids, sizes = codec.encode(texts, end_id)
                number = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(texts)), number)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
                start = nth * capacity
                length = np.minimum(capacity, sizes[owner] - start)
                base = (np.cumsum(sizes) - sizes)[owner] + start
                packed = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(packed[4 * b : 4 * (b + n)]) for b, n in zip(base.tolist(), length.tolist(), strict=True)]
                out = [rows_of(batch, first, len(texts), "doc_id").take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(sizes[owner])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    picked = docs.select("doc_id", "text")
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids)


def sequences(packed: DataFrame, *, capacity: int = SEQUENCE, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves, from ``pack`` over pieces ``with_ids``: sequence_id, n_tokens, ids padded to ``capacity`` unless the length is a power of two."""
    joined = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("__p"))
    ids = F.flatten(F.transform("__p", lambda p: p["ids"]))
    n = F.size("ids")
    whole = (n.bitwiseAND(n - 1) == 0) | (n >= capacity)
    return joined.select("sequence_id", ids.alias("ids")).select("sequence_id", n.alias("n_tokens"), F.when(whole, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(capacity) - n))).alias("ids"))


def pack_documents(spark: SparkSession, docs: DataFrame, *, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for each piece of each document."""
    return pack(spark, cut_pieces(spark, docs, vocabulary=vocabulary))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 4096 ids."""
    return pack_documents(spark, table(spark, sf_dir, "documents"))
