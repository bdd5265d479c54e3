"""Byte-level BPE: batched encoding and decoding with numpy merge rounds.

The encoder keeps the symbols of many words in one flat array.  In each round
the lowest rank of each word's adjacent pairs is found with one segmented minimum,
and all its occurrences merge at once; then only the pairs beside a merged symbol are
looked up anew.  Words without a mergeable pair leave the array.
Words repeat, so each distinct piece is encoded once per worker and cached (the
cache is bounded in bytes and starts afresh when full: results do not depend on it).
A word of more than ``LONG`` bytes would take as many rounds as it has merges; it is
merged by itself from a heap of its pairs, in the same order and n log n steps.

Defined results: a null text counts as empty; an empty text has no tokens and
both digests are those of no bytes; repeated rows give repeated results; other
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import rows_of, table, text_slices

#: Fixed value: white space as the tokenizers' regular expressions see it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed value: how the byte-level vocabulary cuts text into words.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
OTHER_SPACE = [chr(c) for c in (9, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
NO_RANK = np.int64(1 << 40)
#: Bytes that a worker's cached pieces, words and their ids may take, about.
CACHE_BYTES = 128 << 20
#: What a cached key takes besides its characters.
KEY_BYTES = 200
#: Bytes of a word from which on it is merged by itself.
LONG = 1024


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in names:
            names[b] = chr(extra)
            extra += 1
    return [names[b] for b in range(256)]


class Segments:
    """Flat storage of id lists that can be gathered by list number."""

    def __init__(self) -> None:
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)
        self.n = self.used = 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(sizes) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used : self.used + len(flat)] = flat
        ends = np.cumsum(sizes)
        self.start[self.n : self.n + len(sizes)] = self.used + ends - sizes
        self.size[self.n : self.n + len(sizes)] = sizes
        self.used += len(flat)
        self.n += len(sizes)

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists ``which`` one after another, and their sizes."""
        return gather(self.flat, self.start[which], self.size[which])


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(total)], sizes


class Numbers(dict):
    """Keys numbered in the order they are first asked for; ``bytes`` is about what they take."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.bytes = 0

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        self.bytes += len(key) + KEY_BYTES
        return n

    def fresh(self) -> list[str]:
        """The keys numbered since the last call."""
        new, self.new = self.new, []
        return new


class ByteBPE:
    """Encoder and decoder of one byte-level BPE vocabulary (a tokenizer file's JSON)."""

    def __init__(self, spec: str) -> None:
        spec = json.loads(spec)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        back = {s: b for b, s in enumerate(symbols)}
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.first = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int64)  # a word's last byte
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *added.values()]) + 1
        self.width = np.int64(size)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.index = pd.Index(self.keys)
        self.pair: dict[int, tuple[int, int]] | None = None
        pieces = [b""] * size
        for token, i in vocab.items():
            pieces[i] = bytes(back[c] for c in token)
        for token, i in added.items():
            pieces[i] = token.encode()
        sizes = np.array([len(p) for p in pieces], np.int64)
        self.byte_flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_start, self.byte_size = np.cumsum(sizes) - sizes, sizes
        self.added = added
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(WORDS)
        #: A space beside other white space, or white space at an end: there a cut at single spaces would change words.
        self.uneven = regex.compile(rf"\A[{SPACE}]| [{SPACE}]|[{SPACE}] |[{SPACE}]\Z")
        self._fresh()

    def _fresh(self) -> None:
        self.pieces, self.heads = Numbers(), Numbers()
        self.lists, self.head_lists = Segments(), Segments()

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: its lowest-ranked pairs, the leftmost of equals first, from a heap."""
        if self.pair is None:
            self.pair = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made[self.ranks].tolist(), strict=True), strict=True))
        raw, n, width, pair = np.frombuffer(word, np.uint8), len(word), int(self.width), self.pair
        sym = self.first[raw]
        sym[-1] = self.final[raw[-1]]
        key = sym[:-1] * self.width + sym[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == key)
        heap = (self.ranks[at[hit]] << 32 | hit).tolist()
        heapify(heap)
        rank = np.full(n, -1)
        rank[hit] = self.ranks[at[hit]]
        rank, sym, after, before = rank.tolist(), sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            r, i = divmod(heappop(heap), 1 << 32)
            if rank[i] != r:
                continue
            j = after[i]
            sym[i] = pair[sym[i] * width + sym[j]][1]
            k = after[i] = after[j]
            rank[j] = -1
            sym[j] = -1
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0:
                    found = pair.get(sym[a] * width + sym[b]) if b < n else None
                    rank[a] = found[0] if found else -1
                    if found:
                        heappush(heap, found[0] << 32 | a)
        sym = np.array(sym, np.int64)
        return sym[sym >= 0]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words`` (none empty), one after another, and how many each has."""
        long = [k for k, w in enumerate(words) if len(w) > LONG]
        if not long:
            return self.merge_rounds(words)
        apart = set(long)
        ids, sizes = self.merge_rounds([w for k, w in enumerate(words) if k not in apart])
        own = [self.merge_long(words[k]) for k in long]
        total = np.zeros(len(words), np.int64)
        is_long = np.zeros(len(words), bool)
        is_long[long] = True
        total[is_long], total[~is_long] = [len(x) for x in own], sizes
        out = np.empty(int(total.sum()), np.int64)
        here = np.repeat(is_long, total)
        out[here], out[~here] = np.concatenate(own), ids
        return out, total

    def _pair_ranks(self, sym: np.ndarray, wid: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin ``at`` these places; ``NO_RANK`` where none merges or a word ends."""
        rank = np.full(len(at), NO_RANK)
        inside = np.flatnonzero(wid[np.minimum(at + 1, len(wid) - 1)] == wid[at])
        inside = inside[at[inside] + 1 < len(wid)]
        left = at[inside]
        found = self.index.get_indexer(sym[left] * self.width + sym[left + 1])
        hit = found >= 0
        rank[inside[hit]] = self.ranks[found[hit]]
        return rank

    def merge_rounds(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of moderate length, all of them in each round."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes)
        sym = self.first[raw]
        sym[ends - 1] = self.final[raw[ends - 1]]
        wid = np.repeat(np.arange(len(words)), sizes)
        rank = self._pair_ranks(sym, wid, np.arange(len(sym)))
        done_sym, done_wid = [], []
        while len(sym):
            heads = np.flatnonzero(np.r_[True, wid[1:] != wid[:-1]])
            best = np.minimum.reduceat(rank, heads)
            low = np.repeat(best, np.diff(np.r_[heads, len(sym)]))
            over = low == NO_RANK
            if over.any():
                done_sym.append(sym[over])
                done_wid.append(wid[over])
            spot = np.flatnonzero((rank == low) & ~over)
            if len(spot):
                # a run of overlapping occurrences merges at its 1st, 3rd, 5th ... place
                breaks = np.r_[True, (spot[1:] != spot[:-1] + 1) | (wid[spot[1:]] != wid[spot[:-1]])]
                began = np.maximum.accumulate(np.where(breaks, np.arange(len(spot)), 0))
                spot = spot[(np.arange(len(spot)) - began) % 2 == 0]
                sym[spot] = self.made[rank[spot]]
            keep = ~over
            keep[spot + 1] = False
            sym, wid, rank = sym[keep], wid[keep], rank[keep]
            if len(spot):  # only pairs with a merged symbol have another rank now
                spot = np.cumsum(keep)[spot] - 1
                near = np.r_[spot, spot[spot > 0] - 1]
                rank[near] = self._pair_ranks(sym, wid, near)
        sym, wid = np.concatenate(done_sym), np.concatenate(done_wid)
        return sym[np.argsort(wid, kind="stable")], np.bincount(wid, minlength=len(words))

    def _held(self) -> int:
        """Bytes that the caches take, about."""
        return sum(n.bytes for n in (self.pieces, self.heads)) + sum(4 * x.used + 16 * x.n for x in (self.lists, self.head_lists))

    def _learn(self, lists: Segments, new: list[str]) -> None:
        """Encode pieces not met before."""
        if new:
            lists.add(*self._by_words(new))

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without added tokens."""
        if self._held() > CACHE_BYTES:
            self._fresh()
        uneven = np.zeros(len(texts), bool)
        for k, t in enumerate(texts):
            quick = t[:1].isspace() or t[-1:].isspace() or "  " in t or "\n " in t or " \n" in t or any(c in t for c in OTHER_SPACE)
            uneven[k] = bool(quick and self.uneven.search(t))
        if not uneven.any():
            return self._by_pieces(texts)
        total = np.zeros(len(texts), np.int64)
        other, total[uneven] = self._by_words([t for t, u in zip(texts, uneven, strict=True) if u])
        own, total[~uneven] = self._by_pieces([t for t, u in zip(texts, uneven, strict=True) if not u])
        ids, here = np.empty(int(total.sum()), np.int32), np.repeat(uneven, total)
        ids[here], ids[~here] = other, own
        return ids, total

    def _by_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts word by word, each distinct word encoded once; nothing is cached."""
        cut, words = [self.words.findall(t) for t in texts], Numbers()
        number = np.array([words[w] for ws in cut for w in ws], np.int64)
        flat, sizes = self.merged([w.encode() for w in words.fresh()])
        ids, each = gather(flat, (np.cumsum(sizes) - sizes)[number], sizes[number])
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        ends, bounds = np.cumsum(np.r_[0, each]), np.cumsum(counts)
        return ids, ends[bounds] - ends[bounds - counts]

    def _by_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that may be cut at single spaces: first pieces, and those that follow a space."""
        first, rest, counts = [], [], []
        get, head = self.pieces.__getitem__, self.heads.__getitem__
        for t in texts:
            p = t.split(" ")
            first.append(head(p[0]))
            counts.append(len(p))
            p[0] = ""
            rest += map(get, p)
        self._learn(self.head_lists, self.heads.fresh())
        self._learn(self.lists, [" " + x if x else "" for x in self.pieces.fresh()])
        counts = np.array(counts, np.int64)
        bounds = np.cumsum(counts)
        ids, sizes = self.lists.gather(np.array(rest, np.int64))  # the empty piece in each text's first place has no ids
        ends = np.cumsum(np.r_[0, sizes])
        tails = ends[bounds] - ends[bounds - counts]
        heads, head_sizes = self.head_lists.gather(np.array(first, np.int64))
        total = head_sizes + tails
        out = np.empty(int(total.sum()), np.int32)
        is_head = np.repeat(np.tile([True, False], len(texts)), np.stack([head_sizes, tails], 1).ravel())
        out[is_head], out[~is_head] = heads, ids
        return out, total

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each text has."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if self.split_added is None or not any(a in t for a in self.added for t in texts):
            return self._plain(texts)
        runs, owner, fixed = [], [], []
        for i, t in enumerate(texts):
            for k, x in enumerate(self.split_added.split(t)):
                runs.append("" if k % 2 else x)
                fixed.append(self.added[x] if k % 2 else -1)
                owner.append(i)
        ids, sizes = self._plain(runs)
        fixed, out, at = np.array(fixed), [], 0
        for f, n in zip(fixed, sizes, strict=True):
            out.append(np.array([f], np.int32) if f >= 0 else ids[at : at + n])
            at += n
        total = np.where(fixed >= 0, 1, sizes)
        return np.concatenate(out), np.bincount(owner, weights=total, minlength=len(texts)).astype(np.int64)

    def decode_bytes(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of all id lists, one after another, and how many each list has."""
        flat, each = gather(self.byte_flat, self.byte_start[ids], self.byte_size[ids])
        ends, bounds = np.cumsum(np.r_[0, each]), np.cumsum(sizes)
        return flat.tobytes(), ends[bounds] - ends[bounds - sizes]

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(np.array(ids, np.int64), np.array([len(ids)]))[0].decode("utf-8", "replace")


_made: dict[int, ByteBPE] = {}


def _codec(spec: str) -> ByteBPE:
    key = hash(spec)
    if key not in _made:
        _made.clear()
        _made[key] = ByteBPE(spec)
    return _made[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(spark: SparkSession, docs: DataFrame, *, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text.  The vocabulary file (1 to 2 MB) is read once and broadcast."""
    spec = spark.sparkContext.broadcast(open(vocabulary or default_vocabulary(), encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for batch in batches:
            for start, texts in text_slices(batch, text_col):
                ids, sizes = codec.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([rows_of(batch, start, len(texts), id_col), lists], [id_col, "ids"])

    picked = docs.select(id_col, text_col)
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, ids array<int>")


def decode(spark: SparkSession, df: DataFrame, *, vocabulary: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every list of ids; a null list gives an empty text."""
    spec = spark.sparkContext.broadcast(open(vocabulary or default_vocabulary(), encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for batch in batches:
            col = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            sizes = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            raw, each = codec.decode_bytes(col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes)
            ends = np.cumsum(each)
            texts = [raw[e - n : e].decode("utf-8", "replace") for e, n in zip(ends, each, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    picked = df.select(id_col, ids_col)
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, text string")


def round_trip(spark: SparkSession, docs: DataFrame, *, vocabulary: str | None = None) -> DataFrame:
    """Encode, decode and digest each text in one pass over the rows, without a shuffle."""
    spec = spark.sparkContext.broadcast(open(vocabulary or default_vocabulary(), encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sha = _codec(spec.value), hashlib.sha256
        for batch in batches:
            for start, texts in text_slices(batch):
                ids, sizes = codec.encode(texts)
                packed = memoryview(ids.astype("<u4").tobytes())
                raw, each = codec.decode_bytes(ids, sizes)
                ends, tails = np.cumsum(sizes).tolist(), np.cumsum(each).tolist()
                id_sha = [sha(packed[4 * (e - n) : 4 * e]).hexdigest() for e, n in zip(ends, sizes.tolist(), strict=True)]
                text_sha = [sha(raw[e - n : e].decode("utf-8", "replace").encode()).hexdigest() for e, n in zip(tails, each.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows_of(batch, start, len(texts), "doc_id"), pa.array(sizes, pa.int64()), pa.array(id_sha), pa.array(text_sha)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    picked = docs.select("doc_id", "text")
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded with the 50k byte-level vocabulary."""
    return round_trip(spark, table(spark, sf_dir, "documents"))
