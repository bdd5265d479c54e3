"""Importance resampling against a plain version, and its byte automaton against zlib and regular expressions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirefold.llm import resampling as rs

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, most=1):
    words = WORD.findall((text or "").encode().lower())
    return words, [b" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, most=1, buckets=rs.BUCKETS, least=rs.LEAST_WORDS, percent=rs.PERCENT):
    count = lambda texts: Counter(zlib.crc32(f) % buckets for t in texts for f in plain_features(t, most)[1])
    s, t = count(x for _, x in docs), count(target)
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for i, text in docs:
        words, found = plain_features(text, most)
        weight = sum(gain(zlib.crc32(f) % buckets) for f in found)
        h = int(hashlib.sha256(f"{rs.SEED}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = Counter(), percent * len(able) // 100
    drawn = [(r[0], r[3], k + 1) for k, r in enumerate(able[: ranks[1]])]
    return [r[:4] for r in rows], drawn


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abZ09 ééñ-.\n日\x00", max_size=40)), max_size=8), st.integers(1, 4))
def test_automaton_is_crc_of_the_words(texts, most):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]).slice(0)
    got = []
    for first, data, ends in rs.buffers(batch, "text"):
        n_words, row, bucket = rs.features(data, ends, most, 1 << 31)
        got += sorted(zip((row + first).tolist(), bucket.tolist(), strict=True))
        assert n_words.tolist() == [len(plain_features(t)[0]) for t in texts[first : first + len(ends)]]
    assert sorted(got) == sorted((i, zlib.crc32(f) % (1 << 31)) for i, t in enumerate(texts) for f in plain_features(t, most)[1])


def test_table_and_long_words():
    assert [zlib.crc32(bytes([b])) ^ 0xFFFFFFFF for b in range(256)] == [int(rs._STEPS[(0xFFFFFFFF ^ b) & 255] ^ (0xFFFFFFFF >> 8)) for b in range(256)]
    data = np.frombuffer(b"x" * 1_000_000 + b"ab", np.uint8)
    got = rs.advance(np.full(3, 0xFFFFFFFF, np.uint32), data, np.array([0, 1_000_000, 5]), np.array([1_000_000, 2, 0])) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(b"x" * 1_000_000), zlib.crc32(b"ab"), 0]


def test_slices_of_a_batch(monkeypatch):
    texts = ["one two", None, "three", "", "four five six"] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(3, 70)
    monkeypatch.setattr(rs, "SLICE_BYTES", 16)
    seen = [(first + k, data[a:b].tobytes().decode()) for first, data, ends in rs.buffers(batch, "text") for k, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))]
    assert [t for _, t in seen] == [t or "" for t in texts[3:73]] and [k for k, _ in seen] == list(range(70))


@pytest.mark.parametrize("most", [1, 2])
def test_resample_equals_plain(spark, most):
    rows = [(i, " ".join(f"w{(i * k) % 37}" for k in range(i % 60))) for i in range(300)] + [(300, None), (301, ""), (302, "É é 5x"), (None, "w1 w2 " * 15)]
    target = ["w3 w4 w5", "w3 w9 É", None]
    docs, wanted = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, score string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string")
    got = rs.resample(spark, docs, wanted, max_words=most, buckets=1000, percent=25).collect()
    want, drawn = plain(rows, target, most, 1000, percent=25)
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(want, key=key)
    assert sorted((r.rank, r.doc_id, r.score) for r in got if r.rank) == [(k, i, s) for i, s, k in drawn]


def test_repeated_rows_and_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b c " * 10)] * 40, "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    got = rs.resample(spark, docs, none, percent=50).collect()
    assert len(got) == 40 and sorted(r.rank for r in got if r.rank) == list(range(1, 21)) and len({r.score for r in got}) == 1
    assert rs.resample(spark, none, docs).collect() == []
