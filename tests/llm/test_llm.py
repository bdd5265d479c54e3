"""Every operator against a brute-force version, an exact round trip or held-out accuracy, and the edge cases all share."""

import hashlib
import itertools
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirefold.llm import bpe, langid, ogg, packing, pitman_yor, quality, simhash, topk, toxicity, warc
from quirefold.llm.common import scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [None, "", "   ", "a", "Ünï Ça\nva　ok", "word " * 30_000, "same text here twice", "same text here twice", "x <|endoftext|> y", "\x1c\x1d 日本語 🙂 ΑΣ"]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [(i if i != 4 else None, t, None, None, None, "c", 1.0, 7) for i, t in enumerate(EDGE)]
    rows.append(rows[7])
    return spark.createDataFrame(rows, DOCS + ", ids string, score double, fp long")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- byte-level BPE ---

HARD = ["", " ", "  a  b ", "it's I'll", "\n\n x\ty", "aaaaaaaa", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "１２3 ½ é ñ", "\x85\xa0 z", "\x1c x"]


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_bpe_equals_library(texts):
    path = bpe.default_vocabulary()
    ours, theirs = bpe._codec(open(path, encoding="utf-8").read()), library(path)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + HARD
    ids, sizes = ours.encode(texts)
    ends = np.cumsum(sizes)
    for t, e, n in zip(texts, ends, sizes, strict=True):
        got = ids[e - n : e].tolist()
        want = theirs.encode(t, add_special_tokens=False).ids
        assert got == want, t
        assert ours.decode(got) == theirs.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "a", "ab", "the", "éß日"])
def test_bpe_long_words_equal_library(letters):
    """Words beyond the length at which rounds end, alone and between others."""
    rng = random.Random(8)
    words = ["".join(rng.choices(letters, k=k)) for k in (bpe.LONG - 1, bpe.LONG, bpe.LONG + 1, 5000)]
    texts = [*words, " ".join(words), "x " + words[3] + " y"]
    for codec, theirs in ((_codec(), library(bpe.default_vocabulary())), (packing.WordIds(open(packing.default_vocabulary()).read()), library(packing.default_vocabulary()))):
        ids, sizes = codec.encode(texts) if isinstance(codec, bpe.ByteBPE) else codec.encode(texts, None)
        assert np.split(ids, np.cumsum(sizes)[:-1])[0].tolist() == theirs.encode(texts[0], add_special_tokens=False).ids
        assert ids.tolist() == [i for t in texts for i in theirs.encode(t, add_special_tokens=False).ids]


def _codec():
    return bpe.ByteBPE(open(bpe.default_vocabulary()).read())


def test_bpe_million_letters():
    word = "".join(random.Random(9).choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    codec, began = _codec(), time.process_time()
    ids, _ = codec.encode([word])
    assert time.process_time() - began < 30
    assert ids.tolist() == library(bpe.default_vocabulary()).encode(word, add_special_tokens=False).ids


def test_bpe_caches_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 1 << 20)
    codec, rng = _codec(), random.Random(10)
    for k in range(60):
        codec.encode([" ".join(f"w{rng.random()}" for _ in range(40)) + "  \n  x" + f"y{k}" * 300 for _ in range(20)])
        assert codec._held() < 3 << 20


def test_packing_spreads_repeated_rows(spark):
    docs = spark.range(6000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("some words that repeat").alias("text"))
    rows = packing.pack(spark, packing.cut_pieces(spark, docs), group_pieces=500).select((F.col("sequence_id") / 2**32).cast("int").alias("g")).groupBy("g").count().collect()
    assert len(rows) == 12 and max(r["count"] for r in rows) < 700


def test_bpe_decodes_broken_sequences_like_library():
    path = bpe.default_vocabulary()
    ours, theirs = bpe._codec(open(path, encoding="utf-8").read()), library(path)
    for ids in ([447], [447, 10], [5, 447, 247], [188, 50256]):
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_bpe_round_trip_frames(spark, edge, empty):
    theirs = library(bpe.default_vocabulary())
    got = bpe.round_trip(spark, edge).collect()
    assert len(got) == edge.count()
    want = Counter()
    for r in edge.collect():
        ids = theirs.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want
    back = bpe.decode(spark, bpe.encode(spark, edge)).collect()
    assert Counter(r.text for r in back) == Counter(r.text or "" for r in edge.collect())
    assert bpe.round_trip(spark, empty).count() == 0


# --- Ogg ---


def slow_crc(data):
    c = 0
    for b in data:
        c ^= b << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if c & 0x80000000 else c << 1
    return c


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=200))
def test_ogg_crc(data):
    assert ogg.page_crc(data) == slow_crc(data)


@pytest.mark.parametrize("n", [0, 1, 254, 255, 256, 510, 65_025, 65_026, 70_000])
def test_ogg_packets_of_any_size(n):
    streams = [[(b"head", 0), (bytes([k]) * n, n), (b"z" * (n + k), 2 * n + k)] for k in (1, 2)]
    media = ogg.multiplex([ogg.to_pages(k, s) for k, s in enumerate(streams)])
    for k, s in enumerate(streams):
        assert [p.data for p in ogg.read_packets(ogg.read_pages(media)) if p.serial == k] == [d for d, _ in s]


def test_ogg_damage_is_found_and_skipped():
    payload = random.Random(1).randbytes(300_000)
    media = ogg.store(payload)
    assert ogg.load(media)[0] == payload
    broken = bytearray(media)
    broken[len(media) // 2] ^= 1
    assert [p.ok for p in ogg.read_pages(bytes(broken))].count(False) == 1
    with pytest.raises(ValueError):
        ogg.load(bytes(broken))
    whole, kept = [p.data for p in ogg.read_packets(ogg.read_pages(media))], [p.data for p in ogg.read_packets(ogg.read_pages(bytes(broken)))]
    assert 0 < len(kept) < len(whole) and all(x in whole for x in kept)


def test_ogg_timestamps(spark):
    df = spark.createDataFrame([(1, bytes(20_000)), (2, None)], "id int, payload binary")
    rows = ogg.packet_rows(ogg.write_column(df, id_col="id", payload_col="payload"), id_col="id").where("seconds is not null").collect()
    assert {r.id for r in rows} == {1} and max(r.seconds for r in rows) == 20_000 / ogg.RATE


def test_ogg_query(edge, empty):
    rows = {(r.doc_id, r.n_bytes): r for r in ogg.round_trip(edge).collect()}
    for r in edge.collect():
        raw = (r.text or "").encode()
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        got = rows[r.doc_id, len(raw)]
        assert (got.payload_bytes, got.payload_sha256, got.tail_crc32) == (len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    same = [r for r in ogg.round_trip(edge).collect() if r.doc_id in (6, 7)]
    assert len({(r.media_sha256, r.feature) for r in same}) == 1
    assert ogg.round_trip(empty).count() == 0


# --- packing ---


def plain_first_fit(sizes, capacity):
    bins, out = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for b, room in enumerate(bins):
            if room >= sizes[i]:
                break
        else:
            b = len(bins)
            bins.append(capacity)
        out[i] = (b, capacity - bins[b])
        bins[b] -= sizes[i]
    return [out[i] for i in range(len(sizes))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_tournament_is_first_fit_decreasing(sizes):
    bins, offsets = packing.tournament_first_fit(np.array(sizes, np.int64), 50)
    assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == plain_first_fit(sizes, 50)


def test_tournament_rejects_what_cannot_fit():
    with pytest.raises(ValueError):
        packing.tournament_first_fit(np.array([51]), 50)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_word_ids_equal_library(texts):
    path = packing.default_vocabulary()
    ours, theirs = packing._word_ids(open(path, encoding="utf-8").read()), library(path)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + HARD + ["ΑΣ Σ", "é İ", "<|startoftext|>A<|endoftext|>"]
    ids, sizes = ours.encode(texts, None)
    ends = np.cumsum(sizes)
    for t, e, n in zip(texts, ends, sizes, strict=True):
        assert ids[e - n : e].tolist() == theirs.encode(t, add_special_tokens=False).ids, t


def test_letters_newer_than_pythons_tables_equal_library():
    path = packing.default_vocabulary()
    ours, theirs = packing.WordIds(open(path, encoding="utf-8").read()), library(path)
    texts = [f.replace("@", c) for c in "\U000323b0\u088f\ua7cb\u0558\U00010d50\U00016ea0" for f in (":@", "a@", "@A", "x :@b y", "<|endoftext|>:@")]
    ids, sizes = ours.encode(texts, None)
    for t, e, n in zip(texts, np.cumsum(sizes), sizes, strict=True):
        assert ids[e - n : e].tolist() == theirs.encode(t, add_special_tokens=False).ids, t


def test_word_ids_grow_with_words_and_not_with_chunks():
    path = packing.default_vocabulary()
    ours, theirs = packing.WordIds(open(path, encoding="utf-8").read()), library(path)
    texts = [f"the{p}OF{q}And {n}{p}the" for n in range(40) for p in ",.;:" for q in "!?*"]
    ids, sizes = ours.encode(texts, 2)
    assert len(ours.numbers) <= 3 + 10 + 7  # words, digits, signs; there are 172 chunks
    assert ids.tolist() == [i for t in texts for i in [*theirs.encode(t, add_special_tokens=False).ids, 2]]
    assert sizes.sum() == len(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("''stmdrevlST1\u0662!\u00e9\u01c5\u0301\u4e00\U0001d400\U0001f600 \n\u00a0\u3000\x1c<|\ufffe\U000323b0", max_size=14), max_size=5))
def test_word_bounds_equal_library(texts):
    path = packing.default_vocabulary()
    ours, theirs = packing._word_ids(open(path, encoding="utf-8").read()), library(path)
    ids, sizes = ours.encode(texts, None)
    assert len(sizes) == len(texts)
    for t, e, n in zip(texts, np.cumsum(sizes), sizes, strict=True):
        assert ids[e - n : e].tolist() == theirs.encode(t, add_special_tokens=False).ids, t


def test_packing_holds_every_id_once(spark, edge, empty):
    theirs = library(packing.default_vocabulary())
    rows = packing.pack_documents(spark, edge).collect()
    want = Counter()
    for r in edge.collect():
        ids = [*theirs.encode(r.text or "", add_special_tokens=False).ids, 2]
        for start in range(0, len(ids), 4096):
            piece = ids[start : start + 4096]
            want[r.doc_id, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert packing.pack_documents(spark, empty).count() == 0


def test_packed_sequences(spark, edge):
    pieces = packing.cut_pieces(spark, edge, with_ids=True)
    seqs = packing.sequences(packing.pack(spark, pieces)).collect()
    assert sum(r.n_tokens for r in seqs) == pieces.agg(F.sum("length")).first()[0]
    assert all(len(r.ids) == 4096 or r.n_tokens & (r.n_tokens - 1) == 0 for r in seqs)


# --- classifiers ---


def corpus(n=900):
    rng = random.Random(3)
    words = {lang: ["".join(rng.choice(abc) for _ in range(rng.randint(2, 6))) for _ in range(120)] for lang, abc in {"en": "thewandis", "de": "schenüßrg", "fr": "éàlequvoi", "es": "ñoradelcí"}.items()}
    docs, labels = [], []
    for i in range(n):
        lang = ["en", "de", "fr", "es"][i % 4]
        body = [rng.choice(words[lang]) for _ in range(rng.randint(20, 80))]
        toxic, good = i % 7 == 0, i % 5 != 0
        if toxic:
            body[rng.randrange(len(body))] = "scum"
        if i % 3 == 0:
            body[rng.randrange(len(body))] = rng.choice(["women", "men", "muslims", "christians"])
        if not good:
            body = [body[0]] * len(body) if not toxic else [body[0]] * len(body) + ["scum"]
        docs.append((i, " ".join(body), lang, "s", 0))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.fixture(scope="session")
def labelled(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out_and_edges(spark, labelled, edge, empty):
    docs, labels = labelled
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.train(docs.where(~held), labels)
    rows = toxicity.score(spark, docs.where(held), model, ["doc_id"]).join(labels, "doc_id").collect()
    assert all((r.score >= 0.3) == bool(r.toxic) for r in rows)
    scores = toxicity.score(spark, edge, model, ["doc_id"]).collect()
    assert len(scores) == edge.count() and all(0 <= r.score <= 1 for r in scores)
    none = toxicity.train(empty, labels)
    assert [r.score for r in toxicity.score(spark, edge, none, ["doc_id"]).collect()] == [0.0] * edge.count()


def test_toxicity_penalty_acts_without_identity_terms(spark, labelled):
    """Labelled texts that name no group: what a term shares with an insult still weighs less with the penalty, and held-out results stay."""
    docs, labels = labelled
    insult = docs.withColumn("text", F.regexp_replace("text", "scum", "moron"))
    scores = {}
    for penalty in (0.0, 1.0):
        model = toxicity.train(insult, labels, penalty=penalty)
        assert model.acting > 0
        mention, plain, toxic = model.score(["a moroccan said so", "a tunisian said so", "a moron said so"])
        scores[penalty] = mention - plain
        assert toxic >= 0.3 > plain
    assert scores[1.0] < scores[0.0] / 2 and scores[0.0] > 0


def test_toxicity_swaps_are_penalised():
    """A term that only meets toxic rows keeps less weight against its counterparts with the penalty."""
    base = [{"fine", f"w{i % 9}"} for i in range(60)] + [{"women", "scum", f"w{i % 9}"} for i in range(30)]
    rows, y = [toxicity.text_features(s) for s in base], np.r_[np.zeros(60), np.ones(30)]
    swaps = [p for s in base for p in toxicity.counterfactuals(s)]
    assert len(swaps) == 120
    gap = {}
    for penalty in (0.0, 5.0):
        model = toxicity.ToxicityModel(rows, y, swaps, penalty=penalty)
        a, b = model.score(["women were fine", "men were fine"])
        gap[penalty] = a - b
    assert gap[5.0] < gap[0.0] / 2


def test_language_held_out_and_edges(spark, labelled, edge, empty):
    docs, _ = labelled
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.train(docs.where(~held))
    rows = langid.predict(spark, docs.where(held), model, ["doc_id", "lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    got = {r.doc_id: r for r in langid.predict(spark, edge, model, ["doc_id"]).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.predict(spark, edge, langid.train(empty), ["doc_id"]).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_quality_held_out_and_edges(spark, labelled, edge, empty):
    docs, labels = labelled
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = quality.train(docs.where(~held), labels)
    assert 0.7 < model.prior < 0.95  # four of five are good
    rows = quality.score(spark, docs.where(held), model, ["doc_id"]).join(labels, "doc_id").collect()
    assert sum((r.score >= 0.7) == bool(r.quality) for r in rows) > 0.95 * len(rows)
    scores = quality.score(spark, edge, model, ["doc_id"]).collect()
    assert len(scores) == edge.count() and all(0 <= r.score <= 1 for r in scores)
    assert {r.score for r in quality.score(spark, edge, quality.train(empty, labels), ["doc_id"]).collect()} == {0.0}


# --- SimHash ---


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, radius):
    n, root = len(fps), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(n), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 1000), st.integers(1, 3))
def test_linked_equals_brute_force(seed, radius):
    rng = random.Random(seed)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    fps = set(seeds)
    for _ in range(400):
        x = rng.choice(seeds)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    assert simhash.linked(fps, radius).tolist() == plain_components([int(x) for x in fps], radius)


def test_shards_meet_every_pair():
    rng = random.Random(5)
    fps = np.array(sorted({rng.getrandbits(64) for _ in range(3000)}), np.uint64)
    near = np.array([int(x) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in fps[:500]], np.uint64)
    both = np.r_[fps, near]
    nodes = simhash.fit_tree(fps, 8, 2)
    assert len(nodes) > 3
    where, index = simhash.route(both, nodes, 2)
    of = [set() for _ in both]
    for s, i in zip(where.tolist(), index.tolist(), strict=True):
        of[i].add(s)
    assert all(of[i] & of[len(fps) + i] for i in range(500)) and all(of)


def test_near_duplicates_equal_brute_force(spark, edge, empty):
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.choice([1, 2, 5, 300]))) for _ in range(40)]
    texts = base + [t + " tail" for t in base] + base[:10]
    docs = spark.createDataFrame([(1000 - i, t) for i, t in enumerate(texts)], "doc_id long, text string").unionByName(edge.select("doc_id", "text"))
    rows = docs.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    root = plain_components(fps, 2)
    least = {}
    for r, c in zip(rows, root, strict=True):
        if r.doc_id is not None:
            least[c] = min(least.get(c, 1 << 60), r.doc_id)
    want = Counter((r.doc_id, f, least.get(c)) for r, f, c in zip(rows, fps, root, strict=True))
    got = Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(spark, docs).collect())
    assert got == want
    assert simhash.near_duplicates(spark, empty).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1000, 999), (5000, 5000)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(spark, edges).collect()}
    assert all(got.get(i, 0) == 0 for i in range(n + 1)) and got[1000] == 999 and 5000 not in got


# --- WARC ---


def page_rows(spark):
    big = "<p>" + "x" * 2000 + "</p>"
    rows = [(1, "http://a/", big), (5, "http://b/\r\nEvil: 1", big), (3, None, big), (3, None, big), (None, "u", big), (7, "http://c/", "small"), (8, "http://d/", "small"), (9, "e", None), (10, "é", "ü" * 600)]
    return spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, payload string")


def test_warc_round_trip(spark):
    path = scratch(spark, "warc-test")
    warc.archive(spark, page_rows(spark), path)
    back = spark.read.format("warc").option("path", path)
    rows = back.load().collect()
    got = Counter((r.record_id.rpartition(":")[2], r.record_type, (r.refers_to or "").rpartition(":")[2], r.payload_length) for r in rows)
    size = len("<p></p>") + 2000
    assert got == Counter({("1", "revisit", "5", size): 1, ("5", "response", "", size): 1, ("3", "revisit", "5", size): 2, ("", "revisit", "5", size): 1, ("7", "response", "", 5): 1, ("8", "response", "", 5): 1, ("9", "response", "", 0): 1, ("10", "response", "", 1200): 1})
    by = {r.record_id: r for r in rows}
    assert by[warc.URN + "10"].payload.decode() == "ü" * 600 and by[warc.URN + "5"].target_uri == "http://b/%0D%0AEvil: 1"
    for size in (40, 300, 1 << 20):  # any cut into ranges gives each record once
        cut = back.option("rangeBytes", size).load()
        assert cut.count() == 9
        assert cut.where("record_type = 'revisit'").count() == 4
        assert cut.where("record_type in ('response') and target_uri is not null").count() == 5
    assert all(r.payload is None for r in back.option("payload", "false").load().collect())


def test_warc_filters_are_pushed():
    reader = warc.Reader({"path": "x"})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("content_length",), 5)]))
    assert len(left) == 1 and reader.tests == [("record_type", ["response"])]


def test_warc_append_and_overwrite(spark):
    """Appended records stay beside earlier ones; overwriting leaves the new ones alone."""
    path, pages = scratch(spark, "warc-append"), page_rows(spark)
    n = pages.count()
    read = lambda: spark.read.format("warc").option("path", path).load()
    warc.archive(spark, pages, path)
    warc.archive(spark, pages.withColumn("page_id", F.col("page_id") + 1000), path)
    assert read().count() == 2 * n
    rows = read().where("record_type = 'response'").limit(2).select("record_id", "record_type", "target_uri", "refers_to", "payload")
    kept = spark.createDataFrame(rows.collect(), rows.schema)
    kept.write.format("warc").mode("overwrite").option("path", path).save()
    assert sorted(r.record_id for r in read().collect()) == sorted(r.record_id for r in kept.collect())


def test_warc_empty_and_query(spark, tmp_path):
    page_rows(spark).where("page_id is not null").drop("payload").write.parquet(str(tmp_path / "pages.parquet"))
    rows = warc.op8_warc(spark, str(tmp_path)).collect()
    assert len(rows) == 8 and {r.payload_digest for r in rows if r.page_id == 9} == {hashlib.sha1(b"").hexdigest()}
    path = scratch(spark, "warc-none")
    warc.archive(spark, page_rows(spark).limit(0), path)
    assert spark.read.format("warc").option("path", path).load().count() == 0


# --- top-k ---


def plain_top(rows, k, every):
    ok = {}
    for i, x in rows:
        if i is not None and x and all(v is not None and math.isfinite(v) for v in x):
            ok[i] = [math.floor(256 * v) for v in x]
    out = []
    for i in (i for i in ok if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(ok[i], ok[j], strict=False)), j) for j in ok if j != i)[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    return Counter(out)


@pytest.mark.parametrize("kind", ["spread", "ties", "huge", "wide", "few"])
def test_top_k_equals_brute_force(spark, kind):
    rng = random.Random(4)
    n = {"few": 4}.get(kind, 400)
    rows = [(i, [rng.choice([0.0, 0.25]) if kind == "ties" else rng.gauss(0, {"huge": 10_000, "wide": 2e6 if i % 3 else 1e3}.get(kind, 0.3)) for _ in range(8)]) for i in range(n)]
    rows += [(n + 1, None), (n + 2, [None] * 8), (n + 3, [float("nan")] * 8), (n + 4, []), (None, [0.1] * 8), (n + 5, [0.5] * 5)]
    if kind == "ties":
        rows += [(1000 + i, rows[0][1]) for i in range(300)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    for every in (1, 7) if n < 100 else (50,):
        got = topk.top_k(spark, topk.quantise(df), every=every).collect()
        assert Counter(tuple(r)[:4] for r in got) == plain_top(rows, 5, every)


def test_top_k_bounds_stop_the_search(spark):
    """On clustered vectors few are scored, and the result is that of brute force."""
    rng = np.random.default_rng(5)
    middle = rng.normal(0, 1, (60, 32))
    x = middle[rng.integers(0, 60, 6000)] + rng.normal(0, 0.08, (6000, 32))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    got = topk.top_k(spark, topk.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).collect()
    assert np.mean([r.n_scored for r in got]) < 0.2 * len(rows)
    q = np.floor(256 * x)
    for i in range(0, 6000, 1000):
        s = (q @ q[i]).astype(np.int64)
        s[i] = -(2**62)
        want = np.lexsort((np.arange(6000), -s))[:5].tolist()
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])] == want


def test_top_k_sends_blocks_where_they_are_asked_for(spark, monkeypatch):
    """In many chunks of queries from clusters, both rounds send under a third of all blocks to all chunks; the result is that of brute force."""
    rng = np.random.default_rng(6)
    middle = rng.normal(0, 1, (60, 16))
    x = middle[rng.integers(0, 60, 4000)] + rng.normal(0, 0.05, (4000, 16))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    sent, chunks, plain = [], set(), topk.copied

    def counted(spark, blocks, asked):
        out = plain(spark, blocks, asked)
        sent.append(out.count())
        chunks.update(r["chunk"] for r in asked.select("chunk").distinct().collect())
        return out

    monkeypatch.setattr(topk, "copied", counted)
    monkeypatch.setattr(topk, "QUERY_CHUNK", 20)
    monkeypatch.setattr(topk, "BLOCK", 64)
    got = topk.top_k(spark, topk.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), every=10).collect()
    assert Counter(tuple(r)[:4] for r in got) == plain_top(rows, 5, 10)
    assert chunks == set(range(20))  # 400 queries
    assert sent[0] < 2 * 4000 and sum(sent) < 2 * 4000 * len(chunks) / 3, sent


def test_top_k_with_several_vectors_of_one_id(spark):
    rows = [(0, [1.0, 0.0])] + [(0, [1.0, 0.01 * j]) for j in range(1, 9)] + [(j, [0.1 * j, 0.0]) for j in range(1, 8)]
    got = topk.top_k(spark, topk.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).collect()
    assert Counter(r.vec_id for r in got) == {j: 9 for j in range(3, 8)}


def test_top_k_beyond_64_bits(spark):
    rows = [(0, [1e30]), (50, [2.0**50]), (1, [1.0]), (2, [2.0**52]), (3, [-(2.0**52)]), (4, [2.0**52]), (5, [2.0**55])]
    got = topk.top_k(spark, topk.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(50, 1, 2**63 - 1), (50, 2, 2**63 - 1), (50, 4, 2**63 - 1), (50, 3, 1 - 2**63)]


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(spark, topk.quantise(none)).count() == 0


# --- language model ---


def test_stirling_and_tables():
    d = 0.5
    s = pitman_yor.log_stirling(d)
    assert np.isclose(np.exp(s[3, 1]), (1 - d) * (2 - d)) and np.isclose(np.exp(s[3, 2]), 3 * (1 - d)) and np.isclose(s[3, 3], 0)
    rng = np.random.default_rng(0)
    count = np.full(20_000, 3)
    t = pitman_yor.draw_tables(rng, count, np.full(20_000, 0.7), d)
    p = np.array([(1 - d) * (2 - d) * 0.7, 3 * (1 - d) * 0.49, 0.343])
    assert np.allclose(np.bincount(t, minlength=4)[1:] / 20_000, p / p.sum(), atol=0.02)
    big = pitman_yor.draw_tables(rng, np.array([0, 1, 10**7]), np.array([1.0, 1.0, 2.0]), d)
    assert big[0] == 0 and big[1] == 1 and 1 < big[2] < 10**7


def test_language_model(spark, edge, empty):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["the", "of", "and", f"w{i % 50}", f"rare{i}"], [9, 5, 3, 4, 1], k=60))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(edge.select("doc_id", "text"))
    counts, tokens = Counter(), lambda t: [*(t or "").encode().lower().split(), None]
    for r in docs.collect():
        if zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 10:
            counts.update(tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for r in docs.collect():
        t = tokens(r.text)
        want[r.doc_id, len(t), sum(counts[w] > 0 for w in t), round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 3)] += 1
    got = pitman_yor.score_texts(spark, docs).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 3)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 20]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert pitman_yor.score_texts(spark, empty).count() == 0
