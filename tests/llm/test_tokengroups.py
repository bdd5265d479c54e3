"""The token-group join against all pairs, and its bounds."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from quirefold.llm import resampling, tokengroups as tg


def plain_set(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def plain_components(texts, size, percent):
    own = [plain_set(t, size) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(own[i] & own[j])
        if both and 100 * both >= percent * (len(own[i]) + len(own[j]) - both):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in own]


def planted(seed):
    """Near copies around the similarity asked for, families that are alike but not enough, shared passages, short and odd texts."""
    rng = random.Random(seed)
    words, passage, texts = [f"w{i}" for i in range(2500)], [f"p{i}" for i in range(60)], []
    for k in range(40):
        base = rng.choices(words, k=rng.choice([4, 15, 60, 200, 500]))
        if k % 3 == 0:
            base[3:3] = passage
        texts.append(base)
        for changes in (0, 1, 1, 2, 3, 5, 8):
            copy = list(base)
            for _ in range(changes * len(base) // 150 + (changes > 0)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy[rng.choice([0, 0, 1, len(copy) // 20]) :])
    family = rng.choices(words, k=100)
    for k in range(60):
        t = list(family)
        for x in range(4):
            t[rng.randrange(100)] = f"f{k}x{x}"
        texts.append(t)
    rng.shuffle(texts)
    return [" ".join(t) for t in texts] + ["A b C", "a  b\x0bc", "a b", "A\tB", "", None, " \n", "x", "ß x É", "ß x é", "long " * 3000, "long " * 2990]


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 70)])
def test_components_equal_all_pairs(spark, size, percent, monkeypatch):
    monkeypatch.setattr(tg, "GROUP", 8)
    texts = planted(size)
    root, sizes = plain_components(texts, size, percent)
    assert len(set(root)) < len(texts) - 100
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, node int, n string").repartition(6)
    got = tg.similar(spark, docs, size=size, percent=percent).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == root and [r.n_shingles for r in got] == sizes


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(None, text), (7, text), (7, text), (3, text + " end"), (None, "alone in this"), (9, None), (9, "")]
    got = sorted(map(repr, tg.similar(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert len(got) == 7
    told = {(r.doc_id, r.n_shingles, r.component_id) for r in tg.similar(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert told == {(None, 38, 3), (7, 38, 3), (3, 39, 3), (None, 1, None), (9, 0, 9)}
    assert tg.similar(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shingle_sets_are_those_of_the_words():
    texts = ["a b c d", "A  B c d", "a b", "ab c", "", "the cat the cat the cat", "x" * 40 + " y z", "x" * 40 + " y  w", "é ü ö", "one"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    sets = [s.tolist() for _, found in tg.own_sets(batch, 3) for s in found]
    assert [len(s) for s in sets] == [len(plain_set(t, 3)) for t in texts] and all(s == sorted(set(s)) for s in sets)
    for (i, x), (j, y) in itertools.combinations(enumerate(sets), 2):
        assert len(set(x) & set(y)) == len(plain_set(texts[i], 3) & plain_set(texts[j], 3))


def test_word_hashes_tell_words_apart():
    words = [b"w%d" % k for k in range(20_000)] + [b"a" * k for k in range(1, 60)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    row, start, size = resampling.words_of(data, np.array([len(data)]), tg._SPACE)
    assert len(start) == len(words) and len(np.unique(tg.word_hashes(data, start, size))) == len(words)


def test_bounds_drop_no_pair():
    """A member similar to one of a group always reaches the group's union, whatever the bitmaps' widths."""
    rng = np.random.default_rng(1)
    dropped = 0
    for _ in range(400):
        n = int(rng.integers(1, 300))
        x = np.unique(rng.integers(0, 2**63, n)).astype(np.uint64)
        y = np.unique(np.r_[x[rng.random(len(x)) < rng.choice([0.5, 0.9, 0.97])], rng.integers(0, 2**63, rng.integers(0, n // 8 + 1)).astype(np.uint64)])
        other = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 200)))).astype(np.uint64)
        own, union = [tg.group_row(list(enumerate(m)), None, 90) for m in ([x], [s for s in (y, other) if len(s)])]
        bits, matrix = np.frombuffer(own[4], np.uint64)[None], np.frombuffer(union[5], np.uint64)[None]
        words = min(bits.shape[1], matrix.shape[1])
        keeps = len(tg.reaching(tg.folded(bits, words), np.array([len(x)]), tg.folded(matrix, words)[0], 90))
        dropped += not keeps
        if len(y) and tg.linked(x, y, 90):
            assert keeps and len(np.intersect1d(tg.prefix(x, other, 90), tg.prefix(y, other, 90)))
    assert dropped > 50


def test_a_large_group_of_near_copies_opens_few_groups(spark, monkeypatch):
    rng = random.Random(12)
    base, texts = [f"w{i}" for i in range(120)], []
    for k in range(1000):
        t = list(base)
        t[rng.randrange(120)] = f"x{k}"
        texts.append(" ".join(t))
    rows, own = {}, tg.cut

    def counted(spark_, df, what, **options):
        out = own(spark_, df, what, **options)
        rows.setdefault(what, []).append(out.count())
        return out

    monkeypatch.setattr(tg, "cut", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = tg.similar(spark, docs).collect()
    assert len(got) == 1000 and {r.component_id for r in got} == {0}
    assert rows["groups-need"] == [1000] and sum(rows["groups-meeting"]) < 2000 and sum(rows["groups-open"]) < 1000


def test_texts_of_their_own_are_left_out_early(spark):
    docs = spark.createDataFrame([(k, " ".join(f"d{k}w{i}" for i in range(50))) for k in range(200)] + [(900, "p q r s " * 9), (901, "p q r s " * 9 + "t")], "doc_id long, text string")
    assert tg.not_alone(docs, 3, 80, 20_000).count() == 2


def test_copies_count_when_shingles_are_dealt_out(spark, monkeypatch):
    """A bucket holds about as many shingles however often each row comes, and one bucket is held at a time."""
    from quirefold.llm import jaccard

    texts = planted(5)[:40]
    rows = [(k * 1000 + i, t) for k in range(12) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6, "doc_id")
    given, links = [], tg.links
    monkeypatch.setattr(tg, "links", lambda *a, **k: given.append(k["shingles"]) or links(*a, **k))
    monkeypatch.setattr(tg, "BUCKET", 5_000)  # several buckets in each of few tasks
    found = {r.doc_id: r.component_id for r in tg.similar(spark, docs, size=3, percent=90).collect()}
    root, n = plain_components(texts, 3, 90)
    assert given == [12 * sum(n)]
    least = {r: root.index(r) for r in set(root)}
    assert found == {i: least[root[i % 1000]] for i, _ in rows}
    jaccard.near_duplicates(spark, docs, radius=3)
    assert given[1] == 12 * sum(plain_components(texts, 5, 80)[1])
