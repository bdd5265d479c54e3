"""The near-duplicate stage against brute-force Jaccard on planted copies."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quirefold.llm import jaccard, tokengroups

from .test_llm import DOCS


def plain_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def planted(seed=5):
    """Texts with copies that have some words replaced, a shared passage in many, and short ones."""
    rng = random.Random(seed)
    words, passage, texts = [f"w{i}" for i in range(3000)], [f"p{i}" for i in range(30)], []
    for i in range(60):
        base = rng.choices(words, k=rng.choice([12, 40, 120, 400]))
        if i % 3 == 0:
            base[5:5] = passage
        texts.append(base)
        for changes in (0, 1, 2, 4, 7, 10):
            copy = list(base)
            for _ in range(changes * len(base) // 200 + (changes > 0)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy[rng.choice([0, 0, 1, len(copy) // 8]) :])
    return [" ".join(t) for t in texts] + ["A b C", "a  b c", "a b", "", None, "x y z u v", "x y z u v w"]


def test_all_pairs_at_four_fifths(spark):
    texts = planted()
    own = [plain_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    just_linked = 0
    for i, j in itertools.combinations(range(len(texts)), 2):
        both, either = len(own[i] & own[j]), len(own[i] | own[j])
        if 5 * both >= 4 * either:
            just_linked += 5 * both < 4.5 * either
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    assert just_linked > 30
    want = {i for i in range(len(texts)) if find(i) == i}
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(5)
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()} == want
    # the order of shingles and the fingerprints' radius change no result
    got = [jaccard.near_duplicates(spark, docs, radius=r).orderBy("doc_id").collect() for r in (0, 3)]
    assert got[0] == got[1] and [r.component_id for r in got[0]] == [find(i) for i in range(len(texts))]


def test_shared_prefix_in_any_order():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.sort(rng.choice(10_000, n, replace=False)).astype(np.uint64)
        y = np.sort(np.r_[x[rng.random(n) < 0.9], rng.integers(10_000, 20_000, rng.integers(0, n // 8 + 1)).astype(np.uint64)])
        y = np.unique(y)
        both = len(np.intersect1d(x, y))
        often = rng.choice(20_000, 10_000, replace=False)
        if len(y) and 9 * both >= 4 * (len(x) + len(y)):
            often = np.sort(often).astype(np.uint64)
            assert len(np.intersect1d(tokengroups.prefix(x, often, 80), tokengroups.prefix(y, often, 80)))


def test_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 1), (None, None, "en", "s", 1)], DOCS)
    assert corpus_pipeline.near_duplicate_stage(spark, docs, "").count() == 2
    assert corpus_pipeline.near_duplicate_stage(spark, docs.where(F.lit(False)), "").count() == 0


def test_near_copies_propose_few_pairs(spark, monkeypatch):
    """A large group of near copies is joined through neighbours, not by all its pairs."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(400):
        t = list(base)
        t[rng.randrange(120)] = f"x{k}"
        texts.append(" ".join(t))
    rows, own = [], tokengroups.cut

    def counted(spark_, df, what, **options):
        out = own(spark_, df, what, **options)
        if what == "groups-meeting":
            rows.append(out.count())
        return out

    monkeypatch.setattr(tokengroups, "cut", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard.near_duplicates(spark, docs, radius=3).collect()
    assert len(got) == 400 and {r.component_id for r in got} == {0}
    assert sum(rows) < 40 * 400
