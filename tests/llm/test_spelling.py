"""Spelling variants against all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from quirefold.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:k] + t[k + 1 :] == s for k in range(len(t)))


def plain(rows, least_length=5, least_count=3, ratio=2, loses=97):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % loses == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}
    near = {w: set() for w in n}
    for a, b in itertools.combinations(n, 2):
        if one_edit(a, b):
            near[a].add(b)
            near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def mutated(rng, w):
    k, c = rng.randrange(len(w) + 1), rng.choice("abcdéàÿ")
    return rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]])


def test_variants_equal_all_pairs(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeé", k=rng.randrange(4, 13))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "Ébène", "ébène", "x×y÷zz"]
    for w in list(words):
        words += [mutated(rng, w) for _ in range(4)]
        words += [mutated(rng, words[-1]) for _ in range(2)]
    rows = [(i, " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=400)).title() + ".é-1") for i in range(12)] + [(None, "aaaaa aaaaa"), (None, None), (77, "")]
    rows.append(rows[0])
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, word int, form string").repartition(4)
    got = spelling.variants(spark, docs, loses=7)
    want = plain(rows, loses=7)
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == want
    assert len(want) > 150 and sum(w[1] is not None for w in want) > 30 and any(w[2] not in (w[0], w[1]) for w in want)


def test_every_edit_of_every_place_is_found(spark):
    for length in range(2, 12):
        w = "abcdefghijkl"[:length]
        others = {w[:k] + "z" + w[k:] for k in range(length + 1)} | {w[:k] + "z" + w[k + 1 :] for k in range(length)} | {w[:k] + w[k + 1 :] for k in range(length)} | {w + w[-1], w[0] + w, w[: length // 2] + w[length // 2 - 1] + w[length // 2 :]}
        words = spark.createDataFrame([(x, 1) for x in {w, *others}], "word string, n long")
        pairs = [(r.a, r.b) for r in spelling.near_pairs(words).collect()]
        assert len(pairs) == len({frozenset(p) for p in pairs})
        assert {frozenset(p) for p in pairs} == {frozenset(p) for p in itertools.combinations({w, *others}, 2) if one_edit(*p)}


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(37)] + [("u", "w5")], "word string, form string")
    assert {r.root for r in spelling.roots(spark, forms).collect()} == {"w37"}
    assert spelling.roots(spark, forms.where("false")).count() == 0


def test_held_words_are_passed_on(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "alpha beta gamma delta alpha") for i in range(50)], "doc_id long, text string").coalesce(1)
    want = {tuple(r) for r in spelling.word_counts(docs, loses=None).collect()}
    monkeypatch.setattr(spelling, "HELD", 2)
    assert {tuple(r) for r in spelling.word_counts(docs, loses=None).collect()} == want == {("alpha", 100), ("beta", 50), ("gamma", 50), ("delta", 50)}


def test_long_runs_and_nothing(spark):
    long = "ab" * 100_000
    docs = spark.createDataFrame([(k, f"{long} {long}c") for k in range(3)], "doc_id long, text string")
    got = spelling.variants(spark, docs, loses=None).select(F.length("word").alias("l"), "n", "n_near", "form").collect()
    assert sorted((r.l, r.n, r.n_near, r.form) for r in got) == [(200_000, 3, 1, None), (200_001, 3, 1, None)]
    assert spelling.variants(spark, docs.where("false")).count() == 0
