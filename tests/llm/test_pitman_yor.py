"""The language model against a closed form, over any partitioning, and with split words."""

import math
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from quirefold.llm import pitman_yor as lm
from quirefold.llm.common import fold


def held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 10 == 0


LEARNT = [i for i in range(4000) if not held(i)]
HELD = [i for i in range(4000) if held(i)]


@pytest.mark.parametrize("small", [False, True])
def test_any_partitioning(spark, monkeypatch, small):
    """Rare words, frequent ones and split ones; a slice of any size."""
    if small:  # many buckets, words beyond the frequent list, split words
        monkeypatch.setattr(lm, "BUCKET", 700)
        monkeypatch.setattr(lm, "SPLIT", 100)
        monkeypatch.setattr(lm, "SAMPLE_TEXTS", 60)
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"often{i}" for i in range(20)], k=60) + rng.choices([f"rare{i}" for i in range(900)], k=20)) for _ in range(300)]
    texts += texts[:20] + [None, "", "often1 never-seen"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [sorted((r.doc_id, r.score, r.base_score) for r in lm.score_texts(spark, docs.repartition(parts)).collect()) for parts in (1, 40)]
    assert got[0] == got[1] and len(got[0]) == len(texts)
    by_id = {i: s for i, s, _ in got[0]}
    assert all(by_id[i] == by_id[300 + i] for i in range(20)) and by_id[320] == by_id[321]


@pytest.mark.parametrize("small", [False, True])
def test_equals_closed_form(spark, monkeypatch, small):
    """One training text of distinct words: every table has one customer, so nothing is left to chance."""
    if small:
        monkeypatch.setattr(lm, "BUCKET", 5)
        monkeypatch.setattr(lm, "SAMPLE_TEXTS", 1)
    words = [f"w{i}" for i in range(60)]
    tests = ["", "w0 w1", "w0 w1 w2 w3", "w5 w4 w59", "w7 unseen w8", "unseen other", "w59", " ".join(reversed(words)), " ".join(words)]
    docs = spark.createDataFrame([(LEARNT[0], " ".join(words)), *zip(HELD, tests, strict=False)], "doc_id long, text string")
    learnt = [None, *words, None]
    follows = dict(zip(learnt[:-1], learnt[1:], strict=True))
    n = len(words) + 1  # tokens, kinds of word, contexts, tables
    d, theta = 0.95, lm.THETA

    def parent(w):
        known = w is None or w in follows
        base = (1 - lm.UNKNOWN) / n if known else lm.UNKNOWN
        return ((1 - d if known else 0) + (theta + d * n) * base) / (theta + n)

    def score(text):
        total, before = 0.0, None
        for w in [*text.split(), None]:
            has = before in follows
            p = ((1 - d if has and follows[before] == w else 0) + (theta + d * has) * parent(w)) / (theta + has)
            total, before = total + math.log10(p), w
        return total

    for r in lm.score_texts(spark, docs).collect():
        text = dict([(LEARNT[0], " ".join(words)), *zip(HELD, tests, strict=False)])[r.doc_id]
        assert abs(r.score - score(text)) < 1e-6, text
        assert r.train_tokens == n and r.n_tokens == len(text.split()) + 1


def buckets_of(words, texts):
    """A table's buckets, without Spark."""
    tokens, rows = lm.Tokens(), {}
    for uid in range(0, len(texts), 50):
        some = texts[uid : uid + 50]
        _, _, blocks = lm.slice_row(words, tokens, some, np.zeros(len(some), bool))
        for key, data in blocks:
            rows.setdefault(key, []).append((key, uid, None, None, None, data))
    names, kinds = ["key", "uid", "ids", "held", "sizes", "data"], [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
    table = lambda own: pa.table([pa.array(c, k) for c, k in zip(zip(*own, strict=True), kinds, strict=True)], names=names)
    gathered = {k: lm.gather(SimpleNamespace(value=words), table(own)) for k, own in rows.items()}
    return {k: lm.Bucket(words, t.column("data")[0].as_py()) for k, t in gathered.items()}


def summed(facts, buckets, n_context, n_word):
    out = SimpleNamespace(of_context=np.zeros((n_context, lm.FREQUENT + 1), np.int64), of_word=np.zeros((n_word, lm.FREQUENT + 1), np.int64), sums=0)
    for b, (of_context, of_word, sums) in zip(buckets, facts, strict=True):
        for row, x in zip(out.of_context, of_context, strict=True):
            np.add.at(row, b.code, x)
        for row, x in zip(out.of_word, of_word, strict=True):
            np.add.at(row, b.word_code[b.is_split], x[b.is_split])
        out.sums = out.sums + np.array(sums, float)
    return out


def sampled(monkeypatch, burn_in=lm.BURN_IN):
    """(plan, sweeps, buckets, their kept sweeps) of a corpus with split words."""
    monkeypatch.setattr(lm, "BUCKET", 3000)
    monkeypatch.setattr(lm, "SPLIT", 400)
    monkeypatch.setattr(lm, "BURN_IN", burn_in)
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(400):
        at = rng.randrange(40)
        for _ in range(40):
            at = rng.choice([at, (at * 7 + rng.randrange(4)) % 40, rng.randrange(int(rng.paretovariate(0.7)) % 40 + 1)])
            texts.append(vocabulary[at])
    texts = [" ".join(texts[i : i + 40]) for i in range(0, len(texts), 40)]
    counts = {w: sum(t.split().count(w) for t in texts) for w in vocabulary} | {"": len(texts)}
    words = lm.Words([(xxhash.xxh64_intdigest(w.encode()), n) for w, n in counts.items()], sum(counts.values()))
    assert words.parts.max() > 2 and words.buckets > 3
    buckets = buckets_of(words, texts)
    own = list(buckets.values())
    plan = lm.Plan(words, summed([lm.first_facts(b) for b in own], own, 2, 2))
    kept = [list(lm.chain(plan, k, b, plan.tables[b.code], np.where(b.is_split, plan.spread[b.word_code] - b.by_word(np.minimum(b.count, 1)), 0))) for k, b in buckets.items()]
    told = [([b.by_context(t) for t, _, _ in ks], [up for _, up, _ in ks], [float(up.sum()) for _, up, _ in ks] + [float(top[~b.is_split].sum()) for _, _, top in ks]) for b, ks in zip(own, kept, strict=True)]
    return plan, lm.Sweeps(plan, summed(told, own, lm.KEEP, lm.KEEP)), own, kept, counts


def test_sums_to_one(monkeypatch):
    """Predictive probabilities over the vocabulary and the unknown type, in every context, also where words are split."""
    plan, sweeps, buckets, kept, counts = sampled(monkeypatch)
    assert plan.tokens == sum(counts.values()) and plan.vocabulary == len(counts)
    contexts = {int(c) for b in buckets for c in b.code}
    for s in range(lm.KEEP):
        parent, here = {}, {c: {} for c in contexts}
        for b, ks in zip(buckets, kept, strict=True):
            t, up, top = ks[s]
            for w, p in zip(b.word_code.tolist(), sweeps.parent(plan, s, b, up, top, np.ones(b.n, bool)).tolist(), strict=True):
                assert abs(parent.setdefault(w, p) - p) < 1e-12
            for w, c, n, k in zip(b.word_code[b.word].tolist(), b.code[b.context].tolist(), b.count.tolist(), t.tolist(), strict=True):
                here[c][w] = max(n - plan.d * k, 0)
        unknown = (lm.THETA + plan.d_top * sweeps.tops[s]) * plan.unknown / (lm.THETA + sweeps.customers[s])
        assert len(parent) == plan.vocabulary and abs(sum(parent.values()) + unknown - 1) < 1e-9
        for c in contexts:
            seen, all_ = sum(here[c].values()), plan.customers[c]
            assert abs((seen + (lm.THETA + plan.d * sweeps.tables[s][c])) / (lm.THETA + all_) - 1) < 1e-9


def test_sweeps_settle(monkeypatch):
    """Tables seated don't drift after the burn-in: twelve more sweeps change their number by less than three per cent."""
    few, many = (sampled(monkeypatch, n)[1].customers.mean() for n in (lm.BURN_IN, lm.BURN_IN + 12))
    assert abs(few / many - 1) < 0.03


def test_blobs_come_back():
    for arrays in ([], [np.zeros(0, "<u2")], [np.arange(300, dtype="<u4"), np.array([2**63 + 1, 5], "<u8"), np.zeros(0, "<u8")]):
        back = lm.unpacked(lm.packed(*arrays))
        assert len(back) == len(arrays) and all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, back, strict=True))


def test_perplexity(spark):
    docs = spark.createDataFrame([(i, "a b c d " * 5) for i in range(60)], "doc_id long, text string")
    got = lm.score_texts(spark, docs)
    rows = {r.held_out: r for r in lm.perplexity(got).collect()}
    own = [r for r in got.collect() if r.held_out]
    assert abs(rows[True].perplexity - 10 ** (-sum(r.score for r in own) / sum(r.n_tokens for r in own))) < 1e-6
    assert 1 < rows[True].perplexity < rows[True].base_perplexity
    assert docs.where(fold("doc_id", 10) == 0).count() == rows[True].texts
