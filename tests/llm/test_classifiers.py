"""The three classifiers' scores against slow versions of the same formulas, and their fits against the conditions of an optimum."""

import math
import random

import numpy as np
import pytest
import xxhash

from quirefold.llm import langid, quality, toxicity

from .test_llm import EDGE, corpus

TEXTS = [t or "" for t in EDGE] + [d[1] for d in corpus(40)[0]]


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


# --- toxicity ---


def plain_features(text):
    out = set()
    for w in set(toxicity.WORD.findall(text.lower())):
        out.add(xxhash.xxh32_intdigest(w))
        out |= {xxhash.xxh32_intdigest(w[:k], seed=k) for k in (4, 5, 6) if len(w) >= k}
    return out


@pytest.fixture(scope="module")
def toxic_model():
    docs, labels = corpus(600)
    sets = [toxicity.words_of(t) for _, t, *_ in docs]
    swaps = [p for s in sets for p in toxicity.counterfactuals(s)]
    rows, y = [toxicity.text_features(s) for s in sets], np.array([float(t) for *_, t in labels])
    return toxicity.ToxicityModel(rows, y, swaps), rows, y, swaps


def test_toxicity_score_equals_plain(toxic_model):
    model = toxic_model[0]
    weights = dict(zip(model.names.tolist(), model.weights.tolist(), strict=True))
    for text, got in zip(TEXTS, model.score(TEXTS), strict=True):
        assert abs(got - sigmoid(model.bias + sum(weights.get(f, 0.0) for f in plain_features(text)))) < 1e-9


def test_toxicity_fit_is_an_optimum(toxic_model):
    """No weight can move, nor fall below zero, to lessen loss plus sparsity plus penalty by a first-order amount."""
    model, rows, y, swaps = toxic_model
    place = {f: i for i, f in enumerate(model.names.tolist())}
    grad, bias = np.full(len(place), 2e-5), 0.0
    for r, t in zip(rows, y, strict=True):
        own = [place[f] for f in r.tolist() if f in place]
        g = (sigmoid(model.bias + model.weights[own].sum()) - t) / len(rows)
        grad[own] += g
        bias += g
    for plus, minus in swaps:
        a, b = ([place[f] for f in x.tolist() if f in place] for x in (plus, minus))
        change = 2 * toxicity.SWAP_PENALTY / len(swaps) * (model.weights[a].sum() - model.weights[b].sum())
        grad[a] += change
        grad[b] -= change
    assert abs(bias) < 2e-3 and (grad > -2e-3).all() and (np.abs(grad[model.weights > 0.05]) < 2e-3).all()


def test_toxicity_counterfactuals_reach_every_term():
    """Swaps for a term present, inserted pairs otherwise; over many rows every term of a line is a target."""
    seen = set()
    for k in range(200):
        pairs = toxicity.counterfactuals({"women", *(f"w{i}" for i in range(k))})
        assert len(pairs) == toxicity.SWAPS_PER_TERM
        seen |= {f for plus, _ in pairs for f in plus.tolist()}
    assert all(xxhash.xxh32_intdigest(t) in seen for t in toxicity.SWAP["women"])
    inserted = toxicity.counterfactuals({"plain", "words"})
    assert len(inserted) == 1 and all(len(x) for x in inserted[0])


# --- language ---


def plain_grams(text):
    b, out = b" " + text.lower().encode() + b" ", []
    for i in range(len(b)):
        for n, mix in ((2, 1), (3, 0x165667B1), (4, 0x2C1B3C6D)):
            if i + n <= len(b):
                h = sum(x * c for x, c in zip(b[i : i + n], (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F), strict=False)) * mix & 0xFFFFFFFF
                h = (h ^ h >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
                out.append(h >> 32 - langid.BITS)
    return out


@pytest.fixture(scope="module")
def spoken():
    docs = corpus(240)[0]
    x = np.stack([langid.vector(t) for _, t, *_ in docs])
    return langid.LanguageModel(x, [d[2] for d in docs], [len(d[1]) for d in docs]), x, [d[2] for d in docs]


def test_language_prediction_equals_plain(spoken):
    model = spoken[0]
    for text, name in zip(TEXTS, model.predict(TEXTS)[0], strict=True):
        if len(text) > 2000:
            continue
        if not any(c.isalpha() for c in text):
            assert name == "und"
            continue
        g = plain_grams(text)
        margin = [sum(float(model.weights[i, k]) for i in g) / len(g) + model.bias[k] for k in range(model.weights.shape[1])]
        nf = len(model.families)
        best = model.families[max(range(nf), key=lambda k: margin[k])]
        names = [x for x in model.langs if langid.family(x) == best]
        votes = dict.fromkeys(names, 0)
        for k, (a, b) in enumerate(model.pairs, nf):
            if a in votes:
                votes[a if margin[k] > 0 else b] += 1
        assert votes[name] == max(votes.values())


def test_language_numerals_are_no_letters(spoken):
    texts = ["½ ②", "³ Ⅷ 12", "٣ ४", "_ -", "x½", "ª", "中", "Ж"]
    assert [n == "und" for n in spoken[0].predict(texts)[0]] == [True, True, True, True, False, False, False, False]


def test_svm_is_an_optimum(spoken):
    _, x, langs = spoken
    y = np.where(np.array(langs) == "en", 1.0, -1.0).astype(np.float32)
    w, b = langid.svm(x, y, steps=2000)
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    short = np.maximum(0, 1 - y * (x @ w + b))
    grad = w - 20 * x.T @ (weight * y * short)
    assert np.linalg.norm(grad) < 0.02 * max(1.0, np.linalg.norm(w))


def test_likeness_tells_other_scripts(spoken):
    """Words of the learned languages are alike; long texts of other scripts or random letters aren't."""
    rng = random.Random(3)
    docs = [d for d in corpus(400)[0] if len(set(d[1].split())) > 4]
    model = langid.LanguageModel(np.stack([langid.vector(d[1]) for d in docs]), [d[2] for d in docs], [len(d[1]) for d in docs])
    known = [d[1] for d in docs[:80] if len(d[1]) >= langid.LEAST_CHARS]
    assert known and min(model.likeness(known)) >= model.floor > 0
    other = ["Все люди рождаются свободными и равными в своем достоинстве и правах. " * 4, "人人生而自由,在尊严和权利上一律平等。" * 12, "".join(rng.choices("0123456789qxzjkvw", k=600))]
    assert max(model.likeness(other)) < model.floor
    assert model.likeness(["短", ""]) == [1.0, 1.0]


# --- quality ---


def plain_ratio_features(text, ratios):
    """Mean log ratios of words and of runs of four bytes, byte by byte."""
    low = text.lower()
    words = [xxhash.xxh32_intdigest(w) % (quality.BINS // 2) for w in low.split()]
    if not words:
        return [0.0, 0.0, 0.0]
    b, runs = low.encode(), []
    for i in range(len(b) - 3):
        h = sum(x * c for x, c in zip(b[i : i + 4], (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F), strict=True)) & 0xFFFFFFFF
        h = (h ^ h >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
        runs.append(quality.BINS // 2 + (h >> 17) % (quality.BINS // 2))
    mean = lambda at: sum(float(ratios[i]) for i in at) / len(at) if at else 0.0
    return [mean(words), mean(runs), sum(ratios[i] < -1 for i in words) / len(words)]


def test_quality_features_and_score_equal_plain():
    rng = np.random.default_rng(4)
    ratios = rng.normal(0, 1, quality.BINS).astype(np.float32)
    texts = [t for t in TEXTS if len(t) < 2000]
    x = np.array([quality.features_of(t, ratios, quality.Bins()) for t in texts])
    for t, row in zip(texts, x, strict=True):
        assert np.allclose(row[-3:], plain_ratio_features(t, ratios), atol=1e-5), t
    model = quality.QualityModel(np.stack([ratios, ratios]))
    model.begin(x[::2], x[1::2], steps=20)
    model.finish(x[::2], x[1::2], 0.5, steps=20)
    w1, b1, w2, b2 = model.net
    for row, got in zip(x, model.score(x), strict=True):
        z = [max(-6.0, min(6.0, (v - m) / s)) for v, m, s in zip(row, model.mean, model.scale, strict=True)]
        hidden = [math.tanh(sum(z[i] * w1[i, j] for i in range(len(z))) + b1[j]) for j in range(w1.shape[1])]
        assert abs(got - sigmoid(sum(h * w for h, w in zip(hidden, w2, strict=True)) + float(b2))) < 1e-9


def plain_shape(text):
    """The shape's features by their names, one at a time."""
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n = len(words)
    if not n:
        return dict.fromkeys(quality.NAMES[:-3], 0.0)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    next_same = [words[i] == words[i + 1] for i in range(n - 1)]
    longest = run = 1
    for same in next_same:
        run = run + 1 if same else 1
        longest = max(longest, run)
    has_letter = [any(c.isalpha() for c in w) for w in words]
    symbols = sum(c in quality.MARKS for c in text)
    upper = sum(w.isupper() for w in words)
    nl = max(1, len(lines))
    return {
        "log_words": math.log(1 + n),
        "unique_words": len(set(words)) / n,
        "repeated_next": sum(next_same) / (n - 1) if n > 1 else 0,
        "longest_run": math.log(longest),
        "mean_length": min(mean, 40) / 10,
        "sd_length": min(math.sqrt(sum((x - mean) ** 2 for x in lengths) / n), 40) / 10,
        "upper_words": upper / n,
        "title_words": sum(w.istitle() for w in words) / n,
        "no_letter_words": has_letter.count(False) / n if symbols else 0,
        "marked_words": sum(not w.rstrip(".,;:").isalpha() for w in words) / n,
        "digits": sum(c in "0123456789" for c in text) / len(text),
        "pipes": sum(c == "|" for c in text) / n,
        "exclamations": sum(c == "!" for c in text) / n,
        "symbols": symbols / n,
        "ends_of_sentences": sum(c == "." for c in text) / n,
        "commas": sum(c == "," for c in text) / n,
        "lines": math.log(1 + nl),
        "repeated_lines": 1 - len(set(lines)) / nl,
        "short_lines": sum(len(x) < 30 for x in lines) / nl,
        "unique_pairs": len({(words[i], words[i + 1]) for i in range(n - 1)}) / (n - 1) if n > 1 else 1,
        "top_word": max(words.count(w) for w in set(words)) / n if n > 20 else 0,
        "capital_letters": upper / max(1, n - upper + 1),
        "long_words": sum(x > 20 for x in lengths) / n,
        "list_lines": sum("|" in x for x in lines) / nl,
    }


def test_quality_shape_equals_plain():
    texts = [t for t in TEXTS if len(t) < 2000] + ["A a a A|b\n| 12, 13!\n\nSHOUT SHOUT ok.\nSHOUT SHOUT ok.", "x" * 50 + " Y", "  \n ", "one", "to to to " * 9]
    for t in texts:
        want = plain_shape(t)
        assert list(want) == quality.NAMES[:-3]
        for name, got in zip(want, quality.shape_of(t), strict=True):
            assert abs(got - want[name]) < 1e-9, (name, t)


def test_log_ratios_count_every_text(spark):
    """All texts are the unlabelled side, however few rows may be fitted on."""
    docs, labels = corpus(60)
    rows = [(i, t) for i, t, *_ in docs] + [(None, None), (10**9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(docs[k][0],) for k in range(0, 60, 3)], "doc_id long")
    good = {docs[k][0] for k in range(0, 60, 3)}
    hashes = {r["doc_id"]: r["__h"] & 1 for r in quality.hashed(df).select("doc_id", "__h").collect()}
    counts = np.zeros((2, 2, quality.BINS))
    for i, t in rows:
        for own in quality.bins_of(t, quality.Bins()) if t else ():
            for b in own.tolist():
                counts[hashes[i], 1, b] += 1
                counts[hashes[i], 0, b] += i in good
    got = quality.log_ratios(df.repartition(5), marks, rows=1000)
    half = quality.BINS // 2
    for k in (0, 1):
        for lo in (0, half):
            p, u = counts[k, :, lo : lo + half]
            want = np.clip(np.log((p + 1) / (p.sum() + half)) - np.log((u + 1) / (u.sum() + half)), -quality.CLIP, quality.CLIP)
            assert np.allclose(got[1 - k][lo : lo + half], want, atol=1e-5)
    few = quality.log_ratios(df, marks, rows=3)
    assert (few < 0).any() and few.shape == got.shape


def small_model(rng, prior):
    x = rng.normal(0, 1, (200, len(quality.NAMES)))
    p, u = x[:60] + 0.7, np.concatenate([x[60:], x[:30] + 0.7])
    model = quality.QualityModel(np.zeros((2, quality.BINS), np.float32))
    model.begin(p, u, steps=30)
    model.finish(p, u, prior, steps=30)
    return model, p, u


@pytest.mark.parametrize("prior", [0.3, 0.99])
def test_risk_and_gradient_equal_plain(prior):
    rng = np.random.default_rng(9)
    model, p, u = small_model(rng, prior)

    def parts():
        zp, zu = model._logit(model.net, model._norm(p)), model._logit(model.net, model._norm(u))
        rest = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
        return prior * np.log1p(np.exp(-zp)).mean(), rest

    plus, rest = parts()
    risk, g = model.risk(p, model.sums(u))
    assert abs(risk - plus - max(0, rest)) < 1e-9
    net, at = model.net, 0
    for k, v in enumerate(net):
        for j in range(0, np.size(v), 37):
            values = []
            for d in (1e-5, -1e-5):
                moved = np.array(v, float)
                moved.flat[j] += d
                model.net = (*net[:k], moved, *net[k + 1 :])
                a, b = parts()
                values.append(a + b if rest >= 0 else -b)
            assert abs((values[0] - values[1]) / 2e-5 - g[at + j]) < 1e-5
        at += np.size(v)
    model.net = net


def test_refined_over_all_rows(spark):
    """Sums of tasks are the sums of all rows, in any number of tasks, and the net kept has the least risk over all of them."""
    rng = np.random.default_rng(10)
    model, p, u = small_model(rng, 0.4)
    df = spark.createDataFrame([(r.tolist(),) for r in u], "x array<float>")
    for n in (1, 7):
        assert np.allclose(quality.sums_of(df.repartition(n), model), model.sums(u.astype(np.float32).astype(float)), atol=1e-6)
    assert not quality.sums_of(df.where("false"), model).any()
    risks = model.refine(p, lambda: model.sums(u), steps=30)
    assert abs(model.risk(p, model.sums(u))[0] - min(risks)) < 1e-12 and min(risks) < risks[0]


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.9])
def test_prior_of_a_known_mixture(prior):
    """Well-separated sides: the least ratio of tails is the share of positives."""
    rng = np.random.default_rng(6)
    p = rng.normal(2, 1, 4000)
    u = np.where(rng.random(40_000) < prior, rng.normal(2, 1, 40_000), rng.normal(-2, 1, 40_000))
    cuts = np.unique(np.quantile(p, np.linspace(0, 0.98, 99)))
    counts = np.bincount(np.searchsorted(cuts, u, "right"), minlength=len(cuts) + 1)
    assert abs(quality.best_bin_prior(p, cuts, counts) - prior) < 0.05


def test_risk_that_would_fall_below_zero_is_stepped_back():
    """Positives alone as unlabelled texts: the unbiased risk of negatives goes below zero, the fit must not run away."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (300, len(quality.NAMES)))
    model = quality.QualityModel(np.zeros((2, quality.BINS), np.float32))
    model.begin(x, x, steps=50)
    model.finish(x, x, 0.95, steps=400)
    s = model.score(x)
    assert (s > 0.5).mean() > 0.9 and np.isfinite(s).all()
