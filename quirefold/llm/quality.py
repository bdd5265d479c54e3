"""Quality by positive-unlabelled learning.

Trusted positives (labelled good) are set against unlabelled web text.  The class
prior, the share of good texts among the unlabelled, is estimated from the two
alone: a first scorer separates them, and the smallest ratio of their upper tails
bounds the prior (best-bin estimation); the unlabelled tails are counted over all
texts.  A small network is then fitted by minimising the non-negative unbiased risk
    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]).

Its inputs are the text's shape and its wording: every word and every run of four
bytes has a log ratio of how often positives and unlabelled texts have it (hashed to
``BINS``), learnt on each half of the texts, and a text sees the means of what was
learnt on the half that it (and every copy of it) is not in.

At most about ``TRAIN_ROWS`` labelled positives, drawn by a hash, are fitted on.  The
unlabelled side is all texts: they are counted for the log ratios, their tails for the
prior, and the risk is minimised over all of them: a start is found on ``TRAIN_ROWS``
of them, then ``STEPS`` steps follow the gradient of the risk of every text, summed by
the tasks, and the network with the least such risk is kept.  Every text is measured
once, whole, and what is measured is written for prior, risk and score.

Defined results: a null text is empty; an empty text has all features zero and
gets the model's score for that; without positives or unlabelled rows every text
scores 0; several labels of one doc_id count as good only if all of them are;
repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fold, table, text_slices, thinned

#: Labelled positives used for fitting, at most, and unlabelled rows on which a start is found.
TRAIN_ROWS = 12_000
#: Steps along the gradient of the risk over all unlabelled texts.
STEPS = 8
FOLDS, HELD = 4, 2
THRESHOLD = 0.7
HIDDEN = 24
#: Half of the bins are for words, half for runs of bytes; log ratios stay within CLIP.
BINS = 1 << 16
CLIP = 2.0
CACHE_WORDS = 200_000
MARKS = ["|", "!", "%", "*", "$", "&", "#", "@", "=", "_", "<", ">", "{", "}", "[", "]", "/", "\\", "~", "^", "+"]
NAMES = [
    "log_words", "unique_words", "repeated_next", "longest_run", "mean_length", "sd_length", "upper_words", "title_words", "no_letter_words", "marked_words",
    "digits", "pipes", "exclamations", "symbols", "ends_of_sentences", "commas", "lines", "repeated_lines", "short_lines", "unique_pairs", "top_word", "capital_letters", "long_words", "list_lines",
    "word_ratio", "byte_ratio", "unlikely_words",
]


class Bins(dict):
    """The bin of each lower-cased word."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = b = xxhash.xxh32_intdigest(word) % (BINS // 2)
        return b


def bins_of(text: str, bins: Bins) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all words and of all runs of four bytes of a whole text."""
    low = text.lower()
    words = np.fromiter(map(bins.__getitem__, low.split()), np.int64)
    b = np.frombuffer(low.encode(), np.uint8).astype(np.uint32)
    if len(b) < 4:
        return words, np.zeros(0, np.int64)
    run = b[:-3] * np.uint32(0x9E3779B1) + b[1:-2] * np.uint32(0x85EBCA77) + b[2:-1] * np.uint32(0xC2B2AE3D) + b[3:] * np.uint32(0x27D4EB2F)
    run = (run ^ run >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    return words, (run >> np.uint32(17)).astype(np.int64) % (BINS // 2) + BINS // 2


def features_of(text: str, ratios: np.ndarray, bins: Bins) -> list[float]:
    """Features of a whole text, in the order of NAMES; zeros for one without words."""
    shape = shape_of(text)
    words, runs = bins_of(text, bins) if text.strip() else ((), ())
    if not len(words):
        return [*shape, 0.0, 0.0, 0.0]
    own = ratios[words]
    return [*shape, float(own.mean()), float(ratios[runs].mean()) if len(runs) else 0.0, float((own < -1).mean())]


def shape_of(text: str) -> list[float]:
    """What a text looks like; zeros for one without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * (len(NAMES) - 3)
    chars = len(text)
    lengths = np.fromiter(map(len, words), np.int64, n)
    same = np.fromiter(map(str.__eq__, words[1:], words), bool, n - 1) if n > 1 else np.zeros(0, bool)
    runs = np.flatnonzero(np.r_[True, ~same, True])
    distinct = set(words)
    pairs = len(set(zip(words, words[1:], strict=False))) / (n - 1) if n > 1 else 1.0
    counts = {w: 0 for w in distinct}
    for w in words:
        counts[w] += 1
    lines = [x for x in text.split("\n") if x]
    nl = max(1, len(lines))
    letters = list(map(str.isalpha, (w.rstrip(".,;:") for w in words)))
    upper = sum(map(str.isupper, words))
    symbols = sum(text.count(c) for c in MARKS)
    return [
        float(np.log1p(n)), len(distinct) / n, float(same.mean()) if n > 1 else 0.0, float(np.log1p(np.diff(runs).max() - 1)), float(min(lengths.mean(), 40)) / 10, float(min(lengths.std(), 40)) / 10,
        upper / n, sum(map(str.istitle, words)) / n, sum(1 for w in words if not any(map(str.isalpha, w))) / n if symbols else 0.0, 1 - sum(letters) / n,
        sum(text.count(c) for c in "0123456789") / chars, text.count("|") / n, text.count("!") / n, symbols / n, text.count(".") / n, text.count(",") / n,
        float(np.log1p(nl)), 1 - len(set(lines)) / nl, sum(len(x) < 30 for x in lines) / nl, pairs, max(counts.values()) / n if n > 20 else 0.0, upper / max(1, n - upper + 1), float((lengths > 20).mean()), sum("|" in x for x in lines) / nl,
    ]


class QualityModel:
    """``begin`` separates the sides, ``finish`` fits the network once the prior is known."""

    def __init__(self, ratios: np.ndarray) -> None:
        self.ratios, self.prior, self.usable = ratios, 0.0, False

    def begin(self, positive: np.ndarray, unlabelled: np.ndarray, *, steps: int = 750, seed: int = 7) -> np.ndarray:
        """Logits of positives that the first scorer hasn't seen."""
        self.usable = True
        both = np.concatenate([positive, unlabelled])
        self.mean, self.scale = both.mean(0), both.std(0) + 1e-3
        p, u = self._norm(positive), self._norm(unlabelled)
        half = np.arange(len(p)) % 2 == 0
        self.first = self._fit(p[half], u, None, steps, seed)
        return self._logit(self.first, p[~half] if len(p) > 1 else p)

    def finish(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, steps: int = 1500, seed: int = 7) -> None:
        self.prior = prior
        self.net = self._fit(self._norm(positive), self._norm(unlabelled), prior, steps, seed)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Rows, the sum of loss(-) over them and the sums of its gradient, flat."""
        w1, b1, w2, b2 = self.net
        x = self._norm(x)
        h = np.tanh(x @ w1 + b1)
        z = np.clip(h @ w2 + b2, -30, 30)
        s = 1 / (1 + np.exp(-z))
        dh = np.outer(s, w2) * (1 - h * h)
        return np.concatenate([[len(x), np.log1p(np.exp(z)).sum()], (x.T @ dh).ravel(), dh.sum(0), h.T @ s, [s.sum()]])

    def risk(self, positive: np.ndarray, unlabelled: np.ndarray) -> tuple[float, np.ndarray]:
        """The non-negative risk and its gradient, flat; ``unlabelled``: ``sums`` of all unlabelled texts."""
        w1, b1, w2, b2 = self.net
        x = self._norm(positive)
        h = np.tanh(x @ w1 + b1)
        z = np.clip(h @ w2 + b2, -30, 30)
        own = self.sums(positive)[1:] / len(x)
        rest = unlabelled[1:] / unlabelled[0] - self.prior * own
        # loss(+) is loss(-) less the logit
        g = np.full(len(x), 1 / len(x))
        dh = np.outer(g, w2) * (1 - h * h)
        logit = np.concatenate([[z.mean()], (x.T @ dh).ravel(), dh.sum(0), h.T @ g, [1.0]])
        both = self.prior * (own - logit)
        # below zero the part of the negatives is stepped back from, alone
        return float(both[0] + max(0.0, rest[0])), both[1:] + rest[1:] if rest[0] >= 0 else -rest[1:]

    def refine(self, positive: np.ndarray, total, *, steps: int = STEPS, rate: float = 0.003) -> list[float]:
        """Steps along the gradient over all unlabelled texts (``total()`` sums them for the net as it is); keeps the net of least risk, returns the risks."""
        best, kept, risks = np.inf, self.net, []
        m1 = m2 = 0.0
        for t in range(1, steps + 2):
            risk, g = self.risk(positive, total())
            risks.append(risk)
            if risk < best:
                best, kept = risk, self.net
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
            step = rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
            ends = np.cumsum([np.size(v) for v in self.net])[:-1]
            self.net = tuple(v - d.reshape(np.shape(v)) for v, d in zip(self.net, np.split(step, ends), strict=True))
        self.net = kept
        return risks

    def first_logit(self, x: np.ndarray) -> np.ndarray:
        return self._logit(self.first, self._norm(x))

    def _norm(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    @staticmethod
    def _logit(net: tuple, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = net
        return np.tanh(x @ w1 + b1) @ w2 + b2

    @staticmethod
    def _fit(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int, seed: int, ridge: float = 1e-4) -> tuple:
        """Logistic loss; without a prior plain P against U, with one the non-negative risk."""
        rng = np.random.default_rng(seed)
        d = p.shape[1]
        net = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
        m1, m2 = [np.zeros_like(x) for x in net], [np.zeros_like(x) for x in net]
        for t in range(1, steps + 1):
            xp, xu = p[rng.integers(0, len(p), min(512, len(p)))], u[rng.integers(0, len(u), min(512, len(u)))]
            x = np.concatenate([xp, xu])
            h = np.tanh(x @ net[0] + net[1])
            z = h @ net[2] + net[3]
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            k = len(xp)
            if prior is None:
                g = np.concatenate([(s[:k] - 1) / k, s[k:] / len(xu)])
            else:
                negative = np.log1p(np.exp(np.clip(z, -30, 30)))
                rest = negative[k:].mean() - prior * negative[:k].mean()
                g = np.concatenate([prior * (s[:k] - 1) / k - prior * s[:k] / k, s[k:] / len(xu)])
                if rest < 0:  # step back from the overfitted part alone
                    g = np.concatenate([prior * s[:k] / k, -s[k:] / len(xu)])
            dh = np.outer(g, net[2]) * (1 - h * h)
            grads = [x.T @ dh + ridge * net[0], dh.sum(0), h.T @ g + ridge * net[2], np.asarray(g.sum())]
            rate = 0.01 * (1 - t / (steps + 1))
            for i, gr in enumerate(grads):
                m1[i], m2[i] = 0.9 * m1[i] + 0.1 * gr, 0.999 * m2[i] + 0.001 * gr * gr
                net[i] = net[i] - rate * (m1[i] / (1 - 0.9**t)) / (np.sqrt(m2[i] / (1 - 0.999**t)) + 1e-8)
        return tuple(net)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.usable:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(self._logit(self.net, self._norm(x)), -30, 30)))


def best_bin_prior(p: np.ndarray, cuts: np.ndarray, counts: np.ndarray, *, delta: float = 0.1) -> float:
    """The least ratio of upper tails of U and P, over tails that are large enough to tell; ``counts``: unlabelled rows with k cuts at or below them."""
    n = max(1, int(counts.sum()))
    tail = counts[::-1].cumsum()[::-1][1:] / n
    slack = np.sqrt(np.log(4 / delta) / (2 * n)) + np.sqrt(np.log(4 / delta) / (2 * len(p)))
    tails = [(u, (p >= c).mean()) for u, c in zip(tail, cuts, strict=True)]
    best = min(tails, key=lambda t: (t[0] + slack) / max(t[1], 1e-9))
    return float(np.clip(best[0] / max(best[1], 1e-9), 0.01, 0.99))


def good_labels(labels: DataFrame) -> DataFrame:
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return marks.where("quality = 1").select("doc_id")


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, __h): rows with the hash that samples are drawn by; its lowest bit tells the halves."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("__h"))


def positives(rows: DataFrame, marks: DataFrame, most: int) -> DataFrame:
    """All rows, with ``pos`` for those among about ``most`` positives."""
    # the thinned labels are bounded by ``most``, so they can be broadcast
    pos = F.broadcast(thinned(marks, most, "doc_id").select(F.col("doc_id").alias("__pos")))
    return rows.join(pos, F.col("doc_id") == F.col("__pos"), "left").withColumn("pos", F.col("__pos").isNotNull()).drop("__pos")


def drawn(rows: DataFrame, marks: DataFrame, most: int) -> DataFrame:
    """rows that are among about ``most`` positives (``pos``) or about ``most`` of all (``any``)."""
    share = min(1.0, 1.25 * most / max(1, rows.count()))
    return positives(rows, marks, most).withColumn("any", F.abs(F.xxhash64("__h", F.lit(5)) / 2.0**63) <= share).where("pos or any")


def sums_of(rows: DataFrame, model: QualityModel) -> np.ndarray:
    """``model.sums`` over the features ``x`` of all rows; each task passes on one sum a weight."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for b in batches:
            if b.num_rows:
                total = total + sent.value.sums(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64))
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "s"])

    found = rows.select("x").mapInArrow(run, "k long, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()  # a row for each weight
    sent.unpersist()
    out = np.zeros(2 + sum(np.size(v) for v in model.net))
    for r in found:
        out[r["k"]] = r["s"]
    return out


def log_ratios(docs: DataFrame, marks: DataFrame, *, rows: int = TRAIN_ROWS) -> np.ndarray:
    """The log ratio of each bin between about ``rows`` positives and all texts, for each half of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, counts = Bins(), np.zeros((2, 2 * BINS), np.int64)
        for batch in batches:
            pos, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for start, texts in text_slices(batch, limit=1_000_000):
                for i, t in enumerate(texts, start):
                    half = counts[:, BINS * int(hashes[i] & 1) :][:, :BINS]
                    for own in bins_of(t, bins):
                        np.add.at(half[1], own, 1)
                        if pos[i]:
                            np.add.at(half[0], own, 1)
        # a task passes on its sums, whatever it read
        at = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0, at]), pa.array(counts[1, at])], ["bin", "p", "u"])

    found = positives(hashed(docs.where("text is not null")), marks, rows).select("text", "pos", "__h").mapInArrow(run, "bin long, p long, u long")
    sums = found.groupBy("bin").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).collect()  # 2 x BINS rows at most
    p, u = np.zeros(2 * BINS), np.zeros(2 * BINS)
    for r in sums:
        p[r["bin"]], u[r["bin"]] = r["p"], r["u"]
    out = np.zeros(2 * BINS, np.float32)
    for lo in range(0, 2 * BINS, BINS // 2):
        part = slice(lo, lo + BINS // 2)
        if p[part].sum() and u[part].sum():
            out[part] = np.clip(np.log((p[part] + 1) / (p[part].sum() + BINS / 2)) - np.log((u[part] + 1) / (u[part].sum() + BINS / 2)), -CLIP, CLIP)
    return out.reshape(2, BINS)[::-1]


def measured(spark: SparkSession, docs: DataFrame, ratios: np.ndarray, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs and the features ``x`` of each whole text; ``ratios``: those for texts of either half."""
    sent = spark.sparkContext.broadcast(ratios)
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("__text"), F.xxhash64("text").bitwiseAND(1).cast("int").alias("__half"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in picked.schema[: len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins()
        for batch in batches:
            for start, texts in text_slices(batch, "__text"):
                half = batch.column(len(keep) + 1).slice(start, len(texts)).to_pylist()
                x = pa.array([features_of(t, sent.value[k], bins) for t, k in zip(texts, half, strict=True)], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(start, len(texts)) for k in range(len(keep))), x], [*keep, "x"])

    return picked.mapInArrow(run, f"{fields}x array<float>")


def fit(spark: SparkSession, rows: DataFrame, marks: DataFrame, ratios: np.ndarray, *, most: int = TRAIN_ROWS) -> QualityModel:
    """Fits on at most ``most`` positives and all of ``rows`` (doc_id, __h, x); a start is found on ``most`` of these."""
    sample = drawn(rows, marks, most).select("pos", "any", "__h", "x")

    def side(flag: str) -> np.ndarray:
        found = sample.where(flag).select("__h", "x").orderBy("__h", "x").limit(most).collect()
        return np.array(sorted(r["x"] for r in found), np.float64).reshape(-1, len(NAMES))

    model, positive, unlabelled = QualityModel(ratios), side("pos"), side("any")
    if not len(positive) or not len(unlabelled):
        return model
    logits = model.begin(positive, unlabelled)
    cuts = np.unique(np.quantile(logits, np.linspace(0, 0.98, 99)))
    sent = spark.sparkContext.broadcast((model, cuts))

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, edges = sent.value
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                k, n = np.unique(np.searchsorted(edges, first.first_logit(x.astype(np.float64)), "right"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(n)], ["k", "n"])

    counts = np.zeros(len(cuts) + 1)
    for r in rows.select("x").mapInArrow(tails, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[r["k"]] = r["n"]
    model.finish(positive, unlabelled, best_bin_prior(logits, cuts, counts))
    model.refine(positive, lambda: sums_of(rows, model))
    return model


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS) -> QualityModel:
    """A model of docs; all its texts are measured once for the prior and the risk."""
    spark, marks = docs.sparkSession, good_labels(labels)
    ratios = log_ratios(docs, marks, rows=rows)
    texts = hashed(docs.where("text is not null"))
    return fit(spark, cut(spark, measured(spark, texts, ratios, ["doc_id", "__h"]), "quality-features"), marks, ratios, most=rows)


def scored(spark: SparkSession, rows: DataFrame, model: QualityModel) -> DataFrame:
    """``rows`` of ``measured`` with the score in place of the features."""
    sent = spark.sparkContext.broadcast(model)
    names = [c for c in rows.columns if c != "x"]
    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(len(names)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(sent.value.score(x), pa.float64())], [*names, "score"])

    return rows.select(*[F.col(f"`{c}`") for c in names], "x").mapInArrow(run, f"{fields}score double")


def score(spark: SparkSession, docs: DataFrame, model: QualityModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs and the score of each whole text."""
    return scored(spark, measured(spark, docs, model.ratios, keep), model)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``, learnt from positives of three folds of four."""
    docs, marks = table(spark, sf_dir, "documents"), good_labels(table(spark, sf_dir, "labels"))
    learnt = fold("doc_id", FOLDS) != HELD
    ratios = log_ratios(docs.where(learnt), marks)
    rows = cut(spark, measured(spark, hashed(docs).withColumn("__empty", F.col("text").isNull()), ratios, ["doc_id", "__h", "__empty"]), "quality-features")
    model = fit(spark, rows.where(learnt & ~F.col("__empty")), marks, ratios)
    found = scored(spark, rows.select("doc_id", "x"), model)
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
