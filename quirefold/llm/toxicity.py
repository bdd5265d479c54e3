"""Toxicity by a counterfactually regularised linear classifier.

A text is the set of its lower-cased words and their prefixes of four to six
letters, hashed.  Features that speak for toxicity are chosen by a chi-squared
test, then a logistic model with weights of at least zero (a long harmless rest
can't outweigh an insult) is fitted with a penalty on the squared change of the logit when
an identity term of a labelled sentence is swapped for another of its kind, or, in a
sentence without one, when one term of a pair is put in instead of the other: a
mention of a group, by itself, then moves the score little.

``TRAIN_ROWS`` labelled rows, drawn by a hash of the text, bound the training
sample; every text is scored whole.

Defined results: a null text is empty and scores the model's base rate; without
usable labels every text scores 0; several labels of one doc_id count as toxic
if one of them is; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, rows_of, table, text_slices, thinned

#: Labelled rows used for fitting, at most.
TRAIN_ROWS = 12_000
FEATURES = 8_000
#: Least chi-squared value of a feature; chance meetings with toxic rows stay below it.
LEAST_CHI = 15.0
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
#: Strength of the counterfactual penalty against the mean log loss.
SWAP_PENALTY = 1.0
#: Targets that a term is swapped for in one sentence; they rotate over the sentences, so that each is one.
SWAPS_PER_TERM = 2
PREFIXES = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CACHE_WORDS = 100_000
#: Identity terms by kind; a term is swapped within its line.
IDENTITY = [
    ["women", "men", "girls", "boys", "females", "males"],
    ["woman", "man", "girl", "boy", "female", "male"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists", "sikhs"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh"],
    ["black", "white", "asian", "hispanic", "latino", "african", "european", "arab"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual", "queer"],
    ["immigrants", "refugees", "foreigners", "migrants", "citizens", "natives"],
    ["mexican", "chinese", "american", "german", "french", "spanish", "indian", "russian", "turkish", "polish", "moroccan", "tunisian", "algerian", "egyptian"],
    ["mexicans", "americans", "germans", "indians", "russians", "turks", "poles", "moroccans", "tunisians", "algerians", "egyptians"],
    ["deaf", "blind", "disabled", "autistic"],
    ["frauen", "männer", "mädchen", "jungen"],
    ["muslime", "christen", "juden", "hindus"],
    ["femmes", "hommes", "filles", "garçons"],
    ["musulmans", "chrétiens", "juifs", "hindous"],
    ["mujeres", "hombres", "chicas", "chicos"],
    ["musulmanes", "cristianos", "judíos", "hindúes"],
]
SWAP = {term: [x for x in line if x != term] for line in IDENTITY for term in line}


def features_of(word: str) -> list[int]:
    out = [xxhash.xxh32_intdigest(word)]
    out += [xxhash.xxh32_intdigest(word[:k], seed=k) for k in PREFIXES if len(word) >= k]
    return out


def text_features(words: set[str]) -> np.ndarray:
    return np.unique(np.array([f for w in words for f in features_of(w)], np.uint32))


def identity_features() -> np.ndarray:
    """Features of all identity terms, their prefixes too, which they may share with an insult."""
    return text_features(set(SWAP))


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def counterfactuals(words: set[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features gained, features lost) by each counterfactual of a sentence, against the sentence or against its pair.

    One identity term at a time is swapped for others of its kind; a sentence without any
    gets a pair of terms of one kind; which, turns with the sentence's words.
    """
    turn, pairs = xxhash.xxh32_intdigest(" ".join(sorted(words))), []
    for term in sorted(words & SWAP.keys()):
        others = SWAP[term]
        pairs += [((words - {term}) | {others[(turn + k) % len(others)]}, words) for k in range(min(SWAPS_PER_TERM, len(others)))]
    if not pairs:
        line = IDENTITY[turn % len(IDENTITY)]
        at = turn // len(IDENTITY)
        pairs = [(words | {line[(at + 1) % len(line)]}, words | {line[at % len(line)]})]
    out = []
    for a, b in pairs:
        own, other = text_features(a - b), text_features(b - a)
        shared = text_features(a & b)
        new, old = (np.setdiff1d(x, shared) for x in (own, other))
        out.append((np.setdiff1d(new, old), np.setdiff1d(old, new)))
    return out


class Sparse:
    """Rows of feature numbers, flat."""

    def __init__(self, rows: list[np.ndarray]) -> None:
        self.n = len(rows)
        self.col = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows]) if rows else np.zeros(0, np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def back(self, g: np.ndarray, d: int) -> np.ndarray:
        return np.bincount(self.col, weights=g[self.row], minlength=d)


class ToxicityModel:
    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray]], *, penalty: float = SWAP_PENALTY, features: int = FEATURES, steps: int = 400, sparsity: float = 2e-5) -> None:
        self.acting = 0
        self.bias, self.usable = 0.0, bool(len(labels)) and 0 < labels.sum() < len(labels)
        self.names, self.weights = np.zeros(0, np.uint32), np.zeros(0)
        self._fresh()
        if not self.usable:
            return
        self._choose(rows, labels, features)
        x = Sparse([self._known(r) for r in rows])
        known = [(self._known(a), self._known(b)) for a, b in swaps]
        pair_a, pair_b = Sparse([a for a, _ in known]), Sparse([b for _, b in known])
        self.acting = sum(1 for a, b in known if len(a) or len(b))  # pairs that differ in a feature of the model
        self._fit(x, labels.astype(float), pair_a, pair_b, penalty, steps, sparsity)
        self._fresh()

    def _choose(self, rows: list[np.ndarray], labels: np.ndarray, most: int) -> None:
        names, seen = np.unique(np.concatenate(rows), return_counts=True)
        bad, times = np.unique(np.concatenate([r for r, y in zip(rows, labels, strict=True) if y > 0]), return_counts=True)
        hit = np.zeros(len(names))
        hit[np.searchsorted(names, bad)] = times
        rate = labels.mean()
        # chi-squared with one count of doubt, so that a handful of chance meetings isn't enough
        chi = np.maximum(0, hit - seen * rate - 1) ** 2 / (seen * rate * (1 - rate) + 1e-9)
        order = np.argsort(-chi, kind="stable")[:most]
        order = order[chi[order] > LEAST_CHI]
        # what makes up identity terms stays in, whatever its test says: the penalty has to see it
        self.names = np.union1d(names[order], identity_features())

    def _known(self, row: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.names, row)
        at[at == len(self.names)] = 0
        return at[self.names[at] == row] if len(self.names) else at[:0]

    def _fit(self, x: Sparse, y: np.ndarray, a: Sparse, b: Sparse, penalty: float, steps: int, sparsity: float) -> None:
        d, rate = len(self.names), y.mean()
        w, bias = np.zeros(d), float(np.log(rate / (1 - rate)))
        m1, m2 = np.zeros(d + 1), np.zeros(d + 1)
        for t in range(1, steps + 1):
            z = x.dot(w) + bias
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / x.n
            grad = np.r_[x.back(g, d) + sparsity, g.sum()]
            if a.n:
                change = (a.dot(w) - b.dot(w)) * (2 * penalty / a.n)
                grad[:d] += a.back(change, d) - b.back(change, d)
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
            step = 0.1 * (1 - t / (steps + 1)) * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-9)
            w, bias = np.maximum(0, w - step[:d]), bias - step[d]
        self.weights, self.bias = w, float(bias)

    def _fresh(self) -> None:
        self.table = dict(zip(self.names.tolist(), self.weights.tolist(), strict=True)) if len(self.weights) else {}
        self.cache: dict[str, tuple[int, ...]] = {}

    def score(self, texts: list[str]) -> list[float]:
        if not self.usable:
            return [0.0] * len(texts)
        out, known, cache = [], self.table, self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for text in texts:
            hits: set[int] = set()
            for w in words_of(text):
                f = cache.get(w)
                if f is None:
                    f = cache[w] = tuple(i for i in features_of(w) if i in known)
                if f:
                    hits.update(f)
            z = self.bias + sum(known[i] for i in sorted(hits))
            out.append(float(1 / (1 + np.exp(-min(30.0, max(-30.0, z))))))
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "cache")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._fresh()


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, penalty: float = SWAP_PENALTY) -> ToxicityModel:
    """Fits on at most ``rows`` labelled rows; features are made on the executors from whole texts."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the thinned labels are bounded by ``rows``, so they can be broadcast
    drawn = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(thinned(marks, rows, "doc_id")), "doc_id").select("text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch):
                sets = [words_of(t) for t in texts]
                own = [text_features(s).tobytes() for s in sets]
                pairs = [[x.tobytes() for pair in counterfactuals(s) for x in pair] for s in sets]
                yield pa.RecordBatch.from_arrays([rows_of(batch, start, len(texts), "toxic").cast(pa.int32()), pa.array(own, pa.binary()), pa.array(pairs, pa.list_(pa.binary()))], ["toxic", "x", "pairs"])

    made = drawn.mapInArrow(run, "toxic int, x binary, pairs array<binary>").orderBy(F.xxhash64("x"), "x", "toxic").limit(rows)
    found = sorted((bytes(r["x"]), r["toxic"], [bytes(s) for s in r["pairs"]]) for r in made.collect())
    as_row = lambda b: np.frombuffer(b, np.uint32)
    swaps = [(as_row(a), as_row(b)) for *_, ss in found for a, b in zip(ss[::2], ss[1::2], strict=True)]
    return ToxicityModel([as_row(x) for x, _, _ in found], np.array([t > 0 for _, t, _ in found], float), swaps, penalty=penalty)


def score(spark: SparkSession, docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs and the score of each whole text."""
    sent = spark.sparkContext.broadcast(model)
    text = "text" if "text" in keep else "__text"
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], *([F.col("text").alias(text)] if text not in keep else []))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[: len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch, text):
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(start, len(texts)) for k in range(len(keep))), pa.array(sent.value.score(texts), pa.float64())], [*keep, "score"])
        sent.value.cache.clear()  # a worker lives on, with other operators

    return picked.mapInArrow(run, f"{fields}, score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``, learnt from labels of three folds of four."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs.where(fold("doc_id", FOLDS) != HELD), labels)
    found = score(spark, docs, model, ["doc_id"])
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
