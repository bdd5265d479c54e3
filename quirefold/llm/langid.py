"""Language identification by hierarchical discrimination.

A linear one-versus-rest stage on hashed byte n-grams first predicts the language
family; one-versus-one linear support vector machines then separate the
languages within that family by votes, ties by summed margins.  Margins are
turned into probabilities by a logistic fit on the training rows.  Beside that,
``likeness`` tells how much a text is like any learned language at all: the cosine
of its square-rooted n-gram counts with the nearest language's mean; the model's
``floor`` lies well below that of its own training texts.

``TRAIN_PER_LANG`` distinct texts of each language, drawn by a hash of the text, and
``TRAIN_ROWS`` of all languages together bound the training sample; every text is
scored whole.  A letter is what Unicode calls one (category L), so digits of any
script, fractions and numerals are none.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
without training rows every text is; repeated rows get equal results; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fold, rows_of, table, text_slices

#: Training rows taken per language, and of all languages together, at most.
TRAIN_PER_LANG, TRAIN_ROWS = 800, 16_000
BITS = 12
DIM = 1 << BITS
FOLDS = 5
#: Families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi", "fy"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "semitic": ["ar", "he", "mt"],
    "indo-aryan": ["hi", "ur", "bn", "mr", "ne", "pa", "gu"],
}
#: Characters from which on likeness is judged; shorter texts count as alike.
LEAST_CHARS = 150
#: Share of training texts, and of their likeness there, below which a text is unlike all languages.
FLOOR_SHARE, FLOOR = 0.02, 0.5
#: Characters of texts whose n-grams are held at a time.
SLICE_CHARS = 1_000_000
LETTER = regex.compile(r"\p{L}")


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def grams(text: str) -> np.ndarray:
    """Feature numbers of all byte pairs, triples and quadruples of a lower-cased text between spaces."""
    b = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] + b[2:] * np.uint32(0xC2B2AE3D)
    four = three[:-1] + b[3:] * np.uint32(0x27D4EB2F)
    out = np.concatenate([two, three * np.uint32(0x165667B1), four * np.uint32(0x2C1B3C6D)])
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    return out >> np.uint32(32 - BITS)


def vector(text: str) -> np.ndarray:
    counts = np.bincount(grams(text), minlength=DIM).astype(np.float32)
    return counts * np.float32(64.0 / counts.sum())


def svm(x: np.ndarray, y: np.ndarray, *, cost: float = 10.0, steps: int = 120) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by accelerated gradient steps; y is 1 or -1."""
    n = len(y)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    vw, vb = w, b
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):  # the largest curvature, by power iteration
        u = x.T @ (weight * (x @ v))
        size = float(np.linalg.norm(u)) or 1.0
        v = u / size
    rate = np.float32(1.0 / (1.0 + 2 * cost * (size + 1)))
    for t in range(steps):
        short = np.maximum(0, 1 - y * (x @ vw + vb)).astype(np.float32)
        g = -2 * cost * weight * y * short
        nw, nb = vw - rate * (vw + x.T @ g), vb - rate * np.float32(g.sum())
        k = np.float32(t / (t + 3))
        vw, vb = nw + k * (nw - w), nb + k * (nb - b)
        w, b = nw, nb
    return w, float(b)


def logistic_fit(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, c) so that 1 / (1 + exp(-(a m + c))) follows y in {1, -1}, with a weak prior on a."""
    a, c, target = 1.0, 0.0, np.where(y > 0, 1 - 1 / (2 + (y > 0).sum()), 1 / (2 + (y < 0).sum()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + c, -30, 30)))
        g = np.array([((p - target) * m).sum() + 0.01 * (a - 4), (p - target).sum()])
        q = p * (1 - p) + 1e-9
        h = np.array([[(q * m * m).sum() + 0.01, (q * m).sum()], [(q * m).sum(), q.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 0.1), float(c)


class LanguageModel:
    """``columns`` of weights: one per family (if several), then one per pair of languages within a family."""

    def __init__(self, x: np.ndarray, langs: list[str], chars: list[int]) -> None:
        """``x``: n-gram shares of training texts, ``chars``: their lengths."""
        self.langs = sorted(set(langs))
        self.families = sorted({family(x) for x in self.langs})
        lang = np.array(langs)
        fam = np.array([family(x) for x in langs])
        self.pairs = [(a, b) for f in self.families for a, b in combinations([x for x in self.langs if family(x) == f], 2)]
        w, b, fit = [], [], []
        tasks = [(np.full(len(lang), True), np.where(fam == f, 1.0, -1.0)) for f in self.families] if len(self.families) > 1 else []
        tasks += [((lang == p) | (lang == q), np.where(lang == p, 1.0, -1.0)) for p, q in self.pairs]
        for rows, y in tasks:
            xs, ys = x if rows.all() else x[rows], y[rows].astype(np.float32)
            wi, bi = svm(xs, ys)
            w.append(wi)
            b.append(bi)
            fit.append(logistic_fit(xs @ wi + bi, ys))
        self.weights = np.stack(w, 1).astype(np.float32) * 64.0 if w else np.zeros((DIM, 0), np.float32)
        self.bias, self.fit = np.array(b), np.array(fit).reshape(-1, 2)
        # a language at a time: vectors as large as all of them together are held only once
        unit = lambda k: np.sqrt(x[lang == k]) / np.sqrt(np.maximum(x[lang == k].sum(1, keepdims=True), 1e-9))
        self.means = np.array([unit(k).mean(0) for k in self.langs]).reshape(-1, DIM)
        self.means /= np.maximum(np.linalg.norm(self.means, axis=1, keepdims=True), 1e-9)
        long = np.array(chars, int) >= LEAST_CHARS
        own = np.concatenate([(unit(k) @ self.means.T).max(1, initial=0)[long[lang == k]] for k in self.langs]) if len(x) else np.zeros(0)
        self.floor = float(FLOOR * np.quantile(own, FLOOR_SHARE)) if len(own) else 0.0

    def likeness(self, texts: list[str]) -> list[float]:
        """Cosine with the nearest language's mean; 1 for short texts."""
        out = np.ones(len(texts))
        long = [k for k, t in enumerate(texts) if len(t) >= LEAST_CHARS]
        for lo in range(0, len(long) if self.langs else 0, 512):
            at = long[lo : lo + 512]
            x = np.sqrt(np.array([np.bincount(grams(texts[k]), minlength=DIM) for k in at], np.float32))
            out[at] = (x @ self.means.T.astype(np.float32)).max(1) / np.linalg.norm(x, axis=1)
        return out.tolist()

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        real = [bool(LETTER.search(t)) for t in texts]
        index = [grams(t) for t, r in zip(texts, real, strict=True) if r]
        if not self.langs or not index:
            return ["und"] * len(texts), [0.0] * len(texts)
        sizes = np.array([len(i) for i in index])
        flat, margin = np.concatenate(index), np.empty((len(index), self.weights.shape[1]))
        for k in range(self.weights.shape[1]):
            margin[:, k] = np.add.reduceat(self.weights[:, k][flat], np.cumsum(sizes) - sizes) / sizes + self.bias[k]
        prob = 1 / (1 + np.exp(-np.clip(self.fit[:, 0] * margin + self.fit[:, 1], -30, 30)))
        nf = len(self.families) if len(self.families) > 1 else 0
        fam_prob = prob[:, :nf] / prob[:, :nf].sum(1, keepdims=True) if nf else np.ones((len(index), 1))
        best_fam = margin[:, :nf].argmax(1) if nf else np.zeros(len(index), int)
        langs_of = [[x for x in self.langs if family(x) == f] for f in self.families]
        out, score = [], []
        for i, f in enumerate(best_fam):
            names = langs_of[f]
            votes = dict.fromkeys(names, 0.0)
            sums, own = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0)
            for k, (a, b) in enumerate(self.pairs, nf):
                if a in votes:
                    p, m = prob[i, k], margin[i, k]
                    votes[a if m > 0 else b] += 1
                    sums[a], sums[b] = sums[a] + m, sums[b] - m
                    own[a], own[b] = own[a] + p, own[b] + 1 - p
            name = max(names, key=lambda x: (votes[x], sums[x], x))
            out.append(name)
            score.append(float(fam_prob[i, f] * (own[name] / (len(names) - 1) if len(names) > 1 else 1.0)))
        named = iter(zip(out, score, strict=True))
        rows = [next(named) if r else ("und", 0.0) for r in real]
        return [r[0] for r in rows], [r[1] for r in rows]


def spark_map(shares: dict[str, float]):
    """A map literal; one row for each language, so as small as the set of languages."""
    return F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])


def train(docs: DataFrame, *, per_lang: int = TRAIN_PER_LANG, most: int = TRAIN_ROWS) -> LanguageModel:
    """Learns from rows with a lang and a letter.

    At most ``per_lang`` rows of each language, ``most`` in all, reach the driver as fixed-size vectors.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("__h"))
    # a row passes if its hash is below its language's share of distinct texts; equal texts count once
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("__h").alias("n")).collect()}
    per_lang = min(per_lang, max(1, most // max(1, len(counts))))
    share = spark_map({lang: min(1.0, 2 * per_lang / max(1, n)) for lang, n in counts.items()})
    once = rows.where(F.col("__h") / 2.0**64 + 0.5 <= share[F.col("lang")]).groupBy("lang", "__h").agg(F.first("text").alias("text")) if counts else rows
    drawn = once.withColumn("__n", F.row_number().over(Window.partitionBy("lang").orderBy("__h"))).where(F.col("__n") <= per_lang).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch):
                vectors = [vector(t).astype(np.float16).tobytes() if LETTER.search(t) else None for t in texts]
                yield pa.RecordBatch.from_arrays([rows_of(batch, start, len(texts), "lang"), pa.array(vectors, pa.binary()), pa.array(list(map(len, texts)), pa.int64())], ["lang", "x", "chars"])

    found = sorted((r["lang"], bytes(r["x"]), r["chars"]) for r in drawn.mapInArrow(run, "lang string, x binary, chars long").where("x is not null").collect())
    x, langs, chars = np.empty((len(found), DIM), np.float32), [k for k, _, _ in found], [n for _, _, n in found]
    for k in range(len(found)):
        x[k], found[k] = np.frombuffer(found[k][1], np.float16), None  # not held twice
    return LanguageModel(x, langs, chars)


def predict(spark: SparkSession, docs: DataFrame, model: LanguageModel, keep: list[str], *, likeness: bool = False) -> DataFrame:
    """Columns ``keep`` of docs, lang_pred and score, and the likeness if asked for."""
    sent = spark.sparkContext.broadcast(model)
    text = "text" if "text" in keep else "__text"
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], *([F.col("text").alias(text)] if text not in keep else []))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[: len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch, text, SLICE_CHARS):
                names, scores = sent.value.predict(texts)
                more = [pa.array(sent.value.likeness(texts))] if likeness else []
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(start, len(texts)) for k in range(len(keep))), pa.array(names), pa.array(scores), *more], [*keep, "lang_pred", "score"] + ["likeness"] * likeness)

    return picked.mapInArrow(run, f"{fields}, lang_pred string, score double" + ", likeness double" * likeness)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of ``documents``, learnt from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(fold("doc_id", FOLDS) != 0))
    found = predict(spark, docs, model, ["doc_id"])
    return found.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "lang_pred", "score")
