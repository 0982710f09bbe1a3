"""Toxicity scores from gradient-boosted trees over dense features.

Features of a text: how densely words of a fixed lexicon, of a lexicon learnt
from labelled texts, and of learnt word beginnings occur; how many such words
stand near a word of the second person; capitals; punctuation; and words whose
letters are disguised by digits or symbols. Trees are grown on the logistic
loss, and isotonic regression on out-of-fold outputs turns them into
probabilities.

Learning happens on the driver, on a bounded sample of labelled rows, whose
whole texts have to fit there; ``sample_rows`` is the bound. Features
of a learning row come from lexicons learnt from other rows. Labels, ids,
languages and sources are no features. A score is 0.99 of the calibrated one
and 0.01 of the raw one, so that texts of a pooled step keep their order; texts
with equal features tie. A very long text is scored whole. A null text is an empty one and gets
the score of a text without words. Without labels every score is 0, with one
label it is that label. Repeated rows get equal scores, an empty table gives an
empty result, and columns other than those named are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm.common import Measure, hash_sample, measure_texts, training_row

#: Labelled rows learnt from at most.
SAMPLE_ROWS = 10_000
#: Insults that say what they are in any context.
INSULTS = frozenset(
    b"idiot idiots moron morons stupid imbecile loser losers scum trash pathetic worthless disgusting clown bastard "
    b"scumbag dumb jerk idiota imbecil dummkopf trottel abschaum connard cretin".split()
)
SECOND_PERSON = frozenset("you your yours yourself u du dich dir dein deine deinen ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".encode().split())
#: How near, in words, and how long a word's beginning is, in bytes.
NEAR, STEM = 4, 6
#: A learnt word has this log-odds at least and occurs in so many toxic texts.
LOG_ODDS, LEAST_TEXTS = 2.0, 4
UNDISGUISE = bytes.maketrans(b"013457@$!", b"oieastasi")
DISGUISED = regex.compile(rb"(?<![a-z0-9])[a-z]+[0-9@$!*]+[a-z][a-z0-9@$!*]*")
STRETCHED = regex.compile(rb"([!-~])\1{2}")
WORDS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
FEATURES = (
    "words", "insult_density", "insults", "learnt_density", "learnt", "log_odds", "distinct", "stem_density", "stems",
    "second_person", "near_second_person", "capitals", "exclamations", "questions", "punctuation", "disguised", "undisguised", "stretched",
)
#: Trees, their depth, learning rate, least rows in a leaf, leaf shrinkage, bins, and folds.
TREES, DEPTH, RATE, LEAF, SHRINK, BINS, FOLDS = 120, 3, 0.1, 8, 1.0, 64, 3


def words_of(raw: bytes) -> list[bytes]:
    return raw.decode().lower().encode().translate(WORDS_ONLY).split()


@dataclass(frozen=True)
class Lexicon:
    """Log-odds of words, and of beginnings of words, that tell toxic texts."""

    words: dict[bytes, float] = field(default_factory=dict)
    stems: frozenset[bytes] = frozenset()


def learn_lexicon(texts: Sequence[list[bytes]], toxic: np.ndarray) -> Lexicon:
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
    found: tuple[Counter, Counter] = (Counter(), Counter())
    stems: tuple[Counter, Counter] = (Counter(), Counter())
    for words, label in zip(texts, toxic):
        distinct = set(words)
        found[label].update(distinct)
        stems[label].update({w[:STEM] for w in distinct if len(w) > STEM})

    def odds(counts: tuple[Counter, Counter]) -> dict[bytes, float]:
        score = {w: float(np.log((k + 0.5) / (n[1] + 1)) - np.log((counts[0][w] + 0.5) / (n[0] + 1))) for w, k in counts[1].items() if k >= LEAST_TEXTS}
        return {w: s for w, s in score.items() if s >= LOG_ODDS}

    return Lexicon(odds(found), frozenset(odds(stems)))


def features(raw: bytes, words: list[bytes], lexicon: Lexicon) -> list[float]:
    n, chars = max(1, len(words)), max(1, len(raw))
    insults = [i for i, w in enumerate(words) if w in INSULTS]
    learnt = [i for i, w in enumerate(words) if w in lexicon.words]
    stems = sum(w[:STEM] in lexicon.stems for w in words) if lexicon.stems else 0
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if persons and (insults or learnt):
        hits, person = np.array(sorted({*insults, *learnt})), np.array([*persons, len(words) + 10 * NEAR])
        after = np.searchsorted(person, hits)
        near = int(((person[after] - hits <= NEAR) | ((after > 0) & (hits - person[after - 1] <= NEAR))).sum())
    letters = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
    capitals = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    exclaimed, asked = raw.count(b"!"), raw.count(b"?")
    marks = len(raw) - len(raw.translate(None, b"\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"))
    hidden = DISGUISED.findall(raw.lower())
    plain = sum((w := h.translate(UNDISGUISE, b"*")) in INSULTS or w in lexicon.words for h in hidden)
    return [
        np.log1p(len(words)), len(insults) / n, np.log1p(len(insults)), len(learnt) / n, np.log1p(len(learnt)),
        sum(lexicon.words[words[i]] for i in learnt) / n, np.log1p(len({words[i] for i in learnt})), stems / n, np.log1p(stems),
        len(persons) / n, np.log1p(near), capitals / max(1, letters), exclaimed / chars, asked / chars, marks / chars,
        len(hidden) / n, np.log1p(plain), len(STRETCHED.findall(raw)) / n,
    ]


@dataclass(frozen=True)
class Trees:
    """Perfect trees of one depth: a feature and a threshold for each inner node, a value for each leaf."""

    bias: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - (2**DEPTH - 1)]
        return total


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Boosting by histograms; every level of a tree is split at once."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    z, inner = np.full(len(y), bias), 2**DEPTH - 1
    feature, threshold, value = np.zeros((trees, inner), int), np.full((trees, inner), np.inf), np.zeros((trees, 2**DEPTH))
    for t in range(trees):
        p = sigmoid(z)
        slope, curve, node = y - p, p * (1 - p), np.zeros(len(y), int)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            local = node - first
            best = np.full(width, 1e-6)
            where = np.full((width, 2), -1)
            for f in range(x.shape[1]):
                at, size = local * BINS + binned[:, f], width * BINS
                g, h, k = (np.bincount(at, w, size).reshape(width, BINS).cumsum(axis=1) for w in (slope, curve, None))
                gain = g**2 / (h + SHRINK) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + SHRINK) - g[:, -1:] ** 2 / (h[:, -1:] + SHRINK)
                gain[(k < LEAF) | (k[:, -1:] - k < LEAF)] = 0
                gain[:, len(cuts[f]) :] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(width), top] > best
                best[better] = gain[np.arange(width), top][better]
                where[better] = np.stack([np.full(width, f), top], axis=1)[better]
            for m, (f, b) in enumerate(where):
                if f >= 0:
                    feature[t, first + m], threshold[t, first + m] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, 2**DEPTH), np.bincount(leaf, curve, 2**DEPTH)
        value[t] = RATE * g / (h + SHRINK)
        z += value[t, leaf]
    return Trees(bias, feature, threshold, value)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (mean score, rate) of the rising step function nearest to ``y``; neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for s, label in sorted(zip(score.tolist(), y.tolist())):
        blocks.append([s, label, 1.0])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([s / n for s, _, n in blocks]), np.array([label / n for _, label, n in blocks])


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    constant: float = 0.0

    def score(self, raws: Sequence[bytes]) -> np.ndarray:
        """Calibrated probabilities, with a trace of the raw ones to order texts of a pooled block."""
        if self.trees is None or not raws:
            return np.full(len(raws), self.constant)
        x = np.array([features(r, words_of(r), self.lexicon) for r in raws])
        p = sigmoid(self.trees.raw(x))
        return np.clip(0.99 * np.interp(p, *self.knots) + 0.01 * p, 0, 1)


def train(raws: Sequence[bytes], toxic: Sequence[int]) -> Model:
    y = np.asarray(toxic, int)
    nothing = (np.zeros(1), np.zeros(1))
    if len(y) < 2 * FOLDS or len(set(y.tolist())) < 2:
        return Model(Lexicon(), None, nothing, float(y.mean()) if len(y) else 0.0)
    words = [words_of(r) for r in raws]
    fold = np.random.default_rng(9).permutation(len(y)) % FOLDS
    x = np.empty((len(y), len(FEATURES)))
    for k in range(FOLDS):
        others = np.flatnonzero(fold != k)
        lexicon = learn_lexicon([words[i] for i in others], y[others])
        for i in np.flatnonzero(fold == k):
            x[i] = features(raws[i], words[i], lexicon)
    out = np.empty(len(y))
    for k in range(FOLDS):
        out[fold == k] = sigmoid(grow(x[fold != k], y[fold != k]).raw(x[fold == k]))
    return Model(learn_lexicon(words, y), grow(x, y), isotonic(out, y))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``sample_rows`` labelled rows, chosen by a hash of the id; so many ids are broadcast, no more."""
    known = labels.where(training_row(id_col) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    chosen = hash_sample(known, "id", sample_rows, known.count())
    text = F.col(text_col).cast("string")
    texts = docs.where(text.isNotNull()).select(F.col(id_col).alias("id"), text.alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").orderBy("id").limit(sample_rows).collect()
    return train([r.text.encode() for r in rows], [int(r.toxic > 0) for r in rows])


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Measure:
        return lambda texts: [pa.array(shared.value.score(texts), pa.float64())]

    return measure_texts(docs, id_col, text_col, make, [T.StructField("score", T.DoubleType())])
