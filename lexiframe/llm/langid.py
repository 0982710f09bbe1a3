"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit a linear classifier on
hashed byte 3-grams learns which languages have the bit set; a text's score
for a language is how well the classifiers' outputs fit its codeword, each bit
weighted by how reliable its classifier was on texts that it hadn't learnt
from. With few languages the code is exhaustive; with many, codewords are
drawn so that any two differ in many bits. If the two best languages are
nearly as good, the text is flagged as ambiguous.

The classifiers learn from a bounded sample of labelled rows on the driver,
``sample_rows`` in all, which have to fit there; whole texts are used, there
and in prediction. Languages that tie are taken by name, and are ambiguous. A null text, or one without a
letter, is ``und`` with score 0, and so is every text if nothing was learnt.
Repeated rows get equal answers, an empty table gives an empty result, and
columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm.common import LOWER, Measure, hash_share, keep_rows, measure_texts, training_row

UNDETERMINED = "und"
#: Rows learnt from in all, shared evenly by the languages.
SAMPLE_ROWS = 4000
BUCKETS = 1 << 16
#: Counts of up to so many languages are broadcast.
BROADCAST_LANGUAGES = 10_000
#: Passes over the sample, learning rate, and how strongly weights are held small.
EPOCHS, RATE, DECAY = 20, 0.5, 1e-6
#: Share of the sample on which the bits' reliability is measured.
VALIDATION = 5
#: A text is ambiguous if the best language is not this much likelier than the next.
MARGIN = 0.1
#: The pipeline keeps texts whose language has this score at least.
LEAST_SCORE = 0.9
#: Bytes scored at once.
BLOCK = 1 << 20
LETTER = regex.compile(r"\p{L}")
#: ASCII other than letters separates; runs of it count once.
CLEAN = bytes(LOWER[b] if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def cleaned(raw: bytes) -> bytes:
    return b" " + b" ".join(raw.translate(CLEAN).split()) + b" "


def grams(clean: bytes) -> np.ndarray:
    """Buckets of the byte 3-grams of a cleaned text."""
    b = np.frombuffer(clean, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2_654_435_761)) >> np.uint32(16)


def codewords(classes: int, seed: int = 5) -> np.ndarray:
    """+1 and -1, a row for each class; columns are distinct splits of the classes."""
    if classes <= 1:
        return np.ones((classes, 0))
    if classes <= 6:
        columns = [(1, *rest) for rest in product((1, -1), repeat=classes - 1) if -1 in rest]
        return np.array(columns, float).T
    bits = int(np.ceil(6 * np.log2(classes)))
    draw, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = draw.choice((1.0, -1.0), (classes, bits))
        distance = (bits - code @ code.T) / 2
        np.fill_diagonal(distance, bits)
        if distance.min() > apart and (np.abs(code.sum(axis=0)) < classes).all():
            best, apart = code, distance.min()
    return best


@dataclass(frozen=True)
class Model:
    """``weights`` has a row for each bucket and a last one for the bias, a column for each bit."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray

    def outputs(self, texts: Sequence[bytes]) -> np.ndarray:
        """Mean weight of each text's grams, plus the bias."""
        out = np.empty((len(texts), self.code.shape[1]))
        for i, clean in enumerate(texts):
            total, n = np.zeros(self.code.shape[1]), max(1, len(clean) - 2)
            for at in range(0, len(clean), BLOCK):
                total += self.weights[grams(clean[at : at + BLOCK + 2])].sum(axis=0, dtype=np.float64)
            out[i] = total / n + self.weights[-1]
        return out

    def probabilities(self, texts: Sequence[bytes]) -> np.ndarray:
        """Loss-weighted decoding: a softmax over minus each language's weighted logistic loss."""
        loss = np.logaddexp(0, -self.outputs(texts)[:, None, :] * self.code[None]) @ self.reliability
        fit = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return fit / fit.sum(axis=1, keepdims=True)

    def predict(self, raws: Sequence[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        lettered = np.array([bool(self.languages) and LETTER.search(r.decode()) is not None for r in raws], bool)
        languages, score, ambiguous = [UNDETERMINED] * len(raws), np.zeros(len(raws)), np.zeros(len(raws), bool)
        if lettered.any():
            p = self.probabilities([cleaned(r) for r, has in zip(raws, lettered) if has])
            for at, row in zip(np.flatnonzero(lettered), p):
                best = int(row.argmax())
                languages[at], score[at] = self.languages[best], row[best]
                ambiguous[at] = len(row) > 1 and np.partition(row, -2)[-2] > row[best] - MARGIN
        return languages, score, ambiguous


def train(texts: Sequence[bytes], labels: Sequence[str]) -> Model:
    """Logistic classifiers for all bits together, by averaged gradient steps on gram frequencies."""
    languages = tuple(sorted(set(labels)))
    code = codewords(len(languages))
    bits = code.shape[1]
    weights = np.zeros((BUCKETS + 1, bits), np.float32)
    if not bits:
        return Model(languages, code, weights, np.ones(bits))
    number = {language: k for k, language in enumerate(languages)}
    wanted = code[[number[label] for label in labels]]
    rows = []
    for raw in texts:
        found, counts = np.unique(grams(cleaned(raw)), return_counts=True)
        rows.append((found, (counts / max(1, counts.sum())).astype(np.float32)))
    order = np.random.default_rng(3).permutation(len(rows))
    held, learnt = order[::VALIDATION], np.array([i for at, i in enumerate(order) if at % VALIDATION], int)
    squares = np.full((BUCKETS + 1, bits), 1e-8, np.float32)
    draw = np.random.default_rng(4)
    for _ in range(EPOCHS):
        for i in draw.permutation(learnt):
            found, share = rows[i]
            margin = share @ weights[found] + weights[-1]
            slope = -wanted[i] / (1 + np.exp(np.clip(wanted[i] * margin, -30, 30)))
            for at, x in ((found, share[:, None]), (np.array([BUCKETS]), np.ones((1, 1), np.float32))):
                gradient = x * slope + DECAY * weights[at]
                squares[at] += gradient * gradient
                weights[at] -= RATE * gradient / np.sqrt(squares[at])
    model = Model(languages, code, weights, np.ones(bits))
    right = (model.outputs([cleaned(texts[i]) for i in held]) * wanted[held] > 0).mean(axis=0) if len(held) else np.ones(bits)
    return Model(languages, code, weights, np.maximum(2 * right - 1, 0.05))


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_rows: int = SAMPLE_ROWS) -> list:
    """At most ``sample_rows`` labelled rows with (text, lang), evenly from all languages, by a hash of the id.

    The ids are chosen first, without reading texts; no more than
    ``sample_rows`` of them are broadcast to fetch the texts.
    """
    labelled = docs.where(training_row(id_col) & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"))
    per_language = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    languages = per_language.count()
    if not languages:
        return []
    share = max(1, sample_rows // languages)
    shares = F.broadcast(per_language) if languages <= BROADCAST_LANGUAGES else per_language
    few = labelled.join(shares, "lang").where(hash_share("id") < share * 1.05 / F.col("n"))
    of_language = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = few.withColumn("at", F.row_number().over(of_language)).where(F.col("at") <= share).select("id").limit(sample_rows)
    text = F.col(text_col).cast("string")
    taken = docs.where(F.col(lang_col).isNotNull() & text.isNotNull())
    taken = taken.select(F.col(id_col).alias("id"), text.alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return taken.join(F.broadcast(chosen.distinct()), "id", "left_semi").orderBy("id").limit(sample_rows).collect()


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    rows = [r for r in training_sample(docs, id_col, text_col, lang_col, sample_rows) if LETTER.search(r.text)]
    return train([r.text.encode() for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id, ``lang_pred``, ``score`` and ``ambiguous``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Measure:
        def measure(texts: list[bytes]) -> list[pa.Array]:
            languages, score, ambiguous = shared.value.predict(texts)
            return [pa.array(languages, pa.string()), pa.array(score), pa.array(ambiguous)]

        return measure

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return measure_texts(docs, id_col, text_col, make, fields)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` in one language, with all their columns.

    Texts without a letter, ambiguous ones and those with a lower score than
    ``least_score`` are dropped. If nothing was learnt there is no verdict, and
    all rows with a letter stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def accept(texts: list[bytes]) -> list[bool]:
        if not shared.value.languages:
            return [LETTER.search(t.decode()) is not None for t in texts]
        languages, score, ambiguous = shared.value.predict(texts)
        return [name != UNDETERMINED and s >= least_score and not a for name, s, a in zip(languages, score, ambiguous)]

    return keep_rows(docs, text_col, lambda: accept)
