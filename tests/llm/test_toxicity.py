import random
import zlib

import numpy as np

from lexiframe.llm import toxicity


def corpus(n=700):
    draw = random.Random(5)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "re", "su") for b in ("ba", "du", "fen", "gor", "hin", "jot")]
    rows, labels = [], []
    for doc_id in range(n):
        toxic = draw.random() < 0.2
        words = draw.choices(plain, k=draw.randint(10, 80))
        if toxic:
            for _ in range(draw.randint(2, 5)):
                words.insert(draw.randrange(len(words)), draw.choice(["idiot", "zurkel", "blifo", "you moron"]))
        rows.append((doc_id, " ".join(words), 0.5))
        labels.append((doc_id, int(toxic)))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id bigint, text string, score double"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_and_odd_texts(spark):
    rows, labels = corpus()
    odd = [(-1, None, 0.0), (-2, "", 0.0), (-3, "idiot " * 50_000, 0.0), (None, "kaba", 0.0)]
    docs, known = frames(spark, rows + odd + rows[:1], labels + labels[:3] + [(None, 1), (-1, None)])
    model = toxicity.learn(docs, known)
    out = toxicity.score_toxicity(docs, model).collect()
    score = {r.doc_id: r.score for r in out}
    assert len(out) == len(rows) + 5 and all(0 <= s <= 1 for s in score.values())
    held = [(score[i] >= 0.7, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([p == t for p, t in held]) > 0.95
    assert {b"zurkel", b"blifo"} <= set(model.lexicon.words)
    assert score[-1] == score[-2] < 0.7 and score[-3] >= 0.7


def test_without_labels(spark):
    rows, labels = corpus(30)
    docs, known = frames(spark, rows, labels)
    for some, wanted in ((known.limit(0), 0.0), (known.selectExpr("doc_id", "1 AS toxic"), 1.0)):
        assert {r.score for r in toxicity.score_toxicity(docs, toxicity.learn(docs, some)).collect()} == {wanted}
    assert toxicity.score_toxicity(docs.limit(0), toxicity.learn(docs, known)).count() == 0


def test_features():
    lexicon = toxicity.Lexicon({b"zurkel": 3.0}, frozenset({b"zurkel"}))
    raw = b"YOU are a zurkel! 1d10t id1ot zurkelness aaaa?"
    found = dict(zip(toxicity.FEATURES, toxicity.features(raw, toxicity.words_of(raw), lexicon)))
    assert found["learnt"] == np.log1p(1) and found["near_second_person"] == np.log1p(1) and found["stems"] == np.log1p(2)
    assert found["undisguised"] == np.log1p(1) and found["exclamations"] == 1 / len(raw) and found["stretched"] > 0
    assert len(found) == len(toxicity.FEATURES) == len(toxicity.features(b"", [], lexicon))


def test_trees_learn_and_isotonic_rises():
    draw = np.random.default_rng(1)
    x = draw.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    assert ((toxicity.grow(x, y, 60).raw(x) > 0) == y).mean() > 0.95
    knots, rate = toxicity.isotonic(draw.random(200), draw.integers(0, 2, 200))
    assert (np.diff(rate) > 0).all() and (np.diff(knots) > 0).all()
    assert toxicity.isotonic(np.array([0.1, 0.2, 0.3]), np.array([1, 0, 1]))[1].tolist() == [0.5, 1.0]


def test_trees_against_plain_loops():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(300, 4))
    trees = toxicity.grow(x, (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(int), trees=12)
    for row, found in zip(x, trees.raw(x)):
        total = trees.bias
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node - len(feature)]
        assert abs(total - found) < 1e-9


def test_features_against_plain_loops():
    lexicon = toxicity.Lexicon({b"wretch": 3.0, b"vile": 2.5}, frozenset({b"wretch"}))
    draw = np.random.default_rng(7)
    parts = ["you", "idiot", "VILE", "wretchedness", "wretch", "1d10t", "fine", "day!", "so?", "noooo", "tu,", "Été"]
    for _ in range(60):
        raw = " ".join(draw.choice(parts, draw.integers(0, 30)))
        found = dict(zip(toxicity.FEATURES, toxicity.features(raw.encode(), toxicity.words_of(raw.encode()), lexicon)))
        words = "".join(c if c.isalpha() else " " for c in raw.lower()).split()
        insult = [w in ("idiot",) for w in words]
        learnt = [w in ("wretch", "vile") for w in words]
        person = [w in ("you", "tu") for w in words]
        near = sum((a or b) and any(person[max(0, i - 4) : i + 5]) for i, (a, b) in enumerate(zip(insult, learnt)))
        letters = [c for c in raw if c.isascii() and c.isalpha()]
        n = max(1, len(words))
        assert np.isclose(found["insult_density"], sum(insult) / n) and np.isclose(found["learnt_density"], sum(learnt) / n)
        assert np.isclose(found["near_second_person"], np.log1p(near)) and np.isclose(found["second_person"], sum(person) / n)
        assert np.isclose(found["capitals"], sum(c.isupper() for c in letters) / max(1, len(letters)))
        assert np.isclose(found["stems"], np.log1p(sum(w.startswith("wretch") for w in words)))
        assert np.isclose(found["exclamations"], raw.count("!") / max(1, len(raw.encode())))
