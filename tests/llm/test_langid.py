import random
import zlib

import numpy as np

from lexiframe.llm import langid

SYLLABLES = {"aa": "ka to mi ra".split(), "bb": "sch ung ein keit".split(), "cc": "é eau que oi".split(), "dd": "ción ñ el os".split()}


def corpus(n=400, languages=SYLLABLES):
    draw = random.Random(1)
    rows = []
    for doc_id in range(n):
        lang = draw.choice(sorted(languages))
        words = ["".join(draw.choices(languages[lang], k=draw.randint(1, 3))) for _ in range(draw.randint(5, 60))]
        rows.append((doc_id, " ".join(words), lang, "clash"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")


def test_held_out_accuracy_and_odd_texts(spark):
    rows = corpus()
    odd = [(10_001, None, "aa", "x"), (10_002, "", "aa", "x"), (10_003, "123 !? \n²", None, "x"), (10_004, "kato " * 60_000, None, "x"), (None, "schung einkeit", "bb", "x")]
    docs = frame(spark, rows + odd + rows[:1])
    found = langid.identify(docs, langid.learn(docs))
    out = found.collect()
    assert len(out) == len(rows) + len(odd) + 1
    by_id = {r.doc_id: r for r in out}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([by_id[i].lang_pred == lang for i, _, lang, _ in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in out)
    assert [by_id[i].lang_pred for i in (10_001, 10_002, 10_003, 10_004, None)] == ["und", "und", "und", "aa", "bb"]
    assert by_id[10_001].score == 0
    kept = langid.keep_identified(docs, langid.learn(docs))
    assert kept.columns == docs.columns and kept.count() == len(out) - 3


def test_held_out_labels_are_not_learnt(spark):
    rows = corpus(200)
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in rows]
    assert langid.learn(frame(spark, wrong)).languages == ("aa", "bb", "cc", "dd")


def test_sample_is_bounded_and_even(spark):
    sample = langid.training_sample(frame(spark, corpus(400)), "doc_id", "text", "lang", sample_rows=40)
    counts = {lang: sum(r.lang == lang for r in sample) for lang in SYLLABLES}
    assert len(sample) <= 40 and min(counts.values()) >= 5


def test_nothing_or_one_language_to_learn(spark):
    empty = langid.learn(frame(spark, []))
    docs = frame(spark, [(1, "kato", None, "x")])
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, empty).collect()] == [("und", 0.0)]
    one = langid.train([b"kato mira"], ["aa"])
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, one).collect()] == [("aa", 1.0)]
    assert langid.identify(docs.limit(0), one).count() == 0


def test_codewords_differ_in_many_bits():
    for classes in (2, 3, 4, 6, 7, 20, 60):
        code = langid.codewords(classes)
        distance = min((a != b).sum() for i, a in enumerate(code) for b in code[:i])
        assert distance >= (1 if classes == 2 else 2) and set(np.unique(code)) == {-1.0, 1.0}
        assert not (np.abs(code.sum(axis=0)) == classes).any()
    assert langid.codewords(4).shape == (4, 7)


def test_long_texts_are_summed_in_blocks(monkeypatch):
    model = langid.train([b"kato mira", b"schung ein"] * 5, ["aa", "bb"] * 5)
    clean = langid.cleaned(b"kato schung ein mira " * 50)
    whole = model.outputs([clean])
    monkeypatch.setattr(langid, "BLOCK", 64)
    assert np.allclose(model.outputs([clean]), whole)


def test_ambiguous_between_two():
    model = langid.Model(("aa", "bb"), langid.codewords(2), np.zeros((langid.BUCKETS + 1, 1), np.float32), np.ones(1))
    assert model.predict([b"any text"])[2].tolist() == [True]


def test_decoding_against_plain_loops():
    model = langid.train([b"kato mira", b"schung ein", b"zed qua"] * 6, ["aa", "bb", "cc"] * 6)
    for raw in (b"kato schung", b"mira qua", b"zed", b"Ein  KATO!"):
        clean = langid.cleaned(raw)
        total = [0.0] * model.code.shape[1]
        for i in range(len(clean) - 2):
            bucket = ((clean[i] << 16 | clean[i + 1] << 8 | clean[i + 2]) * 2_654_435_761 % 2**32) >> 16
            total = [t + float(w) for t, w in zip(total, model.weights[bucket])]
        out = [t / (len(clean) - 2) + float(b) for t, b in zip(total, model.weights[-1])]
        loss = [sum(r * np.log1p(np.exp(-o * bit)) for r, o, bit in zip(model.reliability, out, word)) for word in model.code]
        odds = [np.exp(-x) for x in loss]
        languages, score, _ = model.predict([raw])
        best = max(range(3), key=odds.__getitem__)
        assert languages == [model.languages[best]] and np.isclose(score[0], odds[best] / sum(odds), atol=1e-5)


def test_only_texts_in_one_language_are_kept(spark):
    model = langid.Model(("aa", "bb"), langid.codewords(2), np.zeros((langid.BUCKETS + 1, 1), np.float32), np.ones(1))
    sure = langid.train([b"kato mira", b"schung ein"] * 20, ["aa", "bb"] * 20)
    docs = frame(spark, [(1, "kato mira kato", "aa", "x"), (2, "12 34", None, "x"), (None, None, None, "x")])
    assert langid.keep_identified(docs, model).count() == 0
    assert [r.doc_id for r in langid.keep_identified(docs, sure, least_score=0.6).collect()] == [1]
    assert [r.doc_id for r in langid.keep_identified(docs, langid.learn(docs.limit(0))).collect()] == [1]
