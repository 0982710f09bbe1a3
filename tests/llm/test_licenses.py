import random
from time import perf_counter

from lexiframe.llm.licenses import NOTICES, PHRASES, Notice, Scanner, scan_licenses


def words_of(text):
    out, word = [], ""
    for c in text:
        c = c.lower() if "A" <= c <= "Z" else c
        if ord(c) >= 128 or c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out + [word] * bool(word)


def places(text):
    words = words_of(text)
    return sorted((i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_phrases_against_loops():
    draw = random.Random(1)
    parts = ["cc", "by", "cc by", "General", "public", "license", "all rights RESERVED", "x", "é", ".", "-", "\n", " "]
    scanner = Scanner(PHRASES, {})
    for _ in range(300):
        text = draw.choice([" ", "", ", "]).join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        found, wanted = scanner.scan(text.encode()), places(text)
        assert found["n_words"] == len(words_of(text)) and found["n_base"] == len(wanted)
        assert found["first_word"] == min((w for w, _ in wanted), default=None)
        assert found["last_word"] == max((w for w, _ in wanted), default=None)
        assert found["base_labels"] == ",".join(sorted({x for _, x in wanted}))


def test_notices_with_edits_are_found():
    draw = random.Random(2)
    scanner = Scanner(PHRASES, NOTICES)
    for text, label in NOTICES.items():
        edits = Notice.of(text, label).edits
        for _ in range(15):
            spelt = list(text)
            for _ in range(draw.randint(0, edits)):
                at = draw.randrange(1, len(spelt) - 1)
                spelt[at] = draw.choice(["", "q", spelt[at] + "z"]) if spelt[at] not in ("", " ") else spelt[at]
            shown = "Zuvor: (" + "".join(spelt) + ") danach ü"
            found = scanner.scan(shown.encode())
            span = next(s for s in found["spans"] if s["label"] == label)
            assert distance(" ".join(words_of(shown[span["start"] : span["end"]])), text) == span["edits"] <= edits
            assert span["word"] == 1 and shown[span["start"] :].startswith(spelt[0])
            assert found["score"] >= 1 - edits / len(text)


def test_notices_against_all_word_ranges():
    """Exactly the texts that hold a run of words within the bound have the label; no seed or window is relied on."""
    draw = random.Random(5)
    notice = Notice.of("all rights reserved", "reserved")
    scanner, seen = Scanner({}, {notice.text: notice.label}), set()
    for _ in range(400):
        near = list(notice.text)
        for _ in range(draw.randint(0, 4)):
            at = draw.randrange(len(near))
            near[at] = draw.choice(["", "q", " ", near[at] + "z", near[at] + " "])
        noise = ["".join(draw.choice("al rights") for _ in range(draw.randint(1, 14))) for _ in range(4)]
        text = " ".join([*noise[:2], "".join(near), *noise[2:]])
        words = words_of(text)
        runs = [" ".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, min(len(words), i + 8) + 1)]
        least = min((distance(run, notice.text) for run in runs if abs(len(run) - len(notice.text)) <= notice.edits), default=99)
        found = scanner.scan(text.encode())
        assert (found["labels"] == "reserved") == (least <= notice.edits), text
        assert min((s["edits"] for s in found["spans"]), default=99) == (least if least <= notice.edits else 99), text
        seen.add(least)
    assert {0, 1, 2, 3} <= seen


def test_very_long_texts_cost_in_proportion():
    scanner = Scanner(PHRASES, NOTICES)
    for text in (b"license" * 150_000, b"license " * 130_000, b"general public " * 70_000):
        began = perf_counter()
        scanner.scan(text)
        assert perf_counter() - began < 30


def test_nothing_beyond_the_bound():
    found = Scanner({}, {"all rights reserved": "reserved"}).scan(b"ell righxs reqerved and small rights reservedly")
    assert found["labels"] == "" and found["score"] == 0.0 and found["spans"] == []


def test_rows(spark):
    rows = [(1, "(C) All rights reserved. cc-by", "x"), (1, "(C) All rights reserved. cc-by", "x"), (2, None, "x"), (3, "", "x"), (4, "cc by " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    found = sorted(scan_licenses(docs).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_base, r.labels, r.score) for r in found] == [(6, 2, "cc-by,reserved", 1.0)] * 2 + [(0, 0, "", 0.0)] * 2 + [(60_000, 30_000, "cc-by", 1.0)]
    assert (found[4].first_word, found[4].last_word, found[2].first_word) == (0, 59_998, None)
    assert scan_licenses(docs.limit(0)).count() == 0
