from lexiframe.llm import quality
from lexiframe.llm.quality import RULES, Page, judge, keep_clean, order_rules

CLEAN = " ".join(f"word{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(80))
ODD = {
    "clean": CLEAN,
    "short": "only a few words here",
    "empty": "",
    "null": None,
    "repeats": "one two three four " * 30,
    "symbols": " ".join(w + "%%" for w in CLEAN.split()),
    "lines": "\n".join([CLEAN] + ["again and again " + CLEAN[:40]] * 4),
    "digits": " ".join(str(10_000 + n) for n in range(80)),
    "long": CLEAN + " x" + "y" * 200_000,
    "unbroken": "a" * 300_000,
}


def frame(spark, texts=ODD):
    rows = [(name, text, "k") for name, text in texts.items()]
    return spark.createDataFrame(rows, "doc_id string, text string, kept string")


def repeat_words(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_measures_against_loops():
    for text in ("a b c a b c d", "x x x x", "a b", "", "one\ttwo\x0bthree\x85four one two three", "É b c\n\nd\nd\n d\n"):
        page = Page(text.encode())
        assert page.n_repeat_words == repeat_words(text)
        lines = [line for line in text.split("\n") if any(c not in " \t\r\x0b\x0c" for c in line)]
        assert page.n_dup_lines == sum(line in lines[:i] for i, line in enumerate(lines))
        assert page.word_chars == sum(c not in " \t\n\r\x0b\x0c" for c in text)
        assert page.n_words == len(text.encode().split())


def test_verdicts_do_not_depend_on_the_order(spark):
    docs = frame(spark)
    found = [{r.doc_id: r.kept for r in judge(docs, rules=rules).collect()} for rules in (RULES, RULES[::-1], None)]
    assert found[0] == found[1] == found[2]
    assert {k for k, kept in found[0].items() if kept} == {"clean"} | ({"long"} if found[0]["long"] else set())
    assert sorted(r.doc_id for r in keep_clean(docs).collect()) == sorted(k for k, kept in found[0].items() if kept)
    assert keep_clean(docs).columns == docs.columns


def test_reported_measures_and_reason(spark):
    rows = {r.doc_id: r for r in judge(frame(spark), rules=RULES, measures=["n_words", "n_symbols"]).collect()}
    assert (rows["null"].n_words, rows["null"].rejected_by) == (0, "few_words")
    assert (rows["symbols"].n_symbols, rows["symbols"].rejected_by) == (160, "symbols")
    assert rows["repeats"].rejected_by == "repeated_words" and rows["clean"].rejected_by is None


def test_planned_order_puts_cheap_and_strict_rules_first():
    calls = []

    def slow(page):
        calls.append(page)
        return sum(range(20_000)) < 0

    rules = [quality.Rule("slow", (), slow), quality.Rule("strict", ("n_words",), lambda p: True)]
    assert [r.name for r in order_rules(rules, [b"a b"] * 20)] == ["strict", "slow"]
    assert order_rules(rules, []) == rules


def test_a_later_rule_is_not_asked():
    asked = []
    rules = [quality.Rule("first", (), lambda p: True), quality.Rule("second", (), lambda p: asked.append(p) or True)]
    assert quality.first_rejection(rules, Page(b"x")) == "first" and not asked


def test_empty_table(spark):
    assert judge(frame(spark, {})).count() == 0 and keep_clean(frame(spark, {})).count() == 0
