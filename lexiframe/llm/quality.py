"""Quality rules as a short-circuit cascade.

Every rule rejects a text or lets it pass; a text is kept if no rule rejects
it, so the order of the rules decides only the cost. The order is planned on a
sample: each measure is timed, each rule's verdicts are counted, and greedily
the rule with the most rejections per second among the sampled texts that are
still left comes next, where measures that an earlier rule has already taken
cost nothing.

Words are runs of other characters than ASCII white space. A null text is an
empty one, has no words and is rejected by ``few_words``. Repeated rows are
judged each on its own; an empty table gives an empty result; columns other
than the id and the text are ignored by ``judge`` and kept by ``keep_clean``.
A very long text is judged whole, as one row of a batch. Rules that tie keep
the order in which they were given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property
from time import perf_counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm.common import Measure, keep_rows, long_field, measure_texts

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
LETTERS = bytes(b for b in range(256) if b >= 128 or chr(b).isalpha())
#: Texts, about, sampled from the whole table to plan the cascade.
SAMPLE_ROWS = 400


class Page:
    """One text, its measures taken when a rule first asks for them."""

    def __init__(self, raw: bytes) -> None:
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        dense = self.raw.translate(None, SPACE)
        return len(dense) if dense.isascii() else len(dense.decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def letter_bytes(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, LETTERS))

    @cached_property
    def word_bytes(self) -> int:
        return len(self.raw.translate(None, SPACE))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of three words found at least twice."""
        words = self.words
        if len(words) < 4:
            return 0
        number = dict(zip(dict.fromkeys(words), range(len(words))))
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, of, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(counts[of] > 1)
        covered = np.zeros(len(words), bool)
        for shift in range(3):
            covered[twice + shift] = True
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    """``rejects`` says whether a page falls; ``needs`` names the measures that it reads."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Page], bool]


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda p: p.n_words < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda p: 100 * p.n_repeat_words > 50 * p.n_words),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", ("n_symbols", "n_words"), lambda p: 100 * p.n_symbols > 20 * p.n_words),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), lambda p: 100 * p.n_dup_lines > 50 * p.n_lines),
    Rule("word_length", ("n_words", "word_chars"), lambda p: p.word_chars < 2 * p.n_words or p.word_chars > 25 * p.n_words),
    Rule("few_letters", ("letter_bytes", "word_bytes"), lambda p: 100 * p.letter_bytes < 60 * p.word_bytes),
)


def order_rules(rules: Sequence[Rule], texts: Sequence[bytes]) -> list[Rule]:
    """The rules, best rejections per second first, as measured on ``texts``; as given if there are none."""
    left, todo, taken, planned = [Page(t) for t in texts], list(rules), set(), []
    if not left:
        return todo
    seconds: dict[str, float] = {}
    for measure in dict.fromkeys(m for r in rules for m in r.needs):
        began = perf_counter()
        for page in left:
            getattr(page, measure)
        seconds[measure] = perf_counter() - began
    falls = {}
    for rule in rules:
        began = perf_counter()
        falls[rule.name] = np.fromiter((rule.rejects(p) for p in left), bool, len(left))
        seconds[rule.name] = perf_counter() - began
    alive = np.ones(len(left), bool)
    while todo:
        cost = {r.name: seconds[r.name] + sum(seconds[m] for m in r.needs if m not in taken) for r in todo}
        best = max(todo, key=lambda r: ((falls[r.name] & alive).sum() + 1e-9) / (cost[r.name] + 1e-9))
        planned.append(best)
        todo.remove(best)
        taken.update(best.needs)
        alive &= ~falls[best.name]
    return planned


def plan_cascade(docs: DataFrame, text_col: str, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order planned on about ``sample_rows`` whole texts, drawn alike from all rows of the table."""
    share = min(1.0, sample_rows / max(1, docs.count()))
    taken = docs.select(F.col(text_col).cast("string").alias("text"))
    return order_rules(rules, [(row.text or "").encode() for row in taken.sample(share, 7).collect()])


def first_rejection(rules: Sequence[Rule], page: Page) -> str | None:
    return next((rule.name for rule in rules if rule.rejects(page)), None)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None, measures: Sequence[str] = ()) -> DataFrame:
    """One row for each row of ``docs``: the id, ``kept``, ``rejected_by`` and the asked ``measures``.

    ``rules`` are applied in the order given; None plans the order on a sample.
    ``rejected_by`` is the first rule of that order that rejects, else null. A
    measure that is asked for is taken for every text, others only until a
    rule rejects.
    """
    cascade = plan_cascade(docs, text_col) if rules is None else list(rules)

    def make() -> Measure:
        def measure(texts: list[bytes]) -> list[pa.Array]:
            pages = [Page(t) for t in texts]
            fell = [first_rejection(cascade, p) for p in pages]
            return [
                pa.array([f is None for f in fell]),
                pa.array(fell, pa.string()),
                *(pa.array([getattr(p, m) for p in pages], pa.int64()) for m in measures),
            ]

        return measure

    fields = [T.StructField("kept", T.BooleanType()), T.StructField("rejected_by", T.StringType()), *map(long_field, measures)]
    return measure_texts(docs, id_col, text_col, make, fields)


def keep_clean(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    cascade = plan_cascade(docs, text_col) if rules is None else list(rules)
    return keep_rows(docs, text_col, lambda: lambda texts: [first_rejection(cascade, Page(t)) is None for t in texts])
