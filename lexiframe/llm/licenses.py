"""License scans: exact phrases, and short notices with a few misspelt letters.

Texts are reduced to words (letters, digits and everything beyond ASCII; A-Z
lower-cased) joined by single spaces. A notice of ``m`` characters may differ
by up to ``k`` edits; cut into ``k + 1`` pieces, at least one piece of every
match is intact, so an automaton over all pieces finds every place where a
match can lie, and only there the regex library's bounded-error matching
decides. A verified notice may not begin or end inside a word.

A null text is an empty one: no words, no labels, score 0. Very long texts are
scanned whole; a seed costs a window of bounded length, wherever it stands, and
where words neither begin nor end the window is passed over. Of matches of a
label that overlap, that with fewest edits stays, then the longest, then the
first. Repeated rows are scanned each on its own, an empty table gives an empty
result, and columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexiframe.llm.common import LOWER, Measure, long_field, measure_texts

#: Exact phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Short notices, as normalised words, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "permission to use copy modify and or distribute this software": "isc",
    "spdx license identifier": "spdx",
    "all rights reserved": "reserved",
}
#: A notice may have one edit for each so many characters.
CHARS_PER_EDIT = 9
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
FLATTEN = bytes(32 if b in SEPARATORS else LOWER[b] for b in range(256))
#: Stands for text beyond a window; found in no notice.
BEYOND = "\uffff"
ORIGINAL_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("word", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("edits", T.LongType()),
        ]
    )
)


@dataclass(frozen=True)
class Notice:
    """A notice, the edits it may have, its pieces with their offsets, and its pattern."""

    text: str
    label: str
    edits: int
    pieces: tuple[tuple[str, int], ...]
    pattern: regex.Pattern = field(compare=False)

    @classmethod
    def of(cls, text: str, label: str, edits: int | None = None) -> Notice:
        k = len(text) // CHARS_PER_EDIT if edits is None else edits
        bounds = [len(text) * i // (k + 1) for i in range(k + 2)]
        pieces = tuple((text[a:b], a) for a, b in zip(bounds, bounds[1:]))
        return cls(text, label, k, pieces, regex.compile(rf"(?b)(?<!\S)(?:{regex.escape(text)}){{e<={k}}}(?!\S)"))


class Scanner:
    """Finds phrases and notices in texts; one for each task."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str]) -> None:
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.notices = [Notice.of(t, label) for t, label in notices.items()]
        self.seeds = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for n, notice in enumerate(self.notices):
            for piece, offset in notice.pieces:
                at.setdefault(piece, []).append((n, offset))
        for piece, places in at.items():
            self.seeds.add_word(piece, (len(piece), places))
        if at:
            self.seeds.make_automaton()

    def places(self, padded: bytes) -> list[tuple[int, str]]:
        """(word, label) of every place where a phrase stands."""
        found = []
        for phrase, label in self.phrases:
            word, last, at = -1, 0, padded.find(phrase)
            while at >= 0:
                word += padded.count(b" ", last, at + 1)
                last = at + 1
                found.append((word, label))
                at = padded.find(phrase, last)
        return found

    def fuzzy(self, flat: str) -> list[tuple[int, int, int, Notice]]:
        """(start, end, edits, notice) of every verified notice; of overlapping ones of a label the best."""
        begun: set[tuple[int, int]] = set()
        for end, (length, places) in self.seeds.iter(flat) if self.notices else ():
            for n, offset in places:
                begun.add((n, end + 1 - length - offset))
        hits, padded, known = set(), f" {flat} ", [{} for _ in self.notices]
        for n, start in begun:
            notice = self.notices[n]
            k, stop = notice.edits, start + len(notice.text)
            # A word begins within k characters of the start, and one ends within k of the end.
            if padded.find(" ", max(0, start - k), max(0, start + k + 1)) < 0 or padded.find(" ", max(0, stop - k + 1), max(0, stop + k + 2)) < 0:
                continue
            first, last = max(0, start - k), min(stop + k + 2, len(flat) + 1)
            # What follows a window is no boundary; it is more than a match may take in.
            window = padded[first:last] + BEYOND * (k + 2 if last <= len(flat) else 0)
            if window not in known[n]:
                found = notice.pattern.search(window, 1)
                known[n][window] = found and (sum(found.fuzzy_counts), found.start(), found.end())
            if known[n][window]:
                edits, at, till = known[n][window]
                hits.add((edits, first + at - 1, first + till - 1, n))
        kept: dict[str, list[tuple[int, int, int, Notice]]] = {}
        covered: dict[str, set[int]] = {}
        for edits, start, end, n in sorted(hits, key=lambda h: (h[0], -(h[2] - h[1]), h[1], h[3])):
            label = self.notices[n].label
            taken = covered.setdefault(label, set())
            if taken.isdisjoint(range(start, end)):
                taken.update(range(start, end))
                kept.setdefault(label, []).append((start, end, edits, self.notices[n]))
        return sorted((h for own in kept.values() for h in own), key=lambda h: (h[0], h[1], h[3].label))

    def scan(self, raw: bytes) -> dict:
        words = raw.translate(FLATTEN).split()
        joined = b" ".join(words)
        places = self.places(b" " + joined + b" ")
        flat = joined.decode()
        fuzzy = self.fuzzy(flat)
        base = {label for _, label in places}
        near = [1 - edits / len(notice.text) for _, _, edits, notice in fuzzy]
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min((w for w, _ in places), default=None),
            "last_word": max((w for w, _ in places), default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {h[3].label for h in fuzzy})),
            "score": max([0.0, *near, *([1.0] if places else [])]),
            "spans": self.spans(raw.decode(), flat, fuzzy) if fuzzy else [],
        }

    @staticmethod
    def spans(text: str, flat: str, fuzzy: list[tuple[int, int, int, Notice]]) -> list[dict]:
        """Each notice's first word and its code points in the original text."""
        bounds = [m.span() for m in ORIGINAL_WORD.finditer(text)]
        out, word, last = [], 0, 0
        for start, end, edits, notice in fuzzy:
            word += flat.count(" ", last, start)
            last = start
            final = word + flat.count(" ", start, end)
            out.append({"label": notice.label, "word": word, "start": bounds[word][0], "end": bounds[final][1], "edits": edits})
        return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row for each row of ``docs``.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are on exact
    phrases; ``labels`` has the labels of verified notices too; ``score`` is the
    best likeness of any label found; ``spans`` has the notices with first word,
    code points [start, end) of the original text, and edits.
    """

    def make() -> Measure:
        scanner = Scanner(phrases, notices)

        def measure(texts: Sequence[bytes]) -> list[pa.Array]:
            found = [scanner.scan(t) for t in texts]
            return [pa.array([f[c.name] for f in found], pa_type) for c, pa_type in zip(fields, types)]

        return measure

    fields = [
        *map(long_field, ("n_words", "n_base", "first_word", "last_word")),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", SPAN),
    ]
    span = pa.list_(pa.struct([("label", pa.string()), *((n, pa.int64()) for n in ("word", "start", "end", "edits"))]))
    types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), span]
    return measure_texts(docs, id_col, text_col, make, fields)
