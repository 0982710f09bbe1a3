"""SentencePiece encoding and decoding by batched Viterbi.

Texts are cut into units (a run of spaces and what follows it) that no piece
crosses. Units not met before are encoded in batches: those of equal length
advance together, one code point a step. Hashes of all substrings that end at
the step are looked up among the sorted keys of the pieces, and the maximum
over them leaves a back-pointer.

For a unigram model the maximum is over summed scores. A BPE model has merge
priorities, not scores that add up; its result is the one sequence of pieces
of which every two neighbours would stay apart if merged on their own. So a
piece may follow another, or not: a step adds zero or minus infinity, and for
every prefix exactly one piece survives. Pieces of equal priority (runs of
spaces) leave that open, and units that hold one are merged one pair at a time.

Code points outside the vocabulary become byte pieces, or the unknown piece.
A null text is an empty one and has no ids. Very long texts are cut between
units; a very long unit is cut into overlapping windows that advance together
(BPE), or takes a step for each of its code points (unigram). Repeated rows are encoded alike,
an empty table gives an empty result, and columns other than the id and the
text are ignored. The model file is read on the driver.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexiframe.llm.common import Measure, long_field, measure_texts, prepared

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2
#: How much worse than the worst piece an unknown code point is in a unigram model.
UNKNOWN_PENALTY = 10.0
BASE, LENGTH_KEY = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bits of a key's head.
HEAD_BITS = 20
HEAD_SHIFT = np.uint64(64 - HEAD_BITS)
NEVER = np.iinfo(np.int32).max
#: In a BPE model, units longer than twice a window are cut into windows, which begin ``WINDOW_STEP`` apart and overlap by ``OVERLAP`` or more.
WINDOW_STEP, OVERLAP = 240, 64
#: Words and units remembered by a worker, characters cut into them at once, and cells of a batch's substring table.
CACHED, STRETCH, CELLS = 700_000, 1 << 19, 1 << 19


def powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    for k in range(n):
        out[k + 1 : k + 2] = out[k : k + 1] * BASE
    return out


def code_points(joined: str, words: int) -> np.ndarray:
    """One row of code points for each of so many words of one length."""
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(words, -1)


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for k in range(codes.shape[1]):
        out[:, k + 1] = out[:, k] * BASE + codes[:, k] + np.uint64(1)
    return out


def merge_pairs(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Symbols after merging the pair of the best rank, the leftmost of equals, until none is left; and the last pair merged."""
    parts: list[str | None] = list(symbols)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(parts):
            whole = parts[i] + parts[after[i]]
            if whole in rank:
                heapq.heappush(heap, (rank[whole], i, whole))

    for i in range(len(parts) - 1):
        offer(i)
    last = None
    while heap:
        _, i, whole = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else len(parts)
        if j >= len(parts) or parts[i] + parts[j] != whole:
            continue
        last = (parts[i], parts[j])
        parts[i], parts[j] = whole, None
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None], last


class KeyTable:
    """Sorted 64-bit keys with values, and for each head of a key the place where keys with that head begin."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two entries share a key")
        heads = (self.keys >> HEAD_SHIFT).astype(np.int64)
        self.begin = np.searchsorted(heads, np.arange((1 << HEAD_BITS) + 1)).astype(np.int32)
        self.used = self.begin[1:] > self.begin[:-1]
        self.run = int((self.begin[1:] - self.begin[:-1]).max(initial=0))

    def probe(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``key`` the keys of the table stand, in order, and their values."""
        place = np.flatnonzero(self.used.take(self.head(key)))
        asked = key.take(place)
        at = self.begin.take(self.head(asked))
        same = self.keys.take(at) == asked
        for _ in range(1, self.run):
            other = np.flatnonzero(~same)
            at[other] = np.minimum(at[other] + 1, len(self.keys) - 1)
            same[other] = self.keys[at[other]] == asked[other]
        hit = np.flatnonzero(same)
        return place.take(hit), self.values.take(at.take(hit))

    @staticmethod
    def head(key: np.ndarray) -> np.ndarray:
        return (key >> HEAD_SHIFT).view(np.int64)


@dataclass
class Pieces:
    """A model's pieces and the tables that the batched search probes."""

    pieces: list[str]
    kinds: list[int]
    scores: list[float]
    bpe: bool
    dummy_prefix: bool
    squeeze: bool
    ids: dict[str, int] = field(init=False)
    rank: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        normal = [i for i, kind in enumerate(self.kinds) if kind == NORMAL]
        if {*self.kinds} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the model has user-defined or unused pieces, which are not supported")
        self.ids = {self.pieces[i]: i for i in normal}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, kind in enumerate(self.kinds) if kind == BYTE}
        self.cuttable = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.unit = self.unit_pattern()
        self.longest = max(map(len, self.ids), default=1)
        self.powers = powers(self.longest)
        self.score = np.array([*self.scores, 0.0], np.float32)
        self.unknown_score = np.float32(min((self.scores[i] for i in normal), default=0.0) - UNKNOWN_PENALTY)
        self.fingerprint = zlib.crc32("\n".join(self.pieces).encode()) ^ zlib.crc32(self.score.tobytes())
        by_length: dict[int, list[int]] = defaultdict(list)
        for i in normal:
            by_length[len(self.pieces[i])].append(i)
        keys, key_ids = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for length, own in by_length.items():
            keys.append(self.keys_of(prefix_hashes(code_points("".join([self.pieces[i] for i in own]), len(own)))[:, -1], np.array([length])))
            key_ids.append(np.array(own))
        self.table = KeyTable(np.concatenate(keys), np.concatenate(key_ids))
        self.shown = [self.piece_bytes(i) for i in range(len(self.pieces))]
        self.rank = {}
        self.lengths = np.array([len(p) if kind == NORMAL else 1 for p, kind in zip(self.pieces, self.kinds)])
        self.verdicts: np.ndarray | None = None
        if self.bpe:
            self.prepare_merges(normal)

    def unit_pattern(self) -> re.Pattern:
        """Spaces and what follows them, but not a mark that no piece has after a letter or digit."""
        joined = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        after_word = {pair[1] for pair in joined if re.match(r"\w", pair[0])}
        marks = {c for p in self.ids for c in p if not re.match(r"[\w\s]", c) and c != SPACE} - after_word
        cut = rf" *\w++(?=[{re.escape(''.join(sorted(marks)))}])|" if marks else ""
        return re.compile(cut + r" *[^ \n]+|\n| +")

    @staticmethod
    def keys_of(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return (hashes ^ (hashes >> np.uint64(29))) * BASE + lengths.astype(np.uint64) * LENGTH_KEY

    def piece_bytes(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kinds[i] == CONTROL:
            return b""
        return " ⁇ ".encode() if self.kinds[i] == UNKNOWN else self.pieces[i].replace(SPACE, " ").encode()

    def prepare_merges(self, normal: list[int]) -> None:
        """For each piece the pieces at its left and right edge while it is being merged, and which pairs merge at all.

        ``open`` are pieces for which that is no guide: of equal priority, or
        merged from a piece of lower priority. Pieces that their own merging
        does not give can never result.
        """
        ordered = sorted(normal, key=lambda i: (-self.scores[i], i))
        self.rank = {self.pieces[i]: at for at, i in enumerate(ordered)}
        shared = defaultdict(list)
        for i in normal:
            shared[self.scores[i]].append(i)
        tied = {i for own in shared.values() if len(own) > 1 for i in own if len(self.pieces[i]) > 1}
        self.tied_rank = {p: (min(self.rank[self.pieces[k]] for k in shared[self.scores[i]]) if i in tied else self.rank[p]) for p, i in self.ids.items()}
        n = len(self.pieces) + 1
        self.open, self.result = np.zeros(n, bool), np.zeros(n, bool)
        self.result[self.unknown] = True
        halves: dict[int, tuple[int, int]] = {}
        for i in sorted(normal, key=lambda k: len(self.pieces[k])):
            piece = self.pieces[i]
            merged, last = merge_pairs(list(piece), self.tied_rank)
            self.result[i] = len(merged) == 1
            if last is not None and self.result[i]:
                a, b = self.ids[last[0]], self.ids[last[1]]
                halves[i] = (a, b)
                late = max(self.rank[x] if len(x) > 1 else -1 for x in last)
                self.open[i] = late >= self.rank[piece] or self.open[a] or self.open[b]
            self.open[i] |= i in tied
        self.edge = {}
        for side in (0, 1):
            spines = []
            for i in range(n):
                spine = [i]
                while spine[-1] in halves:
                    spine.append(halves[spine[-1]][side])
                spines.append(spine[::-1])
            depth = max(map(len, spines))
            at = np.array([s + [s[-1]] * (depth - len(s)) for s in spines])
            made = np.array([[self.rank[self.pieces[k]] for k in s[1:]] + [NEVER] * (depth - len(s) + 1) for s in spines])
            self.edge[side] = (at, made)
        keys, ranks = [], []
        for i in normal:
            piece = self.pieces[i]
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    ranks.append(self.rank[piece])
        self.merges = KeyTable(self.mixed(np.array(keys, np.int64)), np.array(ranks, np.int64))

    @staticmethod
    def mixed(pair: np.ndarray) -> np.ndarray:
        """A pair's number spread over 64 bits; no two become equal."""
        return pair.astype(np.uint64) * BASE

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces stays two pieces when its code points are merged from scratch.

        Pairs met before are remembered: each has one place, where the newest stays.
        """
        if self.verdicts is None:
            self.verdicts = np.full(1 << HEAD_BITS, -1, np.int64)
        pair = left * (len(self.pieces) + 1) + right
        place = KeyTable.head(self.mixed(pair))
        known = self.verdicts.take(place)
        new = np.flatnonzero(known >> 1 != pair)
        if len(new):
            known[new] = pair[new] * 2 + self.stay_apart(left[new], right[new])
            self.verdicts[place[new]] = known[new]
        return known % 2 == 1

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The verdicts of ``apart``, by merging.

        Both sides are merged step by step in order of priority; the pair is
        spoilt if the two edge pieces would merge before either changes.
        """
        right_edge, left_edge = self.edge[1], self.edge[0]
        n, fine = len(self.pieces) + 1, self.result[left] & self.result[right]
        rows = np.flatnonzero(fine)
        i, j = np.zeros(len(rows), int), np.zeros(len(rows), int)
        while len(rows):
            a, b = left[rows], right[rows]
            next_a, next_b = right_edge[1][a, i], left_edge[1][b, j]
            across = np.full(len(rows), NEVER)
            merging, ranks = self.merges.probe(self.mixed(right_edge[0][a, i] * n + left_edge[0][b, j]))
            across[merging] = ranks
            spoilt = (across < next_a) & (across <= next_b)
            fine[rows[spoilt]] = False
            go = ~spoilt & ((next_a < NEVER) | (next_b < NEVER))
            first = next_a <= next_b
            i, j, rows = (i + first)[go], (j + ~first)[go], rows[go]
        return fine

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words of one length: piece ids at the right of each row, how many, and which rows need ``spelled``.

        No ids for words that have to be merged one pair at a time.
        """
        n, length = codes.shape
        hashes = prefix_hashes(codes)
        best = np.full((n, length + 1), -np.inf, np.float32)
        best[:, 0] = 0
        piece, back = np.full((n, length + 1), len(self.pieces)), np.zeros((n, length + 1), int)
        hard = np.zeros(n, bool)
        rows = np.arange(n)
        for end in range(1, length + 1):
            span = min(end, self.longest)
            sizes = np.arange(span, 0, -1)
            sub = hashes[:, end, None] - hashes[:, end - span : end] * self.powers[sizes]
            place, ids = self.table.probe(self.keys_of(sub, sizes).ravel())
            row, column = np.divmod(place, span)
            known = np.zeros(n, bool)
            known[row[column == span - 1]] = True
            if self.bpe:
                hard[row[self.open[ids]]] = True
                fits = self.result[ids] & (best[row, end - span + column] == 0)
                follows = np.flatnonzero(fits & (column > span - end))
                fits[follows] = self.apart(piece[row[follows], end - span + column[follows]], ids[follows])
                row, column, ids = row[fits], column[fits], ids[fits]
            total, named = np.full((n, span), -np.inf, np.float32), np.full((n, span), self.unknown)
            total[row, column] = best[row, end - span + column] + (0 if self.bpe else self.score[ids])
            named[row, column] = ids
            total[~known, -1] = best[~known, end - 1] + (0 if self.bpe else self.unknown_score)
            choice = total.argmax(axis=1)
            best[:, end], piece[:, end], back[:, end] = total[rows, choice], named[rows, choice], sizes[choice]
        hard |= ~np.isfinite(best[:, length])
        out = np.full((n, length), -1, np.int32)
        count, at = np.zeros(n, int), np.full(n, length)
        live = rows[~hard]
        while len(live):
            out[live, length - 1 - count[live]] = piece[live, at[live]]
            count[live] += 1
            at[live] -= back[live, at[live]]
            live = live[at[live] > 0]
        return out, count, hard | (out == self.unknown).any(axis=1)

    def spelled(self, word: str, ids: Sequence[int] | None) -> bytes:
        """Ids with bytes, if there are byte pieces, for unknown code points."""
        out, at = [], 0
        for i in self.merged(word) if ids is None else ids:
            if i != self.unknown:
                out.append(i)
                at += len(self.pieces[i])
                continue
            if self.bytes:
                out += [self.bytes[b] for b in word[at].encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
            at += 1
        return np.array(out, np.int32).tobytes()

    def merged(self, word: str) -> list[int]:
        return [self.ids.get(s, self.unknown) for s in merge_pairs(list(word), self.tied_rank)[0]]

    def encode_units(self, units: Sequence[str]) -> dict[str, bytes]:
        """Ids, as the bytes of 32-bit numbers, of each unit."""
        by_length: dict[int, list[str]] = defaultdict(list)
        for unit in units:
            by_length[len(unit)].append(unit)
        out = {}
        window = WINDOW_STEP + max(OVERLAP, 2 * self.longest)
        for length in [n for n in by_length if self.bpe and n > 2 * window]:
            for unit in by_length.pop(length):
                word = unit.replace(" ", SPACE)
                out[unit] = self.spelled(word, self.joined(word, window))
        for length, own in by_length.items():
            step = max(1, CELLS // max(1, length * self.longest))
            for first in range(0, len(own), step):
                batch = own[first : first + step]
                ids, count, odd = self.viterbi(code_points("".join(batch).replace(" ", SPACE), len(batch)))
                for unit, row, n, special in zip(batch, ids, count.tolist(), odd.tolist()):
                    out[unit] = self.spelled(unit.replace(" ", SPACE), row[length - n :] if n else None) if special else row[length - n :].tobytes()
        return out

    def joined(self, word: str, window: int) -> list[int] | None:
        """Piece ids of a long word from those of windows of it; none if it has to be merged one pair at a time.

        Windows that agree on a piece are joined there. Every two neighbours in
        the result are neighbours in a window, so they stay apart, and only one
        sequence is such. Where windows agree on none, pairs are merged.
        """
        codes = code_points(word, 1)[0]
        starts = [*range(0, len(codes) - window, WINDOW_STEP), len(codes) - window]
        rows = max(1, CELLS // (window * self.longest))
        ids, at = np.empty(0, np.int32), np.empty(0, int)
        out: list[int] = []
        for first in range(0, len(starts), rows):
            own = starts[first : first + rows]
            found, count, _ = self.viterbi(np.stack([codes[s : s + window] for s in own]))
            if not count.all():
                return None
            for start, row, n in zip(own, found, count.tolist()):
                new = row[window - n :]
                new_at = start + np.concatenate([[0], np.cumsum(self.lengths[new[:-1]])])
                if start:
                    mine, theirs = np.intersect1d(at, new_at, assume_unique=True, return_indices=True)[1:]
                    same = np.flatnonzero(ids[mine] == new[theirs])
                    if not len(same):
                        return None
                    out += ids[: mine[same[0]]].tolist()
                    new, new_at = new[theirs[same[0]] :], new_at[theirs[same[0]] :]
                ids, at = new, new_at
        return out + ids.tolist()

    def normalised(self, text: str) -> str:
        text = text.replace(SPACE, " ")
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return text

    def encode(self, texts: Sequence[str], cache: dict[str, bytes]) -> list[np.ndarray]:
        """The ids of whole texts; ``cache`` has what was met so far, and what all the texts lack is encoded together."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        held = 0
        for k, text in enumerate(map(self.normalised, texts)):
            if text and self.dummy_prefix:
                text = " " + text
            for part in stretches(text) if self.cuttable else [text] * bool(text):
                waiting.append((k, self.words(part)))
                held += len(part)
                if held > 4 * STRETCH:
                    self.flush(waiting, out, cache)
                    held = 0
        self.flush(waiting, out, cache)
        found = [np.frombuffer(b"".join(parts), np.int32) for parts in out]
        return found if self.bytes else [self.collapsed(ids) for ids in found]

    def words(self, part: str) -> list[str]:
        """The keys under which the units of a stretch are cached, or words of one unit and more, where these are split by single spaces."""
        if not self.cuttable:
            return [" " + part]
        if part[0] == " " and "  " not in part:
            return part[1:].split(" ")
        return [key_of(unit) for unit in self.unit.findall(part)]

    def collapsed(self, ids: np.ndarray) -> np.ndarray:
        """Unknown pieces that touch, as one."""
        unknown = ids == self.unknown
        return ids[~(unknown & np.concatenate([[False], unknown[:-1]]))] if len(ids) else ids

    def flush(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]], cache: dict[str, bytes]) -> None:
        needed = set().union(*(keys for _, keys in waiting))
        fresh = needed.difference(cache)
        if len(cache) + len(fresh) > CACHED:
            recent = {key: cache[key] for key in needed if key in cache}
            cache.clear()
            cache.update(recent)
        split: dict[str, list[str]] = {}
        for key in fresh:
            own = [key_of(unit) for unit in self.unit.findall(unit_of(key))] if key[:1] != " " else [key]
            if own != [key]:
                split[key] = own
        units = fresh.difference(split).union(*split.values()).difference(cache)
        encoded = self.encode_units(list(map(unit_of, units)))
        cache.update((key, encoded[unit_of(key)]) for key in units)
        for word, keys in split.items():
            cache[word] = b"".join([cache[key] for key in keys])
        for k, keys in waiting:
            out[k].append(b"".join([cache[key] for key in keys]))
        waiting.clear()
        if not self.cuttable:
            cache.clear()

    def decode(self, ids: Sequence[int]) -> str:
        text = b"".join([self.shown[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


def key_of(unit: str) -> str:
    """A unit after one space without that space, any other after a space more than it has."""
    return unit[1:] if unit[:1] == " " and unit[1:2] != " " else " " + unit


def unit_of(key: str) -> str:
    return key[1:] if key[:1] == " " else " " + key


def stretches(text: str) -> Iterator[str]:
    """The text in parts of about ``STRETCH`` characters, cut before spaces, where no unit is cut."""
    at = 0
    while at < len(text):
        end = at + STRETCH
        while end < len(text) and not (text[end] == " " and text[end - 1] != " "):
            end += 1
        yield text[at:end]
        at = end


def load_pieces(path: str) -> Pieces:
    """A SentencePiece model file without a normalisation table."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return from_proto(model)


def from_proto(model) -> Pieces:
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    if normalizer.precompiled_charsmap or trainer.treat_whitespace_as_suffix or not normalizer.escape_whitespaces:
        raise ValueError("the model normalises texts in a way that is not supported")
    if trainer.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    kinds = [p.type for p in model.pieces]
    if not trainer.byte_fallback:
        kinds = [CONTROL if k == BYTE else k for k in kinds]
    return Pieces([p.piece for p in model.pieces], kinds, [p.score for p in model.pieces], trainer.model_type == BPE, normalizer.add_dummy_prefix, normalizer.remove_extra_whitespaces)


_caches: dict[int, dict[str, bytes]] = {}


def unit_cache(model: Pieces) -> dict[str, bytes]:
    """The worker's cache for a model, which outlives a task."""
    if model.fingerprint not in _caches:
        _caches.clear()
        _caches[model.fingerprint] = {}
    return _caches[model.fingerprint]


def encode_texts(docs: DataFrame, model: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id, ``ids``, ``ids_crc32`` (of 32-bit little-endian ids) and ``text_crc32`` (of the normalised text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Measure:
        model = shared.value
        cache = unit_cache(model)

        def measure(texts: Sequence[bytes]) -> list[pa.Array]:
            decoded = [raw.decode() for raw in texts]
            found = model.encode(decoded, cache)
            plain = [zlib.crc32(model.normalised(text).encode()) for text in decoded]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.empty(0, np.int32)])))
            return [ids, pa.array([zlib.crc32(f.tobytes()) for f in found], pa.int64()), pa.array(plain, pa.int64())]

        return measure

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), long_field("ids_crc32"), long_field("text_crc32")]
    return measure_texts(docs, id_col, text_col, make, fields)


def decode_ids(encoded: DataFrame, model: Pieces, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the decoded text in ``text_col``; null ids decode to an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    rows = encoded.drop(text_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_col)
            texts = [shared.value.decode(lists[k].values.to_numpy().tolist() if lists[k].is_valid else ()) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return prepared(rows).mapInArrow(run, schema)

