"""Near-duplicate documents by HyperMinHash.

A document's set are its distinct shingles of five words (A-Z lower-cased,
words between ASCII white space; fewer words are one shingle). Documents are
linked where the sets' Jaccard index is at least 0.75, and a class is what
links connect.

1. Documents with equal sets are one node, named by a digest of the set.
2. A node's sketch has one register for each of 128 buckets. A bucket is a
   hash function, not a slice of one: short texts would leave most slices
   empty. A register keeps the leading-zero count and the ten bits after the
   leading one of the bucket's least hash value.
3. Bands of four compressed registers become rows, sorted over the cluster by
   band and by the node's profile, one byte of each band's hash. Within a
   short run of equal registers, each row is paired with all others. In a long
   run it is paired with those of its batch whose profiles agree most with its
   own, and with the row whose profile agrees most with what the run mostly
   has: among copies of one text, each edited elsewhere, that is the text. So a
   long run costs a few pairs a row. Runs are never gathered; batches and the
   sort can cut them anywhere. These pairs are only a start, so runs that were
   long, or at the edge of a task, are named for step 6.
4. A pair's Jaccard index is estimated from equal registers, less the equality
   expected by chance for sets of their sizes; unlikely pairs end here.
5. Pairs are confirmed on the full sets: first the best partner of each node;
   then, after joining up components, every pair that still spans two.
6. Of the runs named in step 3, those that still hold more than one component
   are gone over exactly. The rows outside a run's largest component, in
   blocks, meet all rows of the run, in blocks; every pair between components
   is estimated in the first of its bands. What likely pairs connect is a
   group, and the full sets of a group are compared in the same way. Only
   spanning forests leave a block, so a large group costs time but few rows,
   and rows that joined up in step 5 are not compared again with each other.

A pair at the threshold shares no band with a chance of 5e-6.

A null or empty text has no shingles and is a class of its own. A null id
never names a class. Repeated rows are copies. A very long text is one set like
any other, built in one task; batches are cut by bytes. Ties between partners
go to the larger digest and change no class. An empty table gives an empty
result. Only the id and the text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm.common import LOWER, Measure, cut, long_field, measure_texts, scratch
from lexiframe.llm.components import contract

SHINGLE, PERCENT = 5, 75
REGISTERS, BAND = 128, 4
BANDS = REGISTERS // BAND
#: Bytes of a row's key: band number, its registers, and the profile.
HEAD = 1 + 2 * BAND
KEY = HEAD + BANDS
#: Rows after it that a row of a short run is paired with; likeliest partners of a row of a long run, and its central rows.
NEIGHBOURS, PARTNERS, PIVOTS = 6, 3, 1
#: Rows and shingles of a block, about, and pairs of small groups whose registers are compared at once.
BLOCK_ROWS, BLOCK_SHINGLES, COMPARED = 1024, 1 << 20, 1 << 14
#: Pairs estimated this many standard deviations under the threshold are dropped.
SLACK = 5.0
#: Up to so many ids are broadcast to pick the texts whose sets are needed.
BROADCAST_IDS = 200_000
CACHED_WORDS = 100_000
SEEDS = np.random.default_rng(20_240_229).integers(1, 2**63, (2, REGISTERS), np.uint64)
SALT, MULTIPLIER = SEEDS[0], SEEDS[1] | np.uint64(1)
MIX = np.random.default_rng(7).integers(1, 2**63, SHINGLE, np.uint64) | np.uint64(1)


class WordHashes(dict):
    """Hash of a word, remembered; forgets everything when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def finish(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: Sequence[bytes], hashes: WordHashes) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    split = [t.translate(LOWER).split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter((h for words in split for h in map(hashes.__getitem__, words)), np.uint64, int(sizes.sum()))
    rows = max(0, len(flat) - SHINGLE + 1)
    sums = np.zeros(rows, np.uint64)
    for k in range(SHINGLE):
        sums += flat[k : k + rows] * MIX[k]
    sums = finish(sums)
    out, at = [], 0
    for n in sizes.tolist():
        if n >= SHINGLE:
            out.append(np.unique(sums[at : at + n - SHINGLE + 1]))
        elif n:
            out.append(finish((flat[at : at + n] * MIX[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(flat[:0])
        at += n
    return out


def registers(sets: Sequence[np.ndarray], chunk: int = 40_000) -> np.ndarray:
    """One row of compressed registers for each set, none of which is empty."""
    out = np.empty((len(sets), REGISTERS), np.uint16)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= chunk):
            total += len(sets[last])
            last += 1
        values = np.concatenate(sets[first:last])
        starts = np.cumsum([0, *map(len, sets[first : last - 1])])
        scratch = np.empty_like(values)
        for j in range(REGISTERS):
            np.bitwise_xor(values, SALT[j], out=scratch)
            np.multiply(scratch, MULTIPLIER[j], out=scratch)
            out[first:last, j] = compress(np.minimum.reduceat(scratch, starts))
        first = last
    return out


def profile(registers: np.ndarray) -> np.ndarray:
    """One byte for each band of each row of registers."""
    return (finish(np.ascontiguousarray(registers).view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def compress(minima: np.ndarray) -> np.ndarray:
    """6 bits for the leading zeros and the 10 bits after the leading one: the head of a float's bits."""
    bits = minima.astype(np.float64).view(np.uint64) >> np.uint64(42)
    return (np.maximum(bits, np.uint64(1023 << 10)) - np.uint64(1023 << 10)).clip(0, 65535).astype(np.uint16)


@lru_cache(1)
def chance_table(powers: int = 24) -> np.ndarray:
    """How often registers of disjoint sets of 2**i and 2**j shingles are equal."""
    edges = np.concatenate([[0.0], (2.0 ** -np.arange(48, 0, -1)[:, None] * (1 + np.arange(1024) / 1024)).ravel(), [1.0]])
    survive = np.stack([np.exp(2.0**p * np.log1p(-np.minimum(edges, 1 - 1e-16))) for p in range(powers)])
    mass = survive[:, :-1] - survive[:, 1:]
    return mass @ mass.T


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard index of sketched sets, corrected for registers that are equal by chance."""
    equal, chance = (a == b).mean(axis=1), chance_table()[size_class(n_a), size_class(n_b)]
    return (equal - chance) / (1 - chance)


def size_class(n: np.ndarray) -> np.ndarray:
    """Row and column of ``chance_table`` for sets of ``n`` shingles."""
    return np.log2(np.maximum(n, 1)).round().astype(int).clip(0, len(chance_table()) - 1)


def needed_registers() -> np.ndarray:
    """Equal registers at which a pair is likely, by the size classes of its sets."""
    chance = chance_table()
    return np.ceil(REGISTERS * (least_estimate() * (1 - chance) + chance) - 1e-9).astype(np.uint8)


def text_mark(text: str) -> F.Column:
    """A hash of a text, as ``sketch`` has it; a null text is empty."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n_shingles, digest, registers, profile`` and ``mark``, which is ``text_mark``; the others after the count are null for an empty set."""

    def make() -> Measure:
        hashes = WordHashes()

        def measure(texts: Sequence[bytes]) -> list[pa.Array]:
            sets = shingle_sets(texts, hashes)
            full = [s for s in sets if len(s)]
            sketched = registers(full) if full else np.empty((0, REGISTERS), np.uint16)
            rows, profiles = iter(sketched), iter(profile(sketched))
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([next(profiles).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array(np.array([xxhash.xxh64_intdigest(t, seed=42) for t in texts], np.uint64).view(np.int64)),
            ]

        return measure

    fields = [long_field("n_shingles"), T.StructField("digest", T.BinaryType()), T.StructField("registers", T.BinaryType()), T.StructField("profile", T.BinaryType()), long_field("mark")]
    return measure_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", make, fields)


def full_sets(docs: DataFrame) -> DataFrame:
    """``digest, shingles`` of (id, text) rows with a set, each digest once."""

    def make() -> Measure:
        hashes = WordHashes()

        def measure(texts: Sequence[bytes]) -> list[pa.Array]:
            sets = shingle_sets(texts, hashes)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            return [pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]

        return measure

    fields = [T.StructField("digest", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))]
    sets = measure_texts(docs, "id", "text", make, fields).where("digest IS NOT NULL")
    return sets.groupBy("digest").agg(F.first("shingles").alias("shingles"))


def band_rows(nodes: DataFrame) -> DataFrame:
    """``key, digest, n`` for each band: its number, its registers, and the profile from that band on and round."""
    bands = nodes.select(
        "digest", F.col("n_shingles").alias("n"), "registers", F.concat("profile", "profile").alias("ring"),
        F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"),
    )
    number = F.unhex(F.lpad(F.hex("band"), 2, "0"))
    key = F.concat(number, F.substring("registers", F.col("band") * 2 * BAND + 1, F.lit(2 * BAND)), F.substring("ring", F.col("band") + 1, F.lit(BANDS)))
    return bands.select(key.alias("key"), "digest", "n")


class RunPairs:
    """Pairs of rows of equal bands in a sorted stream; holds a few rows of the last batch."""

    def __init__(self) -> None:
        self.key = np.empty((0, KEY), np.uint8)
        self.digest, self.n = np.empty(0, "S16"), np.empty(0, np.int64)
        self.pivots: np.ndarray = np.empty(0, np.int64)
        #: Rows of the last run so far.
        self.seen = 0

    def add(self, key: np.ndarray, digest: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Digests of the pairs that the new rows take part in, and the heads of runs of which not every pair is among them.

        Rows held over are the last run's pivots, then its last neighbours. The
        first and the last run of a stream may go on elsewhere, so a stream's
        first head is named here and its last by ``last_head``.
        """
        old, first = len(self.n), not len(self.n)
        key, digest, n = np.concatenate([self.key, key]), np.concatenate([self.digest, digest]), np.concatenate([self.n, n])
        head = key[:, :HEAD]
        run = np.concatenate([[0], np.cumsum((head[1:] != head[:-1]).any(axis=1))])
        lefts, rights = [], []
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        ends = np.append(starts[1:], len(n))
        rows = ends - starts
        rows[0] += self.seen - old if ends[0] > old else 0
        long = rows > NEIGHBOURS + 1
        named = [head[at].tobytes() for at in starts[long | (first & (starts == 0))].tolist()]
        reach = np.where(long, 0, NEIGHBOURS)[run]
        for step in range(1, NEIGHBOURS + 1):
            i = np.arange(max(0, old - step), len(n) - step)
            i = i[(run[i] == run[i + step]) & (reach[i] >= step)]
            lefts.append(i)
            rights.append(i + step)
        last = np.empty(0, np.int64)
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            profiles = key[start:end, HEAD:]
            central = start + self.central(profiles)
            fresh = np.arange(max(start, old), end)
            lefts.append(np.repeat(fresh, min(PARTNERS, end - start)))
            rights.append(start + self.partners(profiles, fresh - start).ravel())
            for p in {*central.tolist(), *(range(len(self.pivots)) if start == 0 else ())}:
                lefts.append(np.full(len(fresh), p))
                rights.append(fresh)
            if end == len(n):
                last = central
        tail = np.arange(max(starts[-1], len(n) - NEIGHBOURS), len(n))
        keep = np.concatenate([last, tail[~np.isin(tail, last)]]).astype(np.int64)
        self.key, self.digest, self.n, self.pivots, self.seen = key[keep], digest[keep], n[keep], last, int(rows[-1])
        left, right = np.concatenate(lefts), np.concatenate(rights)
        left, right = np.divmod(np.unique(np.minimum(left, right) * len(n) + np.maximum(left, right)), len(n))
        small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
        fits = (100 * small >= PERCENT * large) & (digest[left] != digest[right])
        a, b = digest[left[fits]], digest[right[fits]]
        return np.where(a < b, a, b), np.where(a < b, b, a), named

    def last_head(self) -> list[bytes]:
        return [self.key[-1, :HEAD].tobytes()] if len(self.n) else []

    @staticmethod
    def partners(profiles: np.ndarray, of: np.ndarray) -> np.ndarray:
        """For each row of ``of`` the other rows whose profiles agree most with its own."""
        agree = np.zeros((len(of), len(profiles)), np.int8)
        for column in profiles.T:
            agree += column[of][:, None] == column
        agree[np.arange(len(of)), of] = -1
        few = min(PARTNERS, len(profiles))
        return np.argpartition(-agree, few - 1, axis=1)[:, :few]

    @staticmethod
    def central(profiles: np.ndarray) -> np.ndarray:
        """The rows that agree most with the bytes most of the run has."""
        agree = np.zeros(len(profiles), np.int64)
        for column in profiles.T:
            agree += column == np.bincount(column, minlength=256).argmax()
        return np.argsort(-agree, kind="stable")[:PIVOTS]


def fixed(column: pa.Array, width: int) -> np.ndarray:
    """The bytes of a binary column whose values are all ``width`` long."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, width)


def digests(values: np.ndarray) -> pa.Array:
    """An "S16" array as binary, with the zero bytes at the end that numpy would not show."""
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(values), [None, pa.py_buffer(values.tobytes())]).cast(pa.binary())


def met_in_bands(nodes: DataFrame, partitions: int) -> DataFrame:
    """``a, b``: digests of nodes that meet in a band, a before b, each pair once; and, with null for b, heads of runs that hold more pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = RunPairs()
        for batch in batches:
            if batch.num_rows:
                digest = np.ascontiguousarray(fixed(batch.column(1), 16)).view("S16").ravel()
                key = fixed(batch.column(0), KEY)
                a, b, named = pairs.add(key, digest, batch.column(2).to_numpy())
                for at in range(0, len(a), 50_000):
                    part = [digests(x[at : at + 50_000]) for x in (a, b)]
                    yield pa.RecordBatch.from_arrays(part, names=["a", "b"])
                yield heads(named)
        yield heads(pairs.last_head())

    def heads(named: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(named, pa.binary()), pa.nulls(len(named), pa.binary())], names=["a", "b"])

    ordered = band_rows(nodes).repartitionByRange(partitions, "key").sortWithinPartitions("key", "digest")
    return ordered.mapInArrow(run, "a binary, b binary").distinct()


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, jaccard`` of the pairs whose estimate is not far below the threshold."""
    least = least_estimate()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (fixed(batch.column(c), 2 * REGISTERS).view(np.uint16) for c in ("r_a", "r_b"))
            about = estimate(one, two, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(about)], names=["a", "b", "jaccard"])
            yield out.filter(pa.array(about >= least))

    side = lambda s: nodes.select(F.col("digest").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a binary, b binary, jaccard double")


def least_estimate() -> float:
    return PERCENT / 100 - SLACK * float(np.sqrt(PERCENT / 100 * (1 - PERCENT / 100) / REGISTERS))


def with_labels(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``nodes`` with the ``label`` of their component; a node without a link is one of its own."""
    return nodes.join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn("label", F.coalesce("label", "digest"))


def dealt(rows: DataFrame, size: Column) -> DataFrame:
    """``rows`` (run, digest, label) of the runs with more than one label, dealt into blocks ``i, j``.

    As ``side`` 0, rows without the label that most of their run have, copied
    for each block of side 1; as side 1 all rows, copied for each block of side
    0. ``size`` is the part of a block that a row takes up.
    """
    labels = rows.groupBy("run", F.xxhash64("label").alias("part")).agg(F.sum(size).alias("size"), F.count("*").alias("n"))
    runs = labels.groupBy("run").agg(F.max(F.struct("n", "part", "size")).alias("most"), F.sum("size").alias("size"), F.count("*").alias("parts"))
    blocks = lambda part: F.greatest(F.ceil(part), F.lit(1)).cast("int")
    runs = cut(runs.where("parts > 1").select("run", "most.part", blocks(F.col("size") - F.col("most.size")).alias("minor"), blocks(F.col("size")).alias("all")))
    named = rows.join(runs, "run")
    place = lambda blocks: F.pmod(F.xxhash64("digest", "run"), F.col(blocks)).cast("int")
    each = lambda blocks: F.sequence(F.lit(0), F.col(blocks) - 1)
    to = lambda side, i, j: F.struct(F.lit(side).alias("side"), i.alias("i"), j.alias("j"))
    outside = F.transform(F.when(F.xxhash64("label") != F.col("part"), each("all")).otherwise(F.array().cast("array<int>")), lambda j: to(0, place("minor"), j))
    everyone = F.transform(each("minor"), lambda i: to(1, i, place("all")))
    copied = named.withColumn("to", F.explode(F.concat(outside, everyone)))
    return copied.select(*rows.columns, "to.side", "to.i", "to.j")


def open_members(nodes: DataFrame, labels: DataFrame, runs: DataFrame) -> DataFrame:
    """``run, i, j, side, band, digest, label, n, registers``: rows of the ``runs`` with more than one component, dealt into blocks."""
    named = with_labels(nodes, labels).select("digest", "label", F.col("n_shingles").alias("n"), "registers")
    heads = named.select("digest", "label", "registers", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    run = F.xxhash64(F.concat(F.unhex(F.lpad(F.hex("band"), 2, "0")), F.substring("registers", F.col("band") * 2 * BAND + 1, F.lit(2 * BAND))))
    wanted = cut(runs.select(F.xxhash64("a").alias("run")).distinct())
    held = cut(heads.select(run.alias("run"), "band", "digest", "label").join(wanted, "run"))
    return dealt(held, F.lit(1 / BLOCK_ROWS)).drop("label").join(named, "digest").select("run", "i", "j", "side", "band", "digest", "label", "n", "registers")


def forest(left: np.ndarray, right: np.ndarray, nodes: int) -> np.ndarray:
    """Which of the edges make a spanning forest of a graph."""
    part, edge, kept = np.arange(nodes), np.arange(len(left)), [np.empty(0, np.int64)]
    while True:
        a, b = part[left[edge]], part[right[edge]]
        edge, a, b = edge[a != b], a[a != b], b[a != b]
        if not len(edge):
            return np.concatenate(kept)
        first = np.full(nodes, len(left))
        np.minimum.at(first, a, edge)
        np.minimum.at(first, b, edge)
        own = np.flatnonzero(first < len(left))
        kept.append(np.unique(first[own]))
        to = np.arange(nodes)
        to[own] = part[left[first[own]]] + part[right[first[own]]] - own
        own = own[(to[to[own]] == own) & (own < to[own])]
        to[own] = own
        while (to[to] != to).any():
            to = to[to]
        part = to[part]


class Blocks:
    """Rows of one Arrow table, sorted by group; a group is a block of each side of a run."""

    def __init__(self, table: pa.Table) -> None:
        run, i, j, self.side = (table[c].to_numpy() for c in ("run", "i", "j", "side"))
        self.digest, label = (np.ascontiguousarray(fixed(table[c], 16)).view("S16").ravel() for c in ("digest", "label"))
        self.labels, self.label = np.unique(label, return_inverse=True)
        new = (run[1:] != run[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new])).tolist()
        self.groups = list(zip(starts, [*starts[1:], len(run)]))

    def sides(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        side = self.side[start:end]
        return start + np.flatnonzero(side == 0), start + np.flatnonzero(side == 1)


class Likely(Blocks):
    """Digests that likely pairs between components connect."""

    def __init__(self, table: pa.Table) -> None:
        super().__init__(table)
        self.band, self.n = table["band"].to_numpy(), table["n"].to_numpy()
        self.registers = fixed(table["registers"], 2 * REGISTERS).view(np.uint16)
        self.bands = self.registers.view(np.uint64)
        self.needed, self.power = needed_registers(), size_class(self.n)

    def listed(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likely ones of some pairs that share a band and no earlier one."""
        small, large = np.minimum(self.n[left], self.n[right]), np.maximum(self.n[left], self.n[right])
        fits = (self.label[left] != self.label[right]) & (100 * small >= PERCENT * large)
        left, right = left[fits], right[fits]
        earlier = np.arange(BANDS) < self.band[left][:, None]
        fresh = ~((self.bands[left] == self.bands[right]) & earlier).any(axis=1)
        left, right = left[fresh], right[fresh]
        likely = (self.registers[left] == self.registers[right]).sum(axis=1) >= self.needed[self.power[left], self.power[right]]
        return left[likely], right[likely]

    def crossed(self, ours: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likely ones of all pairs of two blocks of a run."""
        cross = lambda test, values: test(values[ours][:, None], values[theirs][None])
        fits = cross(np.not_equal, self.label)
        fits &= cross(lambda a, b: (100 * a >= PERCENT * b) & (100 * b >= PERCENT * a), self.n)
        for k in range(self.band[ours[0]]):
            fits &= cross(np.not_equal, np.ascontiguousarray(self.bands[:, k]))
        ours, theirs, fits = ours[rows := fits.any(axis=1)], theirs[columns := fits.any(axis=0)], fits[rows][:, columns]
        equal = np.zeros(fits.shape, np.uint8)
        for k in range(REGISTERS if len(ours) else 0):
            equal += cross(np.equal, np.ascontiguousarray(self.registers[:, k])).view(np.uint8)
        a, b = np.nonzero(fits & (equal >= self.needed[self.power[ours][:, None], self.power[theirs][None]]))
        return ours[a], theirs[b]

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        few: list[tuple[np.ndarray, np.ndarray]] = []
        for start, end in self.groups:
            ours, theirs = self.sides(start, end)
            if len(ours) * len(theirs) > COMPARED:
                yield self.joined(*self.crossed(ours, theirs))
            elif len(ours):
                few.append((np.repeat(ours, len(theirs)), np.tile(theirs, len(ours))))
                if sum(len(x) for x, _ in few) > COMPARED:
                    yield self.joined(*self.listed(*map(np.concatenate, zip(*few))))
                    few = []
        if few:
            yield self.joined(*self.listed(*map(np.concatenate, zip(*few))))

    def joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        used, ends = np.unique([left, right], return_inverse=True)
        left, right = ends.reshape(2, -1)
        kept = forest(left, right, len(used))
        return self.digest[used[left[kept]]], self.digest[used[right[kept]]]


class Alike(Blocks):
    """Labels of components that have rows whose full sets are alike enough."""

    def __init__(self, table: pa.Table) -> None:
        super().__init__(table)
        sets = table["shingles"].combine_chunks()
        self.n = np.diff(sets.offsets.to_numpy())
        values, self.flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        self.first = np.append(0, np.cumsum(self.n))
        self.mark = np.zeros(len(values), bool)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for start, end in self.groups:
            ours, theirs = self.sides(start, end)
            if not len(ours) or not len(theirs):
                continue
            flat = np.concatenate([self.flat[self.first[r] : self.first[r + 1]] for r in theirs])
            at, lefts, rights = np.append(0, np.cumsum(self.n[theirs])[:-1]), [], []
            for r in ours:
                own = self.flat[self.first[r] : self.first[r + 1]]
                self.mark[own] = True
                common = np.add.reduceat(self.mark[flat], at, dtype=np.int64)
                self.mark[own] = False
                near = (self.label[theirs] != self.label[r]) & (100 * common >= PERCENT * (self.n[theirs] + self.n[r] - common))
                rights.append(np.unique(self.label[theirs[near]]))
                lefts.append(np.full(len(rights[-1]), self.label[r]))
            left, right = np.concatenate(lefts), np.concatenate(rights)
            kept = forest(left, right, len(self.labels))
            yield self.labels[left[kept]], self.labels[right[kept]]


def in_blocks(rows: DataFrame, partitions: int, kind: type[Likely] | type[Alike]) -> DataFrame:
    """``a, b``, each once: the links that ``kind`` finds in each group of ``rows``. A group, that is two blocks, is held at once."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """The rows again, cut only between groups."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                key = [batch.column(c).to_numpy() for c in range(3)]
                change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
                if held and any(held[-1].column(c)[-1].as_py() != key[c][0] for c in range(3)):
                    yield pa.Table.from_batches(held)
                    held = []
                if len(change):
                    yield pa.Table.from_batches([*held, batch.slice(0, change[-1])])
                    held, batch = [], batch.slice(change[-1])
                held.append(batch)
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            for one, two in kind(table).links():
                a, b = np.where(one < two, one, two), np.where(one < two, two, one)
                yield pa.RecordBatch.from_arrays([digests(a), digests(b)], names=["a", "b"])

    ordered = rows.repartition(partitions, "run", "i", "j").sortWithinPartitions("run", "i", "j")
    return ordered.mapInArrow(run, "a binary, b binary").distinct()


def alike_members(groups: DataFrame, sets: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``run, i, j, side, digest, label, shingles`` of the nodes of each group, dealt into blocks."""
    sized = nodes.select("digest", "n_shingles").join(groups.select(F.col("node").alias("digest"), F.xxhash64("label").alias("run")), "digest")
    members = cut(with_labels(sized, labels))
    size = F.greatest(F.lit(1 / BLOCK_ROWS), F.col("n_shingles") / BLOCK_SHINGLES)
    return dealt(members, size).join(sets, "digest").select("run", "i", "j", "side", "digest", "label", "shingles")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are alike enough."""
    side = lambda s: sets.select(F.col("digest").alias(s), F.col("shingles").alias(f"s_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - common
    return both.where(100 * common >= PERCENT * union).select("a", "b")


def best_partners(pairs: DataFrame) -> DataFrame:
    """For each node the pair with its likeliest partner."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "jaccard"))
    best = both.groupBy("a").agg(F.max(F.struct("jaccard", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def spanning(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs between components, with ``c_a, c_b``, the labels of their ends."""
    side = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"c_{s}"))
    known = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    named = known.select("a", "b", F.coalesce("c_a", "a").alias("c_a"), F.coalesce("c_b", "b").alias("c_b"))
    return named.where("c_a != c_b")


def sets_of(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The full sets of all ends of the pairs."""
    ends = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    ids = cut(nodes.join(ends, "digest", "left_semi").select(F.col("id").alias("wanted")))
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return cut(full_sets(docs.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")))


def relabelled(labels: DataFrame, links: DataFrame, left: str, right: str) -> DataFrame:
    """``labels`` after joining the components that are linked."""
    bridges = contract(links, left, right)
    moved = bridges.select(F.col("node").alias("label"), F.col("label").alias("root"))
    joined = labels.join(moved, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    alone = bridges.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return cut(joined.unionByName(alone))


def node_labels(docs: DataFrame, nodes: DataFrame, partitions: int) -> DataFrame:
    """``node, label`` for every node with a confirmed link."""
    with scratch(docs.sparkSession) as lasting:
        return cut(linked(docs, nodes, partitions), lasting)


def linked(docs: DataFrame, nodes: DataFrame, partitions: int) -> DataFrame:
    """``node_labels``, in tables that may be removed."""
    met = cut(met_in_bands(nodes, partitions))
    pairs = cut(likely(met.where("b IS NOT NULL"), nodes))
    sets = sets_of(docs, nodes, pairs)
    labels = contract(confirmed(best_partners(pairs), sets))
    open_pairs = cut(spanning(pairs, labels))
    second = confirmed(open_pairs.select("a", "b"), sets)
    labels = relabelled(labels, open_pairs.join(second, ["a", "b"], "left_semi"), "c_a", "c_b")
    unmet = cut(in_blocks(open_members(nodes, labels, met.where("b IS NULL")), partitions, Likely))
    if unmet.isEmpty():
        return labels
    members = alike_members(contract(unmet), sets_of(docs, nodes, unmet), nodes, labels)
    return relabelled(labels, in_blocks(members, partitions, Alike), "a", "b")


def judged_rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``id, n_shingles, digest, mark, component_id, kept`` of each row, and the labels of the digests that have links."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(sketch(texts, "id", "text"))
    grouped = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("registers").alias("registers"), F.first("profile").alias("profile"), F.first("n_shingles").alias("n_shingles"))
    nodes = cut(grouped)
    labels = node_labels(texts, nodes, partitions)
    member = nodes.join(labels.withColumnRenamed("node", "digest"), "digest", "left").select("digest", "id", "copies", F.coalesce("label", "digest").alias("label"))
    member = cut(member)
    named = cut(member.groupBy("label").agg(F.min("id").alias("component_id")))
    many = member.join(named, "label").where((F.col("copies") > 1) | ~F.col("component_id").eqNullSafe(F.col("id"))).select("digest", "component_id")
    out = rows.drop("registers", "profile").join(many, "digest", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))), labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id, ``n_shingles``, ``component_id`` (least id of the class) and ``kept``."""
    judged, _ = judged_rows(docs, id_col, text_col)
    return judged.select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id; rows without an id all stay.

    Rows are told apart by id and text. Where the smallest id has several rows
    of the class, one text of them is chosen, by hash, and one of its rows.
    """
    judged, labels = judged_rows(docs, id_col, text_col)
    judged = cut(with_labels(judged.where("id IS NOT NULL AND digest IS NOT NULL").select("id", "mark", "digest", "kept"), labels))
    chosen = cut(judged.where("kept").groupBy("label", "id").agg(F.min("mark").alias("mark"), F.count("*").alias("rows")).where("rows > 1").drop("rows"))
    others = judged.where("kept").join(chosen.withColumnRenamed("mark", "first"), ["label", "id"]).where("mark != first")
    key = lambda rows: rows.select(F.col("id").alias("key_id"), F.col("mark").alias("key_mark")).distinct()
    same = (F.col(id_col) == F.col("key_id")) & (text_mark(text_col) == F.col("key_mark"))
    out = docs.join(key(judged.where("NOT kept").select("id", "mark").union(others.select("id", "mark"))), same, "left_anti")
    if chosen.isEmpty():
        return out
    once = out.join(key(chosen), same, "left_semi").dropDuplicates([id_col, text_col])
    return out.join(key(chosen), same, "left_anti").unionByName(once)
