"""Approximate nearest neighbours by inner product, over balanced posting lists.

Vectors get one more component that makes all of them equally long; then the
largest inner product is the least Euclidean distance. A bounded sample is
halved again and again into parts of equal size; then the fullest part is split
and the emptiest given up until none has much more than its share. Each part is
a posting list, so lists grow in number with the rows, up to one for each eight
vectors of the sample, and a vector between parts is written to more than one. To find lists, a
beam search walks a graph that links each centroid to its neighbours, and
keeps the lists whose distance is within a ratio of the nearest one's. The
ratio is fitted on the sample so that nearly all true neighbours are reached.

Long lists, and lists that many queries ask for, are cut into blocks, so the
work on a group is bounded however rows are spread. A group returns only what
beats the query's k-th best score against the sample, a bound that any answer
must meet.

Vectors that are null, all zero, of another length than most, or have null or
non-finite components take no part, as queries or candidates. Rows that repeat
an id and a vector count once; an id with two vectors is two candidates, and as
a query it has an answer for each. Ties go to the smaller id. A vector is one
row however long it is, but a block of them has to fit in a task. An empty table gives
an empty result. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm.common import cut, hash_sample, prepared

#: Vectors that the index is fitted on, and queries among them that the ratio is fitted on.
SAMPLE_ROWS, TUNING_QUERIES = 16_384, 256
#: Vectors for each list, sampled ones for each at least, lists that a vector is written to, and how much farther the others may be.
LIST_ROWS, LIST_SAMPLE, REPLICAS, CLOSURE = 400, 8, 2, 1.15
#: A part of the sample is split if it has this many times its share.
FULLEST = 1.4
#: Share of the sample's true neighbours that the fitted ratio must reach.
AIM = 0.98
#: Links of a centroid in the graph: to its nearest, and to others at random.
NEAR_LINKS, FAR_LINKS = 12, 4
#: Vectors and queries of a group at most, about.
BLOCK_ROWS, CHUNK_QUERIES = 1024, 512
ROUNDING = 1e-9
FLOOR_SPARE = 3
#: Centroids that a walk keeps in view at least, and rows that advance together.
BEAM, WALK_ROWS = 16, 512
#: Vectors, and queries, of a batch that are put in lists at once.
LIST_BATCH, QUERY_BATCH = 1000, 200
TINY = 1e-300


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``a`` to every row of ``b``."""
    return np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None], 0)


def halves(x: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """True for the half of the rows that lies towards one of two centres."""
    one, two = x[draw.choice(len(x), 2, replace=False)]
    for _ in range(5):
        side = x @ (one - two)
        upper = side > np.median(side)
        if upper.all() or not upper.any():
            break
        one, two = x[upper].mean(axis=0), x[~upper].mean(axis=0)
    order = np.argsort(x @ (one - two), kind="stable")
    upper = np.zeros(len(x), bool)
    upper[order[len(x) // 2 :]] = True
    return upper


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 1) -> np.ndarray:
    """Centres of near equal parts: the largest is halved until there are enough, then the fullest is split for the emptiest.

    Equal vectors can't be split, so parts that a split doesn't lessen are left.
    """
    draw = np.random.default_rng(seed)
    parts = [np.arange(len(x))]
    while len(parts) < lists:
        largest = max(range(len(parts)), key=lambda k: len(parts[k]))
        rows = parts.pop(largest)
        upper = halves(x[rows], draw)
        parts += [rows[upper], rows[~upper]]
    centroids = np.stack([x[rows].mean(axis=0) for rows in parts])
    owner, left = squared(x, centroids).argmin(axis=1), np.zeros(lists, bool)
    for _ in range(4 * lists):
        counts = np.bincount(owner, minlength=lists)
        full, spare = int(np.where(left, 0, counts).argmax()), int(counts.argmin())
        if counts[full] <= FULLEST * len(x) / lists or full == spare:
            break
        rows = np.flatnonzero(owner == full)
        upper = halves(x[rows], draw)
        centroids[full], centroids[spare] = x[rows[~upper]].mean(axis=0), x[rows[upper]].mean(axis=0)
        changed = squared(x, centroids[[full, spare]])
        moved = np.isin(owner, (full, spare)) | (changed.min(axis=1) < ((x - centroids[owner]) ** 2).sum(axis=1))
        owner[moved] = squared(x[moved], centroids).argmin(axis=1)
        left[full] = (owner == full).sum() >= counts[full] or (owner == spare).sum() >= counts[full]
    return centroids[np.unique(owner)]


def link(centroids: np.ndarray, seed: int = 2) -> np.ndarray:
    """For each centroid its neighbours in the graph; the next in a ring keeps the graph connected."""
    n = len(centroids)
    near = np.argsort(squared(centroids, centroids), axis=1)[:, 1 : NEAR_LINKS + 1]
    far = np.random.default_rng(seed).integers(0, n, (n, FAR_LINKS))
    return np.concatenate([near, far, (np.arange(n)[:, None] + 1) % n], axis=1)


@dataclass(frozen=True)
class Index:
    """Centroids of lengthened vectors, their graph, the sample, and which lists hold each vector of it."""

    dimension: int
    longest: float
    centroids: np.ndarray
    graph: np.ndarray
    sample: np.ndarray
    holds: np.ndarray
    ratio: float
    #: Rows of the sample by id: a query's own are no answers.
    own: dict[object, list[int]] = field(default_factory=dict)

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.longest**2 - (x**2).sum(1), 0))[:, None]])

    def walk(self, x: np.ndarray, ratio: float = 0.0, width: int = BEAM) -> np.ndarray:
        """Distances to the centroids found, infinite for others; all rows of ``x`` advance together.

        A row stops when its nearest centroid that is not yet expanded is
        farther than its ``width``-th nearest and than ``ratio`` times the nearest.
        """
        parts = [self.walk_part(x[at : at + WALK_ROWS], ratio, width) for at in range(0, len(x), WALK_ROWS)]
        return np.concatenate([np.empty((0, len(self.centroids))), *parts])

    def walk_part(self, x: np.ndarray, ratio: float, width: int) -> np.ndarray:
        lists = len(self.centroids)
        width = min(width, lists)
        known = np.full((len(x), lists), np.inf)
        done = np.zeros((len(x), lists), bool)
        norms = (x**2).sum(1)
        for entry in {0, lists // 2}:
            known[:, entry] = np.sqrt(np.maximum(norms - 2 * x @ self.centroids[entry] + (self.centroids[entry] ** 2).sum(), 0))
        rows = np.arange(len(x))
        while len(rows):
            waiting = np.where(done[rows], np.inf, known[rows])
            at = waiting.argmin(axis=1)
            next_distance = waiting[np.arange(len(rows)), at]
            bound = np.maximum(np.partition(known[rows], width - 1, axis=1)[:, width - 1], ratio * np.maximum(known[rows].min(axis=1), TINY))
            go = np.isfinite(next_distance) & (next_distance <= bound)
            rows, at = rows[go], at[go]
            done[rows, at] = True
            near = self.graph[at]
            away = self.centroids[near] - x[rows][:, None]
            known[rows[:, None], near] = np.sqrt((away**2).sum(axis=2))
        return known

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for each list that a vector is written to: the nearest, and others hardly farther."""
        found = self.walk(self.lengthened(x))
        order = np.argsort(found, axis=1, kind="stable")[:, :REPLICAS]
        distance = np.take_along_axis(found, order, axis=1)
        keep = distance <= np.maximum(CLOSURE * distance[:, :1], distance[:, :1])
        return np.nonzero(keep)[0], order[keep]

    def lists_for(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for each list that a query asks: those within the ratio of the nearest."""
        found = self.walk(self.prepared(q), self.ratio)
        return np.nonzero(found <= self.ratio * np.maximum(found.min(axis=1, keepdims=True), TINY))

    def prepared(self, q: np.ndarray) -> np.ndarray:
        """Queries, all made as long as the longest vector, which doesn't change the order of their answers."""
        return np.hstack([q * (self.longest / np.sqrt((q**2).sum(1)))[:, None], np.zeros((len(q), 1))])

    def floor(self, q: np.ndarray, ids: list, asked: np.ndarray, k: int) -> np.ndarray:
        """A score that the k-th best answer from the ``asked`` lists reaches.

        It is taken from the sample's vectors of other ids in those lists, a
        few places further down.
        """
        score = np.where(asked.astype(np.float32) @ self.holds.T.astype(np.float32) > 0, q @ self.sample.T, -np.inf)
        for row, name in enumerate(ids):
            score[row, self.own.get(name, [])] = -np.inf
        place = len(self.sample) - k - FLOOR_SPARE
        return np.partition(score, place, axis=1)[:, place] if place >= 0 else np.full(len(q), -np.inf)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the vectors that can take part, each once, before their lengths are compared.

    Cuts by rank count rows, so a repeated row would push out another answer.
    """
    stored = vectors.schema[vector_col].dataType.simpleString()
    v = F.col(vector_col) if stored == "array<float>" else F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull()).where(sound).distinct()


def matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, dimension)


def fit(vectors: DataFrame, k: int, sample_rows: int = SAMPLE_ROWS) -> Index | None:
    """The index of ``id, v`` rows, from a sample by a hash of the id; None if there are no vectors.

    The driver gets one row for the counts and ``sample_rows`` vectors.
    """
    lengths = vectors.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda t, c: t + c.cast("double") * c)).alias("longest")
    )
    most = lengths.orderBy(F.desc("n"), "d").limit(1).collect()
    if not most:
        return None
    d, n, longest = most[0].d, most[0].n, float(np.sqrt(most[0].longest)) * (1 + ROUNDING)
    chosen = hash_sample(vectors.where(F.size("v") == d), "id", sample_rows, n)
    taken = chosen.collect()
    sample = np.array([row.v for row in taken], float)
    own: dict[object, list[int]] = {}
    for at, row in enumerate(taken):
        own.setdefault(row.id, []).append(at)
    lists = int(max(1, min(n // LIST_ROWS, len(sample) // LIST_SAMPLE)))
    lengthened = np.hstack([sample, np.sqrt(np.maximum(longest**2 - (sample**2).sum(1), 0))[:, None]])
    centroids = balanced_centroids(lengthened, lists)
    index = Index(d, longest, centroids, link(centroids), sample, np.zeros((len(sample), len(centroids)), bool), np.inf, own)
    index.holds[index.lists_of(sample)] = True
    return replace(index, ratio=fitted_ratio(index, k))


def fitted_ratio(index: Index, k: int) -> float:
    """The least ratio at which ``AIM`` of the sample's true neighbours lie in a list that is asked."""
    x = index.sample
    queries = np.random.default_rng(3).choice(len(x), min(TUNING_QUERIES, len(x)), replace=False)
    score = x[queries] @ x.T
    score[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, : min(k, len(x))]
    found = index.walk(index.prepared(x[queries]), np.inf)
    relative = found / np.maximum(found.min(axis=1, keepdims=True), TINY)
    needed = np.where(index.holds[best], relative[:, None, :], np.inf).min(axis=2)
    return float(np.quantile(needed, AIM)) * (1 + ROUNDING)


def in_lists(rows: DataFrame, index: Index, k: int, queries: bool) -> DataFrame:
    """``list, id, v, floor`` for each list that a vector is written to, or that a query asks."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            size = QUERY_BATCH if queries else LIST_BATCH
            for at in range(0, whole.num_rows, size):
                batch = whole.slice(at, size)
                x = matrix(batch.column(1), shared.value.dimension)
                row, place = shared.value.lists_for(x) if queries else shared.value.lists_of(x)
                floor = np.zeros(len(x))
                if queries:
                    asked = np.zeros((len(x), len(shared.value.centroids)), bool)
                    asked[row, place] = True
                    floor = shared.value.floor(x, batch.column(0).to_pylist(), asked, k)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), *taken.columns, pa.array(floor[row])], names=["list", "id", "v", "floor"])

    fitting = rows.where(F.size("v") == index.dimension)
    return prepared(fitting).mapInArrow(run, f"list int, id {rows.schema['id'].dataType.simpleString()}, v {rows.schema['v'].dataType.simpleString()}, floor double")


def blocks(rows: DataFrame, own: dict[int, int], others: dict[int, int], own_name: str, other_name: str) -> DataFrame:
    """``rows`` dealt to one of their list's blocks, and copied for each block of the other side."""
    spark = rows.sparkSession
    counts = spark.createDataFrame([(k, own.get(k, 1), others.get(k, 1)) for k in {*own, *others}] or [(0, 1, 1)], "list int, own int, others int")
    dealt = rows.join(F.broadcast(counts), "list")
    number = F.pmod(F.xxhash64("id"), F.col("own")).cast("int").alias(own_name)
    return dealt.select("list", number, F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias(other_name), "id", "v", "floor")


def nearest(vectors: DataFrame, queries: F.Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id, score`` for the ``k`` nearest found of every vector for which ``queries`` holds."""
    asked = usable(vectors.where(queries), id_col, vector_col)
    rows = usable(vectors, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    index = fit(rows, k)
    if index is None:
        return rows.sparkSession.createDataFrame([], f"query_id {kind}, rank int, {id_col} {kind}, score double")
    stored, sought = cut(in_lists(rows, index, k, False)), cut(in_lists(asked, index, k, True))
    count = lambda df, most: {r.list: -(-r["n"] // most) for r in df.groupBy("list").agg(F.count("*").alias("n")).collect()}
    blocks_in, chunks_in = count(stored, BLOCK_ROWS), count(sought, CHUNK_QUERIES)
    left = blocks(stored, blocks_in, chunks_in, "block", "chunk").groupBy("list", "block", "chunk")
    right = blocks(sought, chunks_in, blocks_in, "chunk", "block").groupBy("list", "block", "chunk")
    dimension, longest = index.dimension, index.longest

    def compare(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        if not ours.num_rows or not theirs.num_rows:
            return pa.table({"query_id": theirs["id"][:0], "id": ours["id"][:0], "score": pa.array([], pa.float64())})
        x, q = matrix(ours["v"], dimension), matrix(theirs["v"], dimension)
        names = pa.concat_arrays([t["id"].combine_chunks() for t in (theirs, ours)]).dictionary_encode("encode").indices.to_numpy()
        own = names[: len(q), None] == names[None, len(q) :]
        rough = np.where(own, -np.inf, q @ x.T)
        least = theirs["floor"].to_numpy()
        if len(x) > k:
            least = np.maximum(least, np.partition(rough, len(x) - k, axis=1)[:, len(x) - k])
        slack = ROUNDING * longest * np.sqrt((q**2).sum(1))
        row, at = np.nonzero(~own & (rough >= (least - slack)[:, None]))
        score = (q[row] * x[at]).sum(axis=1)
        asked_ids, ids = theirs["id"].take(pa.array(row)), ours["id"].take(pa.array(at))
        return pa.table({"query_id": asked_ids, "id": ids, "score": pa.array(score)})

    found = left.cogroup(right).applyInArrow(compare, f"query_id {kind}, id {kind}, score double")
    other = found.distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = other.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
