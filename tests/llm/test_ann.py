import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiframe.llm import ann


def frame(spark, x, extra=()):
    rows = [(n, [float(c) for c in v], 1) for n, v in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank int")


def recall(found, x, queries, k):
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q in queries:
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -score))[:k]
        rows = sorted(got[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(best) + 1))
        assert np.allclose([r.score for r in rows], [score[r.vec_id] for r in rows], rtol=1e-12)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hits, total = hits + len(set(best.tolist()) & {r.vec_id for r in rows}), total + len(best)
    return hits / total


@pytest.mark.parametrize("kind", ["sphere", "lengths", "clusters", "hot"])
def test_recall(spark, kind):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(3000, 24))
    if kind == "clusters":
        x = 5 * draw.normal(size=(30, 24))[draw.integers(0, 30, 3000)] + x
    if kind == "lengths":
        x *= draw.lognormal(0, 0.7, (3000, 1))
    else:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "hot":
        x[:1000] = x[0] + 1e-3 * draw.normal(size=(1000, 24))
    found = ann.nearest(frame(spark, x), F.col("vec_id") % 20 == 0, 10).collect()
    assert recall(found, x, range(0, 3000, 20), 10) >= 0.9


def test_ties_go_to_the_smaller_id(spark):
    x = np.ones((1500, 4))
    found = ann.nearest(frame(spark, x), F.col("vec_id") == 7, 5).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [0, 1, 2, 3, 4]


def test_unusable_and_few_vectors(spark):
    odd = [(20, None, 1), (21, [], 1), (22, [0.0, 0.0], 1), (23, [1.0, None], 1), (24, [float("nan"), 1.0], 1), (25, [float("inf"), 1.0], 1), (26, [1.0, 2.0, 3.0], 1)]
    docs = frame(spark, [[1, 0], [0.5, 0.5], [-1, 0]], odd)
    found = ann.nearest(docs, F.col("vec_id") % 20 == 0, 20).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found] == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]
    assert ann.nearest(docs.limit(0), F.lit(True), 3).count() == 0
    assert ann.nearest(docs.where("vec_id >= 20 AND vec_id < 26"), F.lit(True), 3).count() == 0


def test_repeated_rows_count_once(spark):
    docs = frame(spark, [[1, 0], [0.5, 0.5]], [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1)])
    assert ann.nearest(docs, F.col("vec_id") == 0, 3).count() == 1


@pytest.mark.parametrize("copies", [2, 30])
def test_repeated_rows_push_out_no_neighbour(spark, copies):
    x = np.random.default_rng(6).normal(size=(60, 8))
    docs = frame(spark, x)
    repeated = docs.crossJoin(spark.range(copies).select(F.lit(1))).select(docs.columns)
    found = ann.nearest(repeated, F.col("vec_id") % 20 == 0, 10).collect()
    assert recall(found, x, range(0, 60, 20), 10) == 1


def test_other_vectors_of_the_query_push_out_no_neighbour(spark):
    draw = np.random.default_rng(7)
    x = draw.normal(size=(60, 8))
    extra = [(0, [float(c) for c in 3 * x[0] + 1e-3 * draw.normal(size=8)], 1) for _ in range(30)]
    found = ann.nearest(frame(spark, x, extra), F.col("vec_id") == 0, 10).collect()
    assert len(found) == 10 and all(r.vec_id != 0 for r in found)


def test_lists_are_balanced_and_graph_finds_the_nearest():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(2000, 8))
    x[:700] = x[0] + 1e-4 * draw.normal(size=(700, 8))
    centroids = ann.balanced_centroids(x, 40)
    sizes = np.bincount(ann.squared(x, centroids).argmin(axis=1))
    assert sizes.max() <= 2 * len(x) / 40
    index = ann.Index(8, 1.0, centroids, ann.link(centroids), x, np.zeros((2000, len(centroids)), bool), 1.0)
    found = index.walk(x[::7])
    exact = ann.squared(x[::7], centroids)
    assert (found.argmin(axis=1) == exact.argmin(axis=1)).mean() > 0.95
