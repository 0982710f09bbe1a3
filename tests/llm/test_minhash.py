import random
from itertools import combinations

import numpy as np
import pytest

from lexiframe.llm import components, minhash


NUMBER = {}


def shingles(text):
    raw = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    found = {tuple(raw[i : i + 5]) for i in range(len(raw) - 4)} if len(raw) >= 5 else {tuple(raw)} if raw else set()
    return {NUMBER.setdefault(s, len(NUMBER)) for s in found}


def brute(rows):
    """Component of each row: the least id reachable over links of at least 75 in 100."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 175 * len(sets[i] & sets[j]) >= 75 * (len(sets[i]) + len(sets[j])):
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(find(i))) for i, (doc_id, _) in enumerate(rows)]


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, digest string, n int")
    return [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()]


def by_text(rows):
    return sorted(rows, key=str)


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    rows, passage = [], " ".join(f"p{n}" for n in range(60))
    for group in range(25):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(6, 250))]
        for _ in range(draw.randint(1, 12)):
            rows.append(edited(draw, words, draw.randint(0, max(1, len(words) // 30))))
        rows.append(" ".join(words).upper())
        rows.append(passage + " " + " ".join(f"u{draw.randrange(10**6)}" for _ in range(80)))
    rows += ["", None, "one two", "One  two", "one two three four", "one two three four five", " \t\n", rows[0], rows[0]]
    ids = draw.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


def test_classes_against_all_pairs(spark, corpus):
    found = run(spark, corpus)
    assert by_text(r[:3] for r in found) == by_text(brute(corpus))
    assert all(kept == (doc_id == component) for doc_id, _, component, kept in found)


def test_chain_of_links_is_one_class(spark):
    words = [f"w{n}" for n in range(200)]
    rows = []
    for step in range(12):
        rows.append((100 - step, " ".join(words)))
        words[step * 15 : step * 15 + 1] = [f"x{step}"]
        words = words[:-2]
    assert by_text(r[:3] for r in run(spark, rows)) == by_text(brute(rows))


def test_large_group_around_one_text(spark):
    draw = random.Random(8)
    words = [f"w{n}" for n in range(150)]
    rows = [(5000, " ".join(words))] + [(n, edited(draw, words, 3)) for n in range(1, 400)]
    found = run(spark, rows)
    wanted = {d: c for d, _, c in brute(rows)}
    assert np.mean([wanted[d] == c for d, _, c, _ in found]) == 1


def test_large_group_without_the_text_it_was_made_from(spark):
    draw = random.Random(8)
    words = [f"w{n}" for n in range(150)]
    rows = [(n, edited(draw, words, 3)) for n in range(1500)]
    assert by_text(r[:3] for r in run(spark, rows)) == by_text(brute(rows))


@pytest.mark.parametrize(("partitions", "batch"), [(4, 100), (37, 1000)])
def test_classes_do_not_depend_on_partitions_or_batches(spark, partitions, batch):
    draw = random.Random(11)
    words = [f"w{n}" for n in range(150)]
    rows = [(n, edited(draw, words, draw.choice((3, 4, 5, 6, 8)))) for n in range(900)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        assert by_text(r[:3] for r in run(spark, rows)) == by_text(brute(rows))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_every_pair_is_met_when_runs_span_blocks(spark, monkeypatch):
    draw = random.Random(9)
    words = [f"w{n}" for n in range(200)]
    rows = [(n, edited(draw, words, 4)) for n in range(200)]
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    monkeypatch.setattr(minhash, "COMPARED", 64)
    assert by_text(r[:3] for r in run(spark, rows)) == by_text(brute(rows))


def test_forest_connects_what_the_edges_connect():
    draw = np.random.default_rng(3)
    for edges in (0, 30, 300):
        left, right = draw.integers(0, 100, (2, edges))
        kept = minhash.forest(left, right, 100)

        def parts(pairs):
            root = list(range(100))
            for a, b in pairs:
                root = [root[b] if r == root[a] else r for r in root]
            return len(set(root))

        assert parts(zip(left[kept], right[kept])) == parts(zip(left, right)) == 100 - len(kept)


def test_odd_ids_and_empty_table(spark):
    same = "a b c d e f g"
    rows = [(None, same), (7, same), (7, same), (7, "q r s t u v"), (None, None)]
    assert by_text(r[:3] for r in run(spark, rows)) == by_text(brute(rows))
    assert run(spark, []) == []
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id bigint, text string, lang string")
    kept = minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, same), (7, same), (7, "q r s t u v")]
    assert minhash.keep_one_of_each(docs.limit(0)).count() == 0


def test_repeated_and_null_ids_lose_no_row_or_link(spark):
    same, other = "a b c d e f g", "q r s t u v"
    long = [f"w{n}" for n in range(100)]
    one, two = " ".join(long), " ".join(long[:99])

    def kept(rows):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        return sorted(((r.doc_id, r.text) for r in minhash.keep_one_of_each(docs).collect()), key=str)

    assert kept([(3, same), (7, same), (7, other)]) == [(3, same), (7, other)]
    nulls = [(None, same), (None, same)]
    assert kept([*nulls, (7, other), (7, other)]) == sorted([*nulls, (7, other)], key=str)
    assert len(kept([(7, one), (7, two), (7, two)])) == 1
    rows = [(None, one), (4, two), (5, " ".join(long[:98]))]
    assert by_text(r[:3] for r in run(spark, rows)) == by_text(brute(rows))
    bridge = [(1, " ".join(long[:80])), (None, " ".join(long)), (2, " ".join(long[20:]))]
    assert by_text(r[:3] for r in run(spark, bridge)) == by_text(brute(bridge))


def test_very_long_text(spark):
    long = " ".join(f"w{n}" for n in range(60_000))
    assert sorted(run(spark, [(1, long), (2, long + " end")])) == [(1, 59_996, 1, True), (2, 59_997, 1, False)]


def test_estimates_are_near_and_corrected():
    draw = np.random.default_rng(1)
    near, apart = [], []
    for _ in range(60):
        pool = draw.integers(0, 2**63, 500, np.uint64)
        a, b = np.unique(pool[:440]), np.unique(pool[60:])
        one, two = minhash.registers([a]), minhash.registers([b])
        near.append(minhash.estimate(one, two, np.array([len(a)]), np.array([len(b)]))[0])
        other = np.unique(draw.integers(0, 2**63, 440, np.uint64))
        apart.append(minhash.estimate(one, minhash.registers([other]), np.array([len(a)]), np.array([len(other)]))[0])
    assert abs(np.mean(near) - 380 / 500) < 0.02 and abs(np.mean(apart)) < 0.01
    assert 1e-4 < minhash.chance_table()[9, 9] < 1e-2


def test_registers_keep_leading_zeros_and_mantissa():
    minima = np.array([1 << 63, (1 << 63) + (1 << 53), 1 << 40, 1, 0], np.uint64)
    assert minhash.compress(minima).tolist() == [63 << 10, (63 << 10) + 1, 40 << 10, 0, 0]


def test_runs_give_the_same_pairs_however_they_are_cut():
    draw = np.random.default_rng(2)
    n = 300
    key = draw.integers(0, 2, (n, minhash.KEY), np.uint8)
    key[:, 1:] = 0
    key[:, -1] = draw.integers(0, 3, n)
    key[:200, 2] = np.arange(200) // 5
    key = key[np.lexsort(key.T[::-1])]
    digest = np.array([f"{k:016d}".encode() for k in range(n)], "S16")
    size = np.full(n, 100)

    def pairs(step):
        runs, out, named = minhash.RunPairs(), set(), set()
        for at in range(0, n, step):
            a, b, heads = runs.add(key[at : at + step], digest[at : at + step], size[at : at + step])
            out |= set(zip(a.tolist(), b.tolist()))
            named |= set(heads)
        return out, named | set(runs.last_head())

    head = key[:, : minhash.HEAD]
    heads, of, counts = np.unique(head, axis=0, return_inverse=True, return_counts=True)
    short = [np.flatnonzero(of == r) for r in range(len(counts)) if counts[r] <= minhash.NEIGHBOURS + 1]
    wanted = {(digest[i], digest[j]) for rows in short for i, j in combinations(rows, 2)}
    long = {heads[r].tobytes() for r in range(len(counts)) if counts[r] > minhash.NEIGHBOURS + 1}
    assert long
    for step in (n, 50, 7, 1):
        found, named = pairs(step)
        assert wanted <= found and named == long | {head[0].tobytes(), head[-1].tobytes()}


@pytest.mark.parametrize("last", [0, 20, 10_000])
def test_components(spark, monkeypatch, last):
    monkeypatch.setattr(components, "LAST_EDGES", last)
    draw = random.Random(4)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(n, n + 1) for n in range(100, 160)] + [(200, n) for n in range(201, 260)]
    root = {n: n for e in edges for n in e}
    for _ in range(70):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.label for r in components.contract(df).collect()}
    wanted = {n: root[n] for a, b in edges if a != b for n in (a, b)}
    assert found.keys() == wanted.keys() and all(wanted[found[n]] == wanted[n] for n in found)
    assert len(set(found.values())) == len(set(wanted.values()))
    assert components.contract(df.limit(0)).count() == 0
