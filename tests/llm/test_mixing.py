import math
from collections import defaultdict

from pyspark.sql import functions as F

from lexiframe.llm import mixing


def frame(spark, sources):
    rows = [(n, "w " * size if size is not None else None, source, "clash") for n, (source, size) in enumerate(sources)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, head string")


def mixed(docs):
    rows = mixing.draws(docs, "doc_id", "text", "source")
    plan = mixing.plan_mix(mixing.cut(rows.drop("doc")))
    return mixing.with_copies(rows, plan).select("doc.doc_id", "source", "size", "source_size", "target", "copies").collect()


def filled(sizes, weights):
    """Targets by sharing and resharing until none is above three times its source."""
    target, free, rest = {}, set(sizes), float(sum(sizes.values()))
    while free:
        share = {s: rest * weights[s] / sum(weights[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        free -= over
    return target


def test_targets_and_taken(spark):
    draw = [("abcdef"[n % 6] if n % 11 else None, (n * 7919) % 211) for n in range(1500)] + [("tiny", 3), ("zzz", 40_000)]
    rows = mixed(frame(spark, draw))
    sizes = defaultdict(int)
    for source, size in draw:
        sizes[source] += size
    order = sorted((s for s in sizes if s is not None)) + [None]
    wanted = filled(sizes, {s: n % 3 + 1 for n, s in enumerate(order)})
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.copies <= 3 and r.source_size == sizes[r.source] and math.isclose(r.target, wanted[r.source])
        taken[r.source] += r.copies * r["size"]
    assert all(abs(taken[s] - wanted[s]) <= 0.02 * wanted[s] + 3 for s in order if s != "zzz")
    assert len(rows) == len(draw)


def test_shares_of_documents_are_even(spark):
    rows = [r for r in mixed(frame(spark, [("ab"[n % 2], 10) for n in range(2000)])) if r.source == "a"]
    due = rows[0].target / rows[0].source_size
    assert abs(sum(r.copies for r in rows) / len(rows) - due) < 0.02
    assert {r.copies for r in rows} == {math.floor(due), math.floor(due) + 1}


def test_odd_tables(spark):
    assert mixed(frame(spark, [])) == []
    assert [r.copies * r["size"] for r in mixed(frame(spark, [("a", None), (None, 0)]))] == [0, 0]
    one = mixed(frame(spark, [("a", 5)]))
    assert [(r.target, r.copies) for r in one] == [(5.0, 1)]


def test_mix_repeats_rows_and_agrees(spark):
    docs = frame(spark, [("abc"[n % 3], n % 50) for n in range(300)])
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    times = lambda: {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert times() == times() == {r.doc_id: r.copies for r in mixed(docs) if r.copies}


def test_hot_source_and_repeated_rows(spark):
    docs = frame(spark, [("hot", 20)] * 500 + [("cold", 20)] * 20)
    docs = docs.withColumn("doc_id", F.col("doc_id") % 100)
    rows = mixed(docs)
    assert len(rows) == 520 and all(r.copies <= 3 for r in rows)


def test_plan_has_no_python(spark):
    plan = mixing.mix(frame(spark, [("a", 5), ("b", 6)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_against_the_statement(spark, tmp_path):
    """Equal rows are one unit, for the closing document too."""
    import duckdb

    from lexiframe.llm.queries import OP5_SQL, op5_mix

    rows = [(i, " ".join(["w"] * (5 + 7 * (i % 10))), f"s{i % 3}") for i in range(10) for _ in range(50)] + [(None, "a b", None), (3, None, "s0")] * 3
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    shown = lambda rows: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert shown(op5_mix(spark, str(tmp_path)).collect()) == shown(duck.sql(OP5_SQL).fetchall())
