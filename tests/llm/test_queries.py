"""The registered queries on small tables, against SQL where there is some; and the pipeline against its parts."""

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from lexiframe.llm.queries import catalogue

FOLDER = "/root/testdata/sf0.001"
QUERIES = list(catalogue())
COLUMNS = {
    "op3_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op4_licenses": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op6_pieces": {"doc_id", "n_tokens", "ids_crc32", "n_chars", "round_trip"},
    "op7_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op8_neighbours": {"query_id", "rank", "vec_id", "score"},
    "op9_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "conversations", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("query", QUERIES, ids=lambda q: q.name)
def test_query(spark, duck, query):
    found = query.build(spark, FOLDER)
    rows = found.collect()
    assert rows
    if query.sql is None:
        assert COLUMNS[query.name] <= set(found.columns)
        if "doc_id" in found.columns:
            assert len(rows) == duck.sql("SELECT count(*) FROM documents").fetchall()[0][0]
        return
    columns = sorted(found.columns)
    wanted = duck.sql(query.sql)
    assert columns == sorted(wanted.columns)
    shown = lambda row: tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in row)
    assert sorted(shown(r[c] for c in columns) for r in rows) == sorted(map(shown, wanted.select(*columns).fetchall()))


def test_pieces_round_trip(spark):
    assert all(r.round_trip for r in catalogue().builders()["op6_pieces"](spark, FOLDER).collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        kept = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and kept and kept <= seen
        assert name in ("mixing", "language") or len(kept) < len(seen)
        seen = kept
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()} == seen


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, repeated ids and rows, a text of a megabyte, and columns with names of ours; a row is kept or dropped whole."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    own = [("digest", "string"), ("label", "string"), ("size", "int"), ("doc", "int"), ("id", "int"), ("kept", "boolean")]
    usual = docs.where("length(text) > 400").orderBy("doc_id").limit(60)
    long = usual.agg(F.concat_ws(" ", F.collect_list("text")).alias("text")).select(F.lit(9000).cast("long").alias("doc_id"), F.expr("substring(repeat(text, 20), 1, 1000000)").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    nulls = usual.limit(4).select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"))
    none = nulls.withColumn("text", F.lit(None).cast("string"))
    odd = usual.unionByName(usual.limit(5)).unionByName(long).unionByName(nulls).unionByName(none)
    odd = odd.withColumns({name: F.lit(None).cast(kind) for name, kind in own})
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, before = docs.columns, {(r.doc_id, r.text) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        after = {(r.doc_id, r.text) for r in docs.collect()}
        assert docs.columns == columns and after and after <= before and not any(text is None for _, text in after)
        before = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


#: What SQL can say of queries that have no statement.
PARTS = {
    "op3_toxicity": "SELECT doc_id FROM documents",
    "op4_licenses": r"""
        WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        p AS (SELECT doc_id, w, list_filter(generate_series(1, len(w)), lambda i: w[i] = 'cc' AND w[i + 1] = 'by') AS cc,
                     list_filter(generate_series(1, len(w)), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS gpl,
                     list_filter(generate_series(1, len(w)), lambda i: w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved') AS res FROM t)
        SELECT doc_id, len(w) AS n_words, len(cc) + len(gpl) + len(res) AS n_base, list_min(cc || gpl || res) - 1 AS first_word, list_max(cc || gpl || res) - 1 AS last_word,
               concat_ws(',', CASE WHEN len(cc) > 0 THEN 'cc-by' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(res) > 0 THEN 'reserved' END) AS base_labels FROM p""",
    "op7_language": "SELECT doc_id FROM documents",
    "op9_shards": "SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, 'bytes' AS law FROM documents",
}


@pytest.mark.parametrize("name", PARTS)
def test_parts_match_sql(spark, duck, name):
    wanted = duck.sql(PARTS[name])
    rows = catalogue().builders()[name](spark, FOLDER).select(*wanted.columns).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, wanted.fetchall()))


def test_neighbours_of_the_registered_query(spark, duck):
    """Recall against exact search over the same table."""
    rows = duck.sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = {}
    for r in catalogue().builders()["op8_neighbours"](spark, FOLDER).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for at in np.flatnonzero(ids % 20 == 0):
        score = x @ x[at]
        score[at] = -np.inf
        hits += len(found[ids[at]] & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert len(found) == (ids % 20 == 0).sum() and hits >= 0.9 * 20 * len(found)
