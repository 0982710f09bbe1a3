"""The registered queries of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexiframe.llm import langid, toxicity
from lexiframe.llm.ann import nearest
from lexiframe.llm.chat import format_chats, masked_text, read_turns, text_parts
from lexiframe.llm.common import cut, shared_folder
from lexiframe.llm.licenses import scan_licenses
from lexiframe.llm.minhash import near_duplicates
from lexiframe.llm.mixing import draws, plan_mix, with_copies
from lexiframe.llm.pieces import decode_ids, encode_texts, load_pieces
from lexiframe.llm.quality import judge
from lexiframe.llm.shards import shard_documents
from lexiframe.registry import Registry
from lexiframe.sources.tables import table

SHARDS = 8
#: A SentencePiece model file, read on the driver.
PIECES_PATH = "/opt/tokenizers/piece_bpe_32k.model"


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_near_duplicates(spark, d):
    return near_duplicates(table(spark, d, "documents"))


def op2_chat(spark, d):
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    messages = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    chats = format_chats(messages.select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts")))
    turns = read_turns(F.col("formatted"))
    spoken = F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    masked = masked_text(F.col("formatted"), F.col("loss_spans"))
    return chats.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"),
        F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "attachment_tokens",
    )


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op3_toxicity(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, toxicity.learn(docs, table(spark, d, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_pieces(spark, d):
    model = load_pieces(PIECES_PATH)
    decoded = decode_ids(encode_texts(table(spark, d, "documents"), model), model)
    text = F.col("text").cast("binary")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32", F.length("text").cast("long").alias("n_chars"), (F.crc32(text) == F.col("text_crc32")).alias("round_trip"))


def op7_language(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_licenses(spark, d):
    return scan_licenses(table(spark, d, "documents"))


def op5_mix(spark, d):
    rows = cut(draws(table(spark, d, "documents").select("doc_id", "text", "source"), "doc_id", "text", "source").withColumn("doc", F.struct("doc.doc_id")))
    mixed = with_copies(rows, plan_mix(rows))
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_quality(spark, d):
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = judge(table(spark, d, "documents"), measures=measures)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *measures, failed.alias("base_failed"), "kept")


def op8_neighbours(spark, d):
    return nearest(table(spark, d, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, 20)


def op9_shards(spark, d):
    docs, path = table(spark, d, "documents"), f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    placed = shard_documents(docs, (SHARDS - 1, SHARDS), map_path=path)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "map_version")


OP10_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents),
w AS (SELECT k, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM t),
g AS (SELECT k, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY k ORDER BY i)),
c AS (SELECT k, i, count(*) OVER (PARTITION BY k, word, w2, w3) AS n FROM g WHERE w3 IS NOT NULL),
r AS (SELECT k, count(DISTINCT j) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY k),
l AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
s AS (SELECT k, count(*) AS n_words, sum(length(word)) AS word_chars, sum(strlen(word)) AS word_bytes,
             sum(strlen(regexp_replace(word, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g'))) AS letter_bytes FROM w GROUP BY k),
m AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_lines, word_bytes, letter_bytes
      FROM t LEFT JOIN s USING (k) LEFT JOIN r USING (k) LEFT JOIN l USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 100 * letter_bytes < 60 * word_bytes) AS kept
FROM m
"""


OP1_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 75 * (na.n + nb.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""

OP2_SQL = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT AS formatted_chars,
       0::BIGINT AS n_attachments, 0::BIGINT AS attachment_tokens
FROM m GROUP BY conv_id
"""

OP5_SQL = r"""
WITH t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, coalesce(doc_id::VARCHAR, '') AS key,
                  ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
l AS (SELECT *, 3.0::DOUBLE * source_size / weight AS per,
             (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
      FROM w WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT arg_min(level, per) AS share FROM l WHERE level <= per),
g AS (SELECT source, source_size, CASE WHEN per < share THEN 3.0::DOUBLE * source_size ELSE weight * share END AS target FROM l, c),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS due FROM g),
q AS (SELECT *, floor(due)::INT AS whole, due - floor(due) AS f, (due - floor(due)) * source_size AS gap FROM p),
r AS (SELECT t.*, source_size, target, whole, f, gap, CASE WHEN f > 0 THEN u / (1 - u) * (1 - f) / f END AS rank FROM t JOIN q ON t.source IS NOT DISTINCT FROM q.source),
h AS (SELECT *, f > 0 AND gap > 0 AND sum(size) OVER (PARTITION BY source ORDER BY rank, key) <= gap AS first FROM r),
h2 AS (SELECT *, gap - coalesce(sum(size) FILTER (first) OVER (PARTITION BY source), 0) AS gap2 FROM h),
h3 AS (SELECT *, f > 0 AND NOT first AND size > 0 AND size <= gap2 AS may FROM h2),
k AS (SELECT *, may AND sum(CASE WHEN may THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank, key) <= gap2 AS second FROM h3),
k2 AS (SELECT *, gap2 - coalesce(sum(size) FILTER (second) OVER (PARTITION BY source), 0) AS gap3 FROM k),
b AS (SELECT *, CASE WHEN f > 0 AND NOT first AND NOT second AND size > 0 THEN sum(size) OVER (PARTITION BY source, rank, key, size) END AS unit FROM k2),
k3 AS (SELECT *, coalesce(abs(unit - gap3) < gap3, false) AS near FROM b),
z AS (SELECT *, near AND dense_rank() OVER (PARTITION BY source, near ORDER BY abs(unit - gap3), rank, key, size) = 1 AS last FROM k3)
SELECT doc_id, size, source_size, target, size * (whole + (first OR second OR last)::INT)::BIGINT AS taken FROM z
"""


def catalogue() -> Registry:
    r = Registry()
    r.query("op1_near_duplicates", "near duplicates by HyperMinHash", OP1_SQL)(op1_near_duplicates)
    r.query("op2_chat", "chat formatting with typed parts", OP2_SQL)(op2_chat)
    r.query("op3_toxicity", "toxicity by boosted trees")(op3_toxicity)
    r.query("op6_pieces", "SentencePiece encoding and decoding")(op6_pieces)
    r.query("op7_language", "language identification by output codes")(op7_language)
    r.query("op4_licenses", "license scans with bounded edits")(op4_licenses)
    r.query("op5_mix", "mixing sources by Pareto order sampling", OP5_SQL)(op5_mix)
    r.query("op10_quality", "quality rules as a short-circuit cascade", OP10_SQL)(op10_quality)
    r.query("op8_neighbours", "nearest neighbours over balanced posting lists")(op8_neighbours)
    r.query("op9_shards", "sharding through fixed virtual slots")(op9_shards)
    return r
