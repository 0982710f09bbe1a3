"""From raw documents to token ids: quality rules, language, near duplicates, mixing, pieces.

Every stage is a function of (spark, docs, sf_dir). All but the last return
documents with the columns they came with; the last returns token ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lexiframe.llm import langid
from lexiframe.llm.common import remove, shared_folder
from lexiframe.llm.minhash import keep_one_of_each
from lexiframe.llm.mixing import mix
from lexiframe.llm.pieces import encode_texts, load_pieces
from lexiframe.llm.quality import keep_clean
from lexiframe.llm.queries import PIECES_PATH


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_clean(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one language, as judged by a model that learns from this stage's input."""
    return langid.keep_identified(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id and token ids of every document of the mix."""
    return encode_texts(docs, load_pieces(PIECES_PATH)).select("doc_id", "ids")


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("pieces", pieces),
]
#: Classifiers and hashing of shingles have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over ``documents``; what the others return is written to the shared folder and read from there.

    Only the folder that the result is read from stays.
    """
    place, done = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}", None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
        if done:
            remove(spark, f"{place}/{done}")
        done = name
    return STAGES[-1][1](spark, docs, sf_dir)
