"""Tables: those that the registered queries run on, and others in Spark's file formats."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("csv", "json", "orc", "parquet")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``; any path that Spark's readers open will do."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder, or a temporary one where none is set."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="lexiframe-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, kind: str, path: str) -> DataFrame:
    """``rows`` written to ``path`` in one of ``FORMATS`` and read from there, with the types they had."""
    rows.write.format(kind).save(path)
    return rows.sparkSession.read.schema(rows.schema).format(kind).load(path)
