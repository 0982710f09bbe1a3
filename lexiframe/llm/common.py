"""What the corpus operators share: text batches, lineage cuts, word tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.session import expose_package

#: Rows and bytes of text handled at once inside a Python worker; Spark bounds the bytes of each Arrow batch itself.
SLICE_ROWS, SLICE_BYTES = 1000, 2 << 20
#: ASCII white space, the separators of words throughout.
WORD = r"[^\x20\x09-\x0D]+"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

Measure = Callable[[list[bytes]], Sequence[pa.Array]]


def binary_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text_column: int | str) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most ``SLICE_ROWS`` rows and, unless a text alone is longer, ``SLICE_BYTES`` of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_pylist()
        first, total = 0, 0
        for at, size in enumerate(sizes):
            if at > first and (at - first >= SLICE_ROWS or total + size > SLICE_BYTES):
                yield batch.slice(first, at - first)
                first, total = at, 0
            total += size
        if first < len(sizes):
            yield batch.slice(first)


def prepared(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches suit whole texts and whose Python workers find this package."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= SLICE_ROWS:
        conf.set(name, str(SLICE_ROWS))
    expose_package(df.sparkSession)
    return df


def measure_texts(docs: DataFrame, id_col: str, text_col: str, make: Callable[[], Measure], fields: Sequence[T.StructField]) -> DataFrame:
    """``id_col`` and, beside it, the columns that ``make()(texts)`` returns for each batch of texts.

    Other columns of ``docs`` are not read. ``make`` runs once in each task,
    so that a measure can keep a cache between batches.
    """
    taken = prepared(docs).select(F.col(id_col), F.col(text_col).cast("string"))
    schema = T.StructType([taken.schema[0], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = make()
        for part in slices(batches, 1):
            columns = [part.column(0), *measure(binary_texts(part.column(1)))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return taken.mapInArrow(run, schema)


def keep_rows(docs: DataFrame, text_col: str, make: Callable[[], Callable[[list[bytes]], Sequence[bool]]]) -> DataFrame:
    """The rows of ``docs``, all columns, whose text ``make()(texts)`` accepts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accept = make()
        for part in slices(batches, text_col):
            yield part.filter(pa.array(accept(binary_texts(part.column(text_col))), pa.bool_()))

    return prepared(docs).mapInArrow(run, docs.schema)


def long_field(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only where none is set, as in tests, a temporary folder is made."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


#: The folder, if any, that ``cut`` writes to until ``scratch`` removes it.
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def cut(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written as a table to the cluster's shared checkpoint folder and read from there.

    A table tells its size, so joins are planned by what is there; a checkpoint
    would carry the estimates of the plan that made it, which multiply with
    every join until a loop's estimates alone take minutes to compute.
    """
    spark = df.sparkSession
    path = f"{folder or _scratch.get() or shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Inside, cuts go to a folder of their own, which is removed at the end; given is the folder of cuts that last longer."""
    outer = _scratch.get() or shared_folder(spark)
    path = f"{outer}/scratch-{uuid.uuid4().hex}"
    token = _scratch.set(path)
    try:
        yield outer
    finally:
        _scratch.reset(token)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark writes to; PySpark has no call for it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def hash_share(id_col: str) -> F.Column:
    """A number in [0, 1) from a hash of the id."""
    return F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 40)) / float(1 << 40)


def hash_sample(rows: DataFrame, id_col: str, most: int, of: int) -> DataFrame:
    """About ``most``, never more, of ``of`` rows, by a hash of the id; only about so many rows are moved."""
    if of > most:
        rows = rows.where(hash_share(id_col) < most * 1.05 / of)
    return rows.orderBy(F.xxhash64(id_col), id_col).limit(most)


def training_row(id_col: str) -> F.Column:
    """True for the two thirds of the ids that a classifier may learn from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 != 1, F.lit(False))
