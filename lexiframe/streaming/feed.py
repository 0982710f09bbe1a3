"""The change feed: an assignment log read as a stream.

Streams are run until they have read all there is, and the result is written
to a folder that all executors share; a caller gets that table. Each batch
writes to a folder of its own number, so that a batch that is run again after a
failure replaces what it wrote before. Timestamps without a zone are taken as
UTC, since watermarks need instants.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lexiframe.sources.tables import work_folder


def change_feed(spark: SparkSession, path: str, time_col: str, files_per_batch: int = 100) -> DataFrame:
    """The Parquet log at ``path``, a file or a folder, as a stream with ``time_col`` as an instant."""
    schema = spark.read.parquet(path).schema
    exactly = f"{path[:-1]}[{path[-1]}]"  # a pattern, which a stream needs to read one file, that nothing else matches
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(exactly)
    return stream.withColumn(time_col, F.col(time_col).cast("timestamp"))


def put_batch(batch: DataFrame, epoch: int, folder: str) -> None:
    """Write a batch in place of what the same batch may have written before."""
    batch.write.mode("overwrite").parquet(f"{folder}/table/epoch={epoch}")


def run_to_end(changes: DataFrame, name: str, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    """The table that a stream leaves behind: all emitted rows in append mode, the last full result in complete mode.

    In update mode, where a batch has only the rows that changed, the newest row
    of each of the ``keys``.
    """
    spark = changes.sparkSession
    folder = work_folder(spark, name)
    writer = changes.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/progress")
    writer.trigger(availableNow=True).foreachBatch(lambda batch, epoch: put_batch(batch, epoch, folder)).start().awaitTermination()
    return left_behind(spark, folder, mode, keys, changes)


def left_behind(spark: SparkSession, folder: str, mode: str, keys: Sequence[str], changes: DataFrame) -> DataFrame:
    try:
        emitted = spark.read.parquet(f"{folder}/table")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], changes.schema)
    if mode == "update":
        others = [c for c in changes.columns if c not in keys]
        newest = emitted.groupBy(*keys).agg(F.max_by(F.struct(*others), "epoch").alias("_row"))
        return newest.select(*keys, "_row.*").select(*changes.columns)
    if mode == "complete":
        emitted = emitted.where(F.col("epoch") == emitted.agg(F.max("epoch")).first()[0])
    return emitted.select(*changes.columns)


def running_state(changes: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Last-write-wins state of each key, kept up to date."""
    return changes.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def change_windows(changes: DataFrame, time_col: str, late: str, width: str, keys: Sequence[str], slide: str | None = None) -> DataFrame:
    """Changes counted by window, a new one each ``slide``; a window's state is dropped ``late`` after it closes."""
    windowed = changes.withWatermark(time_col, late).groupBy(F.window(time_col, width, slide), *keys)
    return windowed.agg(F.count("*").alias("n")).select(F.col("window.start").alias("opened"), *keys, "n")


def change_sessions(changes: DataFrame, time_col: str, late: str, gap: str, keys: Sequence[str]) -> DataFrame:
    """Bursts of changes, none of which is ``gap`` or more after the one before."""
    bursts = changes.withWatermark(time_col, late).groupBy(F.session_window(time_col, gap), *keys)
    return bursts.agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("opened"), *keys, "n")


def first_assignments(changes: DataFrame, time_col: str, late: str, keys: Sequence[str]) -> DataFrame:
    """One change of each key for as long as the watermark remembers it."""
    return changes.withWatermark(time_col, late).dropDuplicatesWithinWatermark(list(keys))


def change_switches(changes: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """``key, switches, last``: how often each key's value differed from the one before, kept in a state of two values.

    Changes of a key are put in ``order`` within a batch; a batch is taken to
    follow those before it.
    """
    kinds = {name: changes.schema[name].dataType.simpleString() for name in (key, value)}

    def switch(names: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        switches, last = state.get if state.exists else (0, None)
        rows = pd.concat(list(batches)).sort_values(list(order))[value].tolist()
        for now in rows:
            switches, last = switches + (last is not None and now != last), now
        state.update((switches, last))
        yield pd.DataFrame({key: [names[0]], "switches": [switches], "last": [last]})

    out = f"{key} {kinds[key]}, switches bigint, last {kinds[value]}"
    return changes.groupBy(key).applyInPandasWithState(switch, out, f"switches bigint, last {kinds[value]}", "update", GroupStateTimeout.NoTimeout)
