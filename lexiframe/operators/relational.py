"""Joins that Spark has no operator for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with the ``values`` of the newest row of ``right`` at or before them; null where there is none.

    Both sides are stacked and ordered once by key and time, so no row is
    compared with another. Of right rows at one time, any may be taken, so
    there should be one.
    """
    row = F.struct(*(F.col(c) for c in left.columns))
    ours = left.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_side"), row.alias("_left"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("_right"))
    theirs = right.select(*keys, F.col(time).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(row).schema[0].dataType).alias("_left"), F.struct(*values).alias("_right"))
    upto = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = ours.unionByName(theirs).withColumn("_right", F.last("_right", ignorenulls=True).over(upto))
    return filled.where("_side = 1").select("_left.*", *(F.col(f"_right.{v}").alias(v) for v in values))


def range_join(points: DataFrame, spans: DataFrame, at: str, start: str, end: str, width: float) -> DataFrame:
    """Each point with every span [start, end) that holds it.

    Spans are copied to the bins of ``width`` that they touch, so bins are
    joined by equality; choose the width near the usual length of a span.
    """

    def bin_of(value: Column) -> Column:
        return F.floor(value / width)

    touched = F.sequence(bin_of(F.col(start)), bin_of(F.col(end)))
    binned = spans.where(F.col(start) < F.col(end)).withColumn("_bin", F.explode(touched))
    placed = points.withColumn("_bin", bin_of(F.col(at)))
    return placed.join(binned, "_bin").where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bin")


def sessions(rows: DataFrame, keys: Sequence[str], time: str, gap_seconds: float) -> DataFrame:
    """``rows`` with a session number in each key; a session ends at a pause of ``gap_seconds`` or more."""
    ordered = Window.partitionBy(*keys).orderBy(time)
    pause = F.col(time).cast("double") - F.lag(time).over(ordered).cast("double")
    fresh = F.when(pause < gap_seconds, 0).otherwise(1)
    return rows.withColumn("_fresh", fresh).withColumn("session", F.sum("_fresh").over(ordered)).drop("_fresh")
