"""Last-write-wins state of an assignment log, and what was overwritten.

An assignment log has key columns, a value, and columns that order the writes
of a key. The newest write wins; no write is ever deleted. Nulls: a null key
is a key of its own, a null value is a value like any other in states but is
not counted as distinct, and a null in the order columns comes first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def effective_state(log: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """One row for each key with its newest value; partial aggregation keeps one row of a key per task."""
    return log.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def effective_rows(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole newest row of each key; Spark trims each task to one row of a key before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return log.withColumn("_newest", F.row_number().over(newest)).where("_newest = 1").drop("_newest")


def assignment_span(log: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """First and last position and the number of writes of each key."""
    return log.groupBy(*keys).agg(F.min(position).alias("first_line"), F.max(position).alias("last_line"), F.count("*").alias("n_assign"))


def assignment_counts(log: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Writes and distinct values of each key."""
    return log.groupBy(*keys).agg(F.count("*").alias("n_assign"), F.countDistinct(value).alias("n_distinct"))


def duplicate_assignments(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys written more than once."""
    return log.groupBy(*keys).agg(F.count("*").alias("n_assign")).where("n_assign > 1")


def conflicting_assignments(log: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys written with more than one value."""
    return assignment_counts(log, keys, value).where("n_distinct > 1")


def redundant_assignments(log: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys written more than once, always with the same value."""
    return assignment_counts(log, keys, value).where("n_assign > 1 AND n_distinct = 1")


def superseded_rows(log: DataFrame, keys: Sequence[str], order: Sequence[str], position: str) -> DataFrame:
    """Writes that a later one of the same key replaced, with the position of the next."""
    following = Window.partitionBy(*keys).orderBy(*order)
    return log.withColumn("superseded_by", F.lead(position).over(following)).where("superseded_by IS NOT NULL")


def reverted_keys(log: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Keys whose newest value is their first, with another one in between."""
    at = F.struct(*order)
    ends = log.groupBy(*keys).agg(F.min_by(value, at).alias("first_value"), F.max_by(value, at).alias("last_value"), F.countDistinct(value).alias("n_distinct"))
    return ends.where("first_value = last_value AND n_distinct > 1").drop("last_value")
