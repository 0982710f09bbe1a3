"""Snapshots and override layers of a keyed catalogue.

Each side or layer has a key at most once (take its effective state first).
Values are compared null-safely: a null value is a value, a missing key is not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row for each key of either side: ``before``, ``after`` and ``status``.

    Both sides are stacked and folded by key: one shuffle that combines before
    it moves rows, and no sort, where a full outer join would sort both sides.
    """
    side = lambda df, n: df.select(*keys, F.col(value).alias("value"), F.lit(n).alias("side"))
    both = side(before, 0).unionByName(side(after, 1))
    of = lambda n: F.col("side") == n
    folded = both.groupBy(*keys).agg(
        F.max(F.when(of(0), F.col("value"))).alias("before"),
        F.max(F.when(of(1), F.col("value"))).alias("after"),
        F.max(F.when(of(0), True)).alias("_was"),
        F.max(F.when(of(1), True)).alias("_is"),
    )
    status = (
        F.when(F.col("_was").isNull(), "added")
        .when(F.col("_is").isNull(), "removed")
        .when(F.col("before").eqNullSafe(F.col("after")), "unchanged")
        .otherwise("changed")
    )
    return folded.select(*keys, "before", "after", status.alias("status"))


def keys_only_in(one: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``one`` whose key the other side lacks."""
    return one.join(other.select(*keys), list(keys), "left_anti")


def keys_in_both(one: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``one`` whose key the other side has too."""
    return one.join(other.select(*keys), list(keys), "left_semi")


def override_merge(base: DataFrame, overrides: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Every base key with its override where there is one; overrides of unknown keys add nothing."""
    over = overrides.select(*keys, F.col(value).alias("_over"), F.lit(True).alias("_has"))
    merged = base.join(over, list(keys), "left")
    chosen = F.when(F.col("_has"), F.col("_over")).otherwise(F.col(value))
    return merged.select(*keys, chosen.alias(value), F.coalesce("_has", F.lit(False)).alias("overridden"))


def override_stack(layers: Sequence[DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """Each key with its value and the number of the highest layer that has it; later layers are higher."""
    numbered = [df.select(*keys, F.col(value), F.lit(n).alias("layer")) for n, df in enumerate(layers)]
    stacked = reduce(DataFrame.unionByName, numbered)
    return stacked.groupBy(*keys).agg(F.max_by(value, "layer").alias(value), F.max("layer").alias("layer"))


def with_fallback(value: Column, key: Column) -> Column:
    """A looked-up value, or the key itself where there is none."""
    return F.coalesce(value, key.cast("string"))
