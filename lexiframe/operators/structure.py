"""Sections, versions and nested paths of a catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.functions.text import fragment_family


def fill_sections(rows: DataFrame, file_key: Sequence[str], order: Sequence[str], heading: Column, name: str) -> DataFrame:
    """``rows`` with the newest heading at or before each row of its file; null before the first."""
    upto = Window.partitionBy(*file_key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.last(heading, ignorenulls=True).over(upto))


def version_key(text: Column) -> Column:
    """The numbers of a dotted version as an array, which compares as versions do: 10.1 after 9.2."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), 1), lambda part: part.cast("int"))


def segments(path: Column, separator: str) -> Column:
    """The parts of a joined path; the separator is a regular expression."""
    return F.split(path, separator)


def explode_segments(rows: DataFrame, keep: Sequence[str], path: Column, separator: str) -> DataFrame:
    """One row for each part of each path, numbered from 0."""
    return rows.select(*keep, F.posexplode(segments(path, separator)).alias("pos", "segment"))


def nest(rows: DataFrame, parent: Sequence[str], key: str, value: str, name: str) -> DataFrame:
    """One map for each parent; of equal keys one entry must have been chosen before."""
    pairs = F.sort_array(F.collect_list(F.struct(key, value)))
    return rows.groupBy(*parent).agg(F.map_from_entries(pairs).alias(name))


def assemble_fragments(rows: DataFrame, key: str, value: str, between: str = " ") -> DataFrame:
    """``stem, fragments, whole``: the values of numbered keys with one stem, joined in order of their numbers.

    Keys without a number are none. A family becomes one row.
    """
    numbered = rows.select(fragment_family(F.col(key)).alias("family"), F.col(value).alias("value")).where("family.number IS NOT NULL")
    parts = F.sort_array(F.collect_list(F.struct("family.number", "value")))
    whole = numbered.groupBy("family.stem").agg(F.count("*").alias("fragments"), parts.alias("parts"))
    return whole.select("stem", "fragments", F.array_join("parts.value", between).alias("whole"))


def shown_entries(column: Column) -> Column:
    """A map as ``k=v`` parts in order of keys."""
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(entries, lambda e: F.concat(e.key.cast("string"), F.lit("="), e.value.cast("string"))), ";")
