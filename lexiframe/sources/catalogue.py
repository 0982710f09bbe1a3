"""Parsing catalogue files, line by line, into assignments and a quarantine.

A line is an assignment ``$_LANG['a']['b'] = "value"; # note``, a heading
(``# ...`` or ``// ...``), or other text. Lines that begin like an assignment
but aren't whole ones are kept apart with a reason, so that assignments,
quarantined, and other lines add up to all lines. Nothing is executed.

Patterns never go back into a literal, so that a line may be of any length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiframe.functions.text import decode_literal

# The grammar of a line.
VARIABLE = r"\$_LANG"
DOUBLE, SINGLE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
SEGMENT = rf"\[({SINGLE}|{DOUBLE})\]"
VALUE = rf"({DOUBLE}|{SINGLE})"
ASSIGNMENT = rf"^\s*+{VARIABLE}((?:{SEGMENT})++)\s*+=\s*+{VALUE}\s*+;\s*+(?:(?:#|//)\s?(.*+))?$"
HEADING = r"^\s*+(?:#++|//)(.*+)$"
SENTINEL = r"(?i)^\s*+(?:#++|/{2,}+)\s*+end of .*\bfile\b"
LOCALE_KEY = "locale"
VERSION = r"(?i)^version\s+(\d+(?:\.\d+)*)"


@dataclass(frozen=True)
class Parsed:
    assignments: DataFrame
    quarantine: DataFrame
    other: DataFrame


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_id, line_no, text`` of every line of the files at ``path``, numbered from 1; a file is the unit of parallelism."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file_id"), "value")
    lines = whole.select("file_id", F.posexplode(F.split("value", "\r?\n")).alias("at", "text"))
    return lines.select("file_id", (F.col("at") + 1).cast("long").alias("line_no"), "text")


def fault(text: Column) -> Column:
    """Why a line that begins like an assignment isn't a whole one."""
    return F.when(F.regexp_like(text, F.lit(rf"^\s*+{VARIABLE}(?:{SEGMENT})++\s*+=\s*+['\"]")), "unterminated value").otherwise("malformed assignment")


def line_kind(text: Column) -> Column:
    """``assignment``, the reason for quarantine, or ``other``: each line is one of them. A null text is other."""
    text = F.coalesce(text, F.lit(""))
    begun = F.when(F.regexp_like(text, F.lit(rf"^\s*+{VARIABLE}")), fault(text)).otherwise("other")
    return F.when(F.regexp_like(text, F.lit(ASSIGNMENT)), "assignment").otherwise(begun)


def after_sentinel(lines: DataFrame) -> DataFrame:
    """``file_id, line_no, text`` of the lines that begin like assignments below the first comment that ends their file."""
    text = F.col("text")
    ends = lines.where(F.regexp_like(text, F.lit(SENTINEL))).groupBy("file_id").agg(F.min("line_no").alias("_end"))
    begun = lines.where(F.regexp_like(text, F.lit(rf"^\s*+{VARIABLE}"))).select("file_id", "line_no", "text")
    return begun.join(ends, "file_id").where(F.col("line_no") > F.col("_end")).drop("_end")


def with_locale(assignments: DataFrame) -> DataFrame:
    """``assignments`` with the ``locale`` that their file names last; null where it names none."""
    named = assignments.where(F.col("path") == F.array(F.lit(LOCALE_KEY)))
    return assignments.join(named.groupBy("file_id").agg(F.max_by("value", "line_no").alias("locale")), "file_id", "left")


def parse(lines: DataFrame) -> Parsed:
    """``lines`` (file_id, line_no, text) as assignments, quarantined lines, and others.

    ``version`` is the newest version heading above an assignment, ``topic`` the
    newest other heading since then. A null text counts as other.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    heading = F.when(F.regexp_like(text, F.lit(HEADING)), F.btrim(F.regexp_extract(text, HEADING, 1), F.lit(" \t\r\n\f\x0b")))
    version = F.when(F.regexp_like(heading, F.lit(VERSION)), F.regexp_extract(heading, VERSION, 1))
    upto = Window.partitionBy("file_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = lines.select(
        "file_id", "line_no", "text",
        F.regexp_like(text, F.lit(ASSIGNMENT)).alias("_whole"),
        F.regexp_like(text, F.lit(rf"^\s*{VARIABLE}")).alias("_begun"),
        F.last(version, ignorenulls=True).over(upto).alias("version"),
        F.last(F.when(heading.isNotNull(), F.struct(F.when(version.isNull(), heading).alias("topic"))), ignorenulls=True).over(upto).alias("_topic"),
    )
    path = F.regexp_extract(text, ASSIGNMENT, 1)
    inside = F.regexp_extract_all(path, F.lit(SEGMENT), 1)
    keys = F.transform(inside, lambda quoted: F.regexp_replace(F.substring(quoted, F.lit(2), F.length(quoted) - 2), r"\\(['\"\\])", "$1"))
    literal = F.regexp_extract(text, ASSIGNMENT, 3)
    quote = F.substring(literal, 1, 1)
    raw = F.substring(literal, F.lit(2), F.length(literal) - 2)
    note = F.regexp_extract(text, ASSIGNMENT, 4)
    assignments = marked.where("_whole").select(
        "file_id", "line_no", keys.alias("path"), F.size(keys).alias("depth"), raw.alias("raw_value"), decode_literal(raw, quote).alias("value"),
        quote.alias("quote"), F.when(note != "", note).alias("note"), "version", F.col("_topic.topic").alias("topic"),
    )
    quarantine = marked.where("_begun AND NOT _whole").select("file_id", "line_no", "text", fault(text).alias("reason"))
    other = marked.where("NOT _begun").select("file_id", "line_no", "text")
    return Parsed(assignments, quarantine, other)
