"""Queries that parse catalogue lines built from table rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.registry import Registry
from lexiframe.sources.catalogue import after_sentinel, line_kind, parse, read_lines, with_locale
from lexiframe.sources.tables import FORMATS, stored, table, work_folder

BROKEN = "p_partkey % 10 = 3"


def lines(spark, d):
    """One line for each part: a nested assignment with a note, some without their closing quote."""
    start = F.concat(F.lit("$_LANG['"), F.col("p_type"), F.lit("']['"), F.col("p_name"), F.lit('\'] = "'), F.col("p_brand"))
    end = F.when(F.expr(BROKEN), F.lit(";")).otherwise(F.concat(F.lit('\\"x\\""; # size '), F.col("p_size").cast("string")))
    return table(spark, d, "part").select(F.lit("part").alias("file_id"), F.col("p_partkey").alias("line_no"), F.concat(start, end).alias("text"))


def register(r: Registry) -> None:
    @r.query(
        "catalogue_parse",
        "O-02 to O-07: assignments from lines",
        f"""SELECT p_partkey AS line_no, p_type || '|' || p_name AS path, 2 AS depth, p_brand || '"x"' AS value FROM part WHERE NOT ({BROKEN})""",
    )
    def _(spark, d):
        found = parse(lines(spark, d)).assignments
        return found.select("line_no", F.array_join("path", "|").alias("path"), "depth", "value")

    @r.query(
        "malformed_quarantine",
        "malformed lines are kept apart, and all lines accounted for",
        r"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
            SELECT CASE WHEN line = '' THEN 'other' WHEN regexp_matches('"' || line || '";', '^("([^"\\]|\\.)*")\s*;\s*((#|//)\s?.*)?$') THEN 'assignment' ELSE 'unterminated value' END AS kind, count(*) AS n
            FROM l GROUP BY 1""",
    )
    def _(spark, d):
        found = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
        text = F.when(F.col("line") != "", F.concat(F.lit("$_LANG['line'] = \""), F.col("line"), F.lit('";')))
        return found.groupBy(line_kind(text).alias("kind")).agg(F.count("*").alias("n"))

    @r.query(
        "sentinel_check",
        "O-11: nothing is assigned below the comment that ends a file",
        "SELECT p_brand AS file_id, p_partkey AS line_no FROM part JOIN (SELECT p_brand, min(p_partkey) AS ended FROM part WHERE p_partkey % 17 = 3 GROUP BY 1) USING (p_brand) WHERE p_partkey > ended AND p_partkey % 17 <> 3",
    )
    def _(spark, d):
        usual = F.concat(F.lit("$_LANG['"), F.col("p_name"), F.lit("'] = 'x';"))
        text = F.when(F.col("p_partkey") % 17 == 3, "//// End of this file. Nothing more.").otherwise(usual)
        rows = table(spark, d, "part").select(F.col("p_brand").alias("file_id"), F.col("p_partkey").alias("line_no"), text.alias("text"))
        return after_sentinel(rows).select("file_id", "line_no")

    @r.query(
        "locale_metadata",
        "O-12: the locale of a file beside its assignments",
        """SELECT p_partkey AS line_no, l.locale FROM part LEFT JOIN
           (SELECT p_brand, arg_max('l' || p_size || '_XX', p_partkey) AS locale FROM part WHERE p_partkey % 23 = 5 GROUP BY 1) l USING (p_brand)""",
    )
    def _(spark, d):
        key = F.when(F.col("p_partkey") % 23 == 5, "locale").otherwise(F.col("p_name"))
        text = F.concat(F.lit("$_LANG['"), key, F.lit("'] = \"l"), F.col("p_size").cast("string"), F.lit('_XX";'))
        rows = table(spark, d, "part").select(F.col("p_brand").alias("file_id"), F.col("p_partkey").alias("line_no"), text.alias("text"))
        return with_locale(parse(rows).assignments).select("line_no", "locale")

    @r.query(
        "text_source",
        "O-02: catalogue files read as text",
        f"""SELECT p_type || '|' || p_name AS path, p_brand || '"x"' AS value FROM part WHERE NOT ({BROKEN})""",
    )
    def _(spark, d):
        folder = work_folder(spark, "catalogue")
        lines(spark, d).select("text").write.text(folder)
        return parse(read_lines(spark, folder)).assignments.select(F.array_join("path", "|").alias("path"), "value")

    @r.query(
        "format_round_trip",
        "sources and sinks: rows written and read again",
        "SELECT f.kind, o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS keys, max(o_totalprice) AS most FROM orders, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) f(kind) GROUP BY ALL",
    )
    def _(spark, d):
        orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
        read = [stored(orders, kind, work_folder(spark, kind)).withColumn("kind", F.lit(kind)) for kind in FORMATS]
        return reduce(DataFrame.unionByName, read).groupBy("kind", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.max("o_totalprice").alias("most"))

    @r.query("inline_note_extract", "O-10: notes after an assignment", f"SELECT p_partkey AS line_no, 'size ' || p_size AS note FROM part WHERE NOT ({BROKEN})")
    def _(spark, d):
        return parse(lines(spark, d)).assignments.select("line_no", "note")
