"""Queries on sections, versions and nested paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiframe.operators import structure
from lexiframe.registry import Registry
from lexiframe.sources.tables import table

SECTIONS = """s AS (SELECT event_id, user_id, value,
                last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
              FROM events)"""


def sections(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    heading = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return structure.fill_sections(events, ["user_id"], ["ts", "event_id"], heading, "section")


def register(r: Registry) -> None:
    @r.query("section_fill", "O-09: headings apply to what follows", f"WITH {SECTIONS} SELECT event_id, user_id, section FROM s")
    def _(spark, d):
        return sections(spark, d).select("event_id", "user_id", "section")

    @r.query("section_stats", "sections counted", f"WITH {SECTIONS} SELECT user_id, section, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY ALL")
    def _(spark, d):
        return sections(spark, d).groupBy("user_id", "section").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))

    @r.query(
        "version_order",
        "versions compare as numbers, not as text",
        """WITH v AS (SELECT p_type, replace(p_brand, 'Brand#', '') || '.' || p_size AS version, replace(p_brand, 'Brand#', '')::INT AS a, p_size AS b FROM part)
           SELECT p_type, arg_max(version, a * 1000 + b) AS newest, max(version) AS last_as_text FROM v GROUP BY p_type""",
    )
    def _(spark, d):
        version = F.concat(F.regexp_extract("p_brand", r"(\d+)", 1), F.lit("."), F.col("p_size").cast("string"))
        parts = table(spark, d, "part").select("p_type", version.alias("version"))
        newest = F.max(F.struct(structure.version_key(F.col("version")).alias("key"), "version"))
        return parts.groupBy("p_type").agg(newest.alias("top"), F.max("version").alias("last_as_text")).select("p_type", F.col("top.version").alias("newest"), "last_as_text")

    @r.query(
        "path_split",
        "O-03/04: paths are arrays, not joined text",
        """SELECT page_id, string_split(url, '/')[3] AS root, string_split(url, '/')[-1] AS leaf, len(string_split(url, '/'))::INT AS depth FROM pages""",
    )
    def _(spark, d):
        path = structure.segments(F.col("url"), "/")
        return table(spark, d, "pages").select("page_id", F.get(path, F.lit(2)).alias("root"), F.element_at(path, -1).alias("leaf"), F.size(path).alias("depth"))

    @r.query("path_depth_histogram", "how deep paths are", "SELECT len(string_split(url, '/'))::INT AS depth, count(*) AS n FROM pages GROUP BY 1")
    def _(spark, d):
        return table(spark, d, "pages").groupBy(F.size(structure.segments(F.col("url"), "/")).alias("depth")).agg(F.count("*").alias("n"))

    @r.query(
        "path_segments",
        "O-03: one row for each key segment",
        "SELECT page_id, (generate_subscripts(p, 1) - 1)::INT AS pos, unnest(p) AS segment FROM (SELECT page_id, string_split(url, '/') AS p FROM pages)",
    )
    def _(spark, d):
        return structure.explode_segments(table(spark, d, "pages"), ["page_id"], F.col("url"), "/")

    located = """l AS (SELECT r_name, n_name, c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

    @r.query(
        "subtree_rollup",
        "namespaces counted with their leaves",
        f"WITH {located} SELECT r_name, n_name, count(*) AS leaves, round(sum(c_acctbal), 2) AS total, (GROUPING(r_name) * 2 + GROUPING(n_name))::INT AS level FROM l GROUP BY ROLLUP (r_name, n_name)",
    )
    def _(spark, d):
        nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        leaves = table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        return leaves.rollup("r_name", "n_name").agg(F.count("*").alias("leaves"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.grouping_id().cast("int").alias("level"))

    @r.query("subtree_cube", "namespaces counted both ways", "SELECT p_brand, p_type, count(*) AS n, max(p_size) AS largest FROM part GROUP BY CUBE (p_brand, p_type)")
    def _(spark, d):
        return table(spark, d, "part").cube("p_brand", "p_type").agg(F.count("*").alias("n"), F.max("p_size").alias("largest"))

    @r.query(
        "nest_to_map",
        "O-03: a namespace as a map",
        "SELECT n_regionkey, string_agg(n_nationkey || '=' || n_name, ';' ORDER BY n_nationkey) AS entries FROM nation GROUP BY n_regionkey",
    )
    def _(spark, d):
        nested = structure.nest(table(spark, d, "nation"), ["n_regionkey"], "n_nationkey", "n_name", "entries")
        return nested.select("n_regionkey", structure.shown_entries(F.col("entries")).alias("entries"))

    @r.query("flatten_map", "O-03: leaves of a nested value", "SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS leaf FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
    def _(spark, d):
        leaves = table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "leaf"))
        return leaves.where(F.col("leaf").isNotNull())
