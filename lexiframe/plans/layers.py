"""Queries on two snapshots and on override layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiframe.operators import layers
from lexiframe.operators.state import effective_state
from lexiframe.registry import Registry
from lexiframe.sources.tables import table


def snapshots(spark, d):
    """The quantity of line 1 and of line 2 of each order, the larger where a line is repeated."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    of = lambda n: lines.where(F.col("l_linenumber") == n).groupBy("l_orderkey").agg(F.max("l_quantity").alias("l_quantity"))
    return of(1), of(2)


SNAPSHOTS = """a AS (SELECT l_orderkey, max(l_quantity) AS q FROM lineitem WHERE l_linenumber = 1 GROUP BY 1),
     b AS (SELECT l_orderkey, max(l_quantity) AS q FROM lineitem WHERE l_linenumber = 2 GROUP BY 1)"""
DIFF = f"""WITH {SNAPSHOTS},
     j AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, a.q AS before, b.q AS after,
                  CASE WHEN a.l_orderkey IS NULL THEN 'added' WHEN b.l_orderkey IS NULL THEN 'removed'
                       WHEN a.q IS NOT DISTINCT FROM b.q THEN 'unchanged' ELSE 'changed' END AS status
           FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey)"""


def register(r: Registry) -> None:
    @r.query("snapshot_diff", "O-22: what changed between two snapshots", f"{DIFF} SELECT * FROM j")
    def _(spark, d):
        before, after = snapshots(spark, d)
        return layers.snapshot_diff(before, after, ["l_orderkey"], "l_quantity")

    @r.query("snapshot_diff_summary", "O-22: changes counted by kind", f"{DIFF} SELECT status, count(*) AS n FROM j GROUP BY status")
    def _(spark, d):
        before, after = snapshots(spark, d)
        return layers.snapshot_diff(before, after, ["l_orderkey"], "l_quantity").groupBy("status").agg(F.count("*").alias("n"))

    @r.query("added_keys", "O-22: keys that only the later snapshot has", f"WITH {SNAPSHOTS} SELECT l_orderkey, q AS l_quantity FROM b WHERE NOT EXISTS (FROM a WHERE a.l_orderkey = b.l_orderkey)")
    def _(spark, d):
        before, after = snapshots(spark, d)
        return layers.keys_only_in(after, before, ["l_orderkey"])

    @r.query("removed_keys", "O-22: keys that only the earlier snapshot has", f"WITH {SNAPSHOTS} SELECT l_orderkey, q AS l_quantity FROM a WHERE NOT EXISTS (FROM b WHERE a.l_orderkey = b.l_orderkey)")
    def _(spark, d):
        before, after = snapshots(spark, d)
        return layers.keys_only_in(before, after, ["l_orderkey"])

    @r.query("common_keys", "O-22: keys that both snapshots have", f"WITH {SNAPSHOTS} SELECT l_orderkey FROM a WHERE EXISTS (FROM b WHERE a.l_orderkey = b.l_orderkey)")
    def _(spark, d):
        before, after = snapshots(spark, d)
        return layers.keys_in_both(before, after, ["l_orderkey"]).select("l_orderkey")

    @r.query(
        "override_merge",
        "O-21: overrides replace base values",
        """SELECT c_custkey, coalesce(arg_max(o_orderpriority, {'a': o_orderdate, 'b': o_orderkey}), any_value(c_mktsegment)) AS value, count(o_orderkey) > 0 AS overridden
           FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    )
    def _(spark, d):
        base = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("value"))
        newest = effective_state(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", ["o_orderdate", "o_orderkey"])
        over = newest.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("value"))
        return layers.override_merge(base, over, ["c_custkey"], "value")

    @r.query(
        "override_stack",
        "O-21: the highest of several layers wins",
        """WITH c AS (SELECT c_nationkey AS k, max(c_name) AS v FROM customer WHERE c_acctbal > 9900 GROUP BY 1)
           SELECT n_nationkey, coalesce(c.v, CASE WHEN n_regionkey < 3 THEN n_name END, r_name) AS value,
                  CASE WHEN c.k IS NOT NULL THEN 2 WHEN n_regionkey < 3 THEN 1 ELSE 0 END AS layer
           FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN c ON c.k = n_nationkey""",
    )
    def _(spark, d):
        nation = table(spark, d, "nation")
        lowest = nation.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("value"))
        middle = nation.where("n_regionkey < 3").select("n_nationkey", F.col("n_name").alias("value"))
        top = table(spark, d, "customer").where("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.max("c_name").alias("value"))
        return layers.override_stack([lowest, middle, top], ["n_nationkey"], "value")

    @r.query(
        "override_orphans",
        "O-21: overrides whose base key is gone",
        "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)",
    )
    def _(spark, d):
        base = table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
        return layers.keys_only_in(table(spark, d, "orders").select("o_orderkey", "o_custkey"), base, ["o_custkey"]).select("o_orderkey", "o_custkey")

    @r.query(
        "lookup_with_fallback",
        "O-13: a missing entry shows its key",
        "SELECT n_nationkey, coalesce(r_name, n_regionkey::VARCHAR) AS shown FROM nation LEFT JOIN (FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey",
    )
    def _(spark, d):
        known = table(spark, d, "region").where("r_regionkey < 3")
        joined = table(spark, d, "nation").join(known, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        return joined.select("n_nationkey", layers.with_fallback(F.col("r_name"), F.col("n_regionkey")).alias("shown"))
