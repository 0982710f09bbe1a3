"""Generic relational queries: extras of this library, not semantics of message catalogues."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.operators import relational
from lexiframe.registry import Registry
from lexiframe.sources.tables import table

#: Statements that both engines read alike; tables are views of the same names.
STATEMENTS = {
    "sql_pricing_summary": """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
        round(avg(l_discount), 6) AS discount, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus""",
    "sql_exists": """SELECT o_orderpriority, count(*) AS n FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_discount > 0.05)
        GROUP BY o_orderpriority""",
    "sql_in": "SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
    "sql_correlated": """SELECT c_custkey, c_acctbal FROM customer c WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer x WHERE x.c_nationkey = c.c_nationkey)""",
    "sql_scalar_subquery": "SELECT p_partkey FROM part WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part)",
    "sql_cte": """WITH t AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey), m AS (SELECT max(orders) AS most FROM t)
        SELECT o_custkey, orders FROM t JOIN m ON orders = most""",
    "sql_union": "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
    "sql_union_all": "SELECT nation, count(*) AS n FROM (SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier) t GROUP BY nation",
    "sql_intersect": "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'",
    "sql_except": "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'",
    "sql_intersect_all": "SELECT n, count(*) AS times FROM (SELECT c_nationkey AS n FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier) t GROUP BY n",
    "sql_except_all": "SELECT n, count(*) AS times FROM (SELECT c_nationkey AS n FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier) t GROUP BY n",
    "sql_grouping_sets": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
    "sql_ranks": """SELECT p_partkey, CAST(rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS BIGINT) AS r,
        CAST(dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS BIGINT) AS dr, CAST(ntile(4) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS BIGINT) AS quarter, percent_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS pr,
        cume_dist() OVER (PARTITION BY p_brand ORDER BY p_size) AS cd FROM part""",
    "sql_navigation": """SELECT o_orderkey, lag(o_orderkey) OVER w AS previous, first_value(o_orderkey) OVER w AS earliest, nth_value(o_orderkey, 2) OVER w AS second
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "sql_rows_frame": """SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS smooth FROM events""",
    "sql_range_frame": """SELECT p_partkey, count(*) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near FROM part""",
    "sql_top": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "sql_case_null": """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band, coalesce(nullif(c_mktsegment, 'BUILDING'), '-') AS segment
        FROM customer""",
    "sql_dates": "SELECT CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, count(*) AS n, CAST(min(date_trunc('month', o_orderdate)) AS DATE) AS first_day FROM orders GROUP BY year(o_orderdate), month(o_orderdate)",
    "sql_strings": "SELECT s_suppkey, upper(substring(s_name, 1, 8)) AS head, CAST(length(s_name) AS BIGINT) AS size, replace(s_name, '#', '-') AS shown FROM supplier",
    "sql_maths": "SELECT p_partkey, abs(p_size - 25) AS away, p_size % 7 AS rest, round(sqrt(p_retailprice), 6) AS root, CAST(ceil(p_retailprice / 100) AS BIGINT) AS hundreds FROM part",
    "sql_right_join": "SELECT n_name, count(c_custkey) AS n FROM customer RIGHT JOIN nation ON c_nationkey = n_nationkey AND c_acctbal > 9000 GROUP BY n_name",
    "sql_full_join": "SELECT coalesce(c_nationkey, s_nationkey) AS nation, count(*) AS n FROM customer FULL JOIN supplier ON c_nationkey = s_nationkey AND s_acctbal > 9000 GROUP BY 1",
    "sql_theta_join": "SELECT r_name, count(*) AS n FROM region JOIN nation ON n_regionkey > r_regionkey GROUP BY r_name",
    "sql_distinct": "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY o_orderstatus",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def statement(text: str):
    """A builder that runs a statement on views of the tables that it names."""

    def build(spark, d):
        for name in TABLES:
            if name in text:
                table(spark, d, name).createOrReplaceTempView(name)
        return spark.sql(text)

    return build


def register(r: Registry) -> None:
    for name, text in STATEMENTS.items():
        r.query(name, "generic extra", text)(statement(text))

    @r.query(
        "asof_join",
        "generic extra: newest earlier row",
        """SELECT c.event_id, p.value AS last_value FROM (FROM events WHERE event_type = 'click') c
           ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p ON c.user_id = p.user_id AND c.ts >= p.ts""",
    )
    def _(spark, d):
        events = table(spark, d, "events")
        clicks = events.where("event_type = 'click'").select("user_id", "ts", "event_id")
        bought = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("last_value"))
        return relational.as_of(clicks, bought, ["user_id"], "ts", ["last_value"]).select("event_id", "last_value")

    @r.query(
        "range_join",
        "generic extra: points in spans",
        """WITH s AS (SELECT c_custkey, c_acctbal AS low, c_acctbal + 5 AS high FROM customer)
           SELECT s_suppkey, count(*) AS n, min(c_custkey) AS first_key FROM supplier JOIN s ON s_acctbal >= low AND s_acctbal < high GROUP BY s_suppkey""",
    )
    def _(spark, d):
        spans = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("low"), (F.col("c_acctbal") + 5).alias("high"))
        found = relational.range_join(table(spark, d, "supplier").select("s_suppkey", "s_acctbal"), spans, "s_acctbal", "low", "high", 5.0)
        return found.groupBy("s_suppkey").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_key"))

    @r.query(
        "sessionize",
        "generic extra: gaps and islands",
        """WITH g AS (SELECT *, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < 21600 THEN 0 ELSE 1 END AS fresh FROM events)
           SELECT event_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS session FROM g""",
    )
    def _(spark, d):
        rows = table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
        return relational.sessions(rows, ["user_id"], "ts", 21600).select("event_id", "session")

    @r.query(
        "pivot_counts",
        "generic extra: rows to columns",
        """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p
           FROM orders GROUP BY o_orderpriority""",
    )
    def _(spark, d):
        counted = table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()
        return counted.select("o_orderpriority", *(F.coalesce(F.col(s), F.lit(0)).alias(s.lower()) for s in "FOP"))

    @r.query("approximate_distinct", "generic extra: a sketch within a tenth of the truth", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS exactly, true AS close FROM orders GROUP BY o_orderstatus")
    def _(spark, d):
        both = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.approx_count_distinct("o_custkey", 0.02).alias("about"), F.countDistinct("o_custkey").alias("exactly"))
        return both.select("o_orderstatus", "exactly", (F.abs(F.col("about") - F.col("exactly")) <= 0.1 * F.col("exactly")).alias("close"))

    @r.query("higher_order", "generic extra: arrays", "SELECT o_custkey, list_sum(list_transform(list_filter(list(o_orderkey), lambda k: k % 2 = 0), lambda k: k * 2))::BIGINT AS total FROM orders GROUP BY o_custkey")
    def _(spark, d):
        keys = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("keys"))
        even = F.transform(F.filter("keys", lambda k: k % 2 == 0), lambda k: k * 2)
        total = F.aggregate(even, F.lit(0).cast("long"), lambda t, k: t + k)
        return keys.select("o_custkey", F.when(F.size(even) > 0, total).alias("total"))

    @r.query("arrow_udf", "generic extra: a vectorised scalar function", "SELECT s_suppkey, s_acctbal * 2 + 1 AS scaled FROM supplier")
    def _(spark, d):
        @F.pandas_udf(T.DoubleType())
        def scale(values):
            return values * 2 + 1

        return table(spark, d, "supplier").select("s_suppkey", scale("s_acctbal").alias("scaled"))

    @r.query("arrow_udaf", "generic extra: a vectorised aggregate", "SELECT s_nationkey, max(s_acctbal) - min(s_acctbal) AS spread FROM supplier GROUP BY s_nationkey")
    def _(spark, d):
        @F.pandas_udf(T.DoubleType(), F.PandasUDFType.GROUPED_AGG)
        def spread(values):
            return float(values.max() - values.min())

        return table(spark, d, "supplier").groupBy("s_nationkey").agg(spread("s_acctbal").alias("spread"))

    @r.query("top_per_group", "generic extra: the best of each group", "SELECT l_suppkey, l_orderkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 3")
    def _(spark, d):
        best = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
        lines = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
        return lines.withColumn("at", F.row_number().over(best)).where("at <= 3").select("l_suppkey", "l_orderkey", "l_extendedprice")
