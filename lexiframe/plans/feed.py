"""Queries on the change feed, each run until the stream is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiframe.registry import Registry
from lexiframe.streaming import feed

#: Longer than the log is disordered, so that nothing is late.
LATE = "3650 days"


def events(spark, d):
    return feed.change_feed(spark, f"{d}/events.parquet", "ts").select("event_id", "ts", "user_id", "event_type", "value")


def register(r: Registry) -> None:
    @r.query(
        "stream_effective_state",
        "O-05: state kept up to date by a stream",
        "SELECT user_id, event_type, arg_max(value, {'a': ts, 'b': event_id}) AS value FROM events GROUP BY ALL",
    )
    def _(spark, d):
        state = feed.running_state(events(spark, d), ["user_id", "event_type"], "value", ["ts", "event_id"])
        return feed.run_to_end(state, "state", "update", ["user_id", "event_type"])

    @r.query(
        "stream_change_windows",
        "changes by day and kind",
        "SELECT date_trunc('day', ts)::TIMESTAMP AS opened, event_type, count(*) AS n FROM events GROUP BY ALL",
    )
    def _(spark, d):
        found = feed.run_to_end(feed.change_windows(events(spark, d), "ts", LATE, "1 day", ["event_type"]), "windows", "update", ["opened", "event_type"])
        return found.withColumn("opened", F.col("opened").cast("timestamp_ntz"))

    @r.query(
        "stream_sessions",
        "bursts of changes of a user",
        """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
                s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
           SELECT user_id, min(ts) AS opened, count(*) AS n FROM s GROUP BY user_id, session""",
    )
    def _(spark, d):
        found = feed.run_to_end(feed.change_sessions(events(spark, d), "ts", LATE, "6 hours", ["user_id"]), "sessions", "complete")
        return found.withColumn("opened", F.col("opened").cast("timestamp_ntz"))

    @r.query(
        "stream_sliding_windows",
        "changes of two days, counted each day",
        """SELECT opened, event_type, count(*) AS n FROM (SELECT event_type, unnest([date_trunc('day', ts)::TIMESTAMP, date_trunc('day', ts)::TIMESTAMP - INTERVAL 1 DAY]) AS opened FROM events)
           GROUP BY ALL""",
    )
    def _(spark, d):
        windows = feed.change_windows(events(spark, d), "ts", LATE, "2 days", ["event_type"], "1 day")
        found = feed.run_to_end(windows, "sliding", "update", ["opened", "event_type"])
        return found.withColumn("opened", F.col("opened").cast("timestamp_ntz"))

    @r.query(
        "stream_closed_windows",
        "windows given out once the watermark has passed them, and only then",
        """SELECT date_trunc('day', ts)::TIMESTAMP AS opened, event_type, count(*) AS n FROM events GROUP BY ALL
           HAVING date_trunc('day', min(ts))::TIMESTAMP + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY""",
    )
    def _(spark, d):
        found = feed.run_to_end(feed.change_windows(events(spark, d), "ts", "2 days", "1 day", ["event_type"]), "closed", "append")
        return found.withColumn("opened", F.col("opened").cast("timestamp_ntz"))

    @r.query(
        "stream_switches",
        "a state of our own for each key: how often its value changed",
        """SELECT user_id, count(*) FILTER (was IS NOT NULL AND was <> event_type) AS switches, arg_max(event_type, {'a': ts, 'b': event_id}) AS last
           FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events) GROUP BY user_id""",
    )
    def _(spark, d):
        return feed.run_to_end(feed.change_switches(events(spark, d), "user_id", "event_type", ["ts", "event_id"]), "switches", "update", ["user_id"])

    @r.query("stream_first_assignment", "keys as they first appear", "SELECT DISTINCT user_id, event_type FROM events")
    def _(spark, d):
        found = feed.run_to_end(feed.first_assignments(events(spark, d), "ts", LATE, ["user_id", "event_type"]), "first", "append")
        return found.select("user_id", "event_type")
