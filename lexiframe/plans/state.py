"""Queries on last-write-wins state and on what was overwritten."""

from __future__ import annotations

from lexiframe.operators import state
from lexiframe.registry import Registry
from lexiframe.sources.tables import table

EVENT_KEY, EVENT_ORDER = ("user_id", "event_type"), ("ts", "event_id")


def register(r: Registry) -> None:
    @r.query(
        "effective_state",
        "O-05: the last assignment of a key wins",
        "SELECT user_id, event_type, arg_max(value, {'a': ts, 'b': event_id}) AS value FROM events GROUP BY ALL",
    )
    def _(spark, d):
        return state.effective_state(table(spark, d, "events"), EVENT_KEY, "value", EVENT_ORDER)

    @r.query(
        "effective_state_window",
        "O-05: the whole last assignment of a key",
        """SELECT user_id, event_type, event_id, value FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    )
    def _(spark, d):
        events = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
        return state.effective_rows(events, EVENT_KEY, EVENT_ORDER).drop("ts")

    @r.query(
        "assignment_span",
        "O-05: first and last place of a key",
        "SELECT user_id, event_type, min(event_id) AS first_line, max(event_id) AS last_line, count(*) AS n_assign FROM events GROUP BY ALL",
    )
    def _(spark, d):
        return state.assignment_span(table(spark, d, "events"), EVENT_KEY, "event_id")

    @r.query(
        "duplicate_assignments",
        "keys assigned more than once",
        "SELECT user_id, event_type, count(*) AS n_assign FROM events GROUP BY ALL HAVING count(*) > 1",
    )
    def _(spark, d):
        return state.duplicate_assignments(table(spark, d, "events"), EVENT_KEY)

    @r.query(
        "conflicting_assignments",
        "keys assigned with different values",
        """SELECT o_custkey, count(*) AS n_assign, count(DISTINCT o_orderpriority) AS n_distinct
           FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1""",
    )
    def _(spark, d):
        return state.conflicting_assignments(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority")

    @r.query(
        "redundant_assignments",
        "keys assigned the same value again",
        """SELECT o_custkey, count(*) AS n_assign, count(DISTINCT o_orderstatus) AS n_distinct
           FROM orders GROUP BY o_custkey HAVING count(*) > 1 AND count(DISTINCT o_orderstatus) = 1""",
    )
    def _(spark, d):
        return state.redundant_assignments(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus")

    @r.query(
        "superseded_rows",
        "O-05: assignments that a later one replaced",
        """SELECT event_id, superseded_by FROM (
             SELECT event_id, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS superseded_by FROM events
           ) WHERE superseded_by IS NOT NULL""",
    )
    def _(spark, d):
        events = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id")
        return state.superseded_rows(events, EVENT_KEY, EVENT_ORDER, "event_id").select("event_id", "superseded_by")

    @r.query(
        "reverted_keys",
        "keys whose last value is their first again",
        """SELECT o_custkey, arg_min(o_orderpriority, {'a': o_orderdate, 'b': o_orderkey}) AS first_value, count(DISTINCT o_orderpriority) AS n_distinct
           FROM orders GROUP BY o_custkey
           HAVING arg_min(o_orderpriority, {'a': o_orderdate, 'b': o_orderkey}) = arg_max(o_orderpriority, {'a': o_orderdate, 'b': o_orderkey})
              AND count(DISTINCT o_orderpriority) > 1""",
    )
    def _(spark, d):
        return state.reverted_keys(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", ["o_orderdate", "o_orderkey"])
