"""What the physical plans of the registered queries look like."""

import re

import pytest

from lexiframe.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalogue().builders()
PYTHON = {"token_udtf", "arrow_udf", "arrow_udaf"}
STREAMS = {name for name in QUERIES if name.startswith("stream_")}


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<([^>]*)", text)]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_python_only_where_it_is_the_point(spark, name):
    assert bool(re.search("Python|Pandas|Arrow", plan(spark, name))) == (name in PYTHON)
    assert "CartesianProduct" not in plan(spark, name)


def test_state_reads_what_it_needs_and_combines_first(spark):
    text = plan(spark, "effective_state")
    assert read_columns(text) == [{"user_id", "event_type", "ts", "event_id", "value"}]
    assert text.count("Exchange") == 1 and "partial_max_by" in text


def test_window_form_trims_before_the_shuffle(spark):
    text = plan(spark, "effective_state_window")
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_diff_is_one_shuffle_on_pruned_and_filtered_scans(spark):
    text = plan(spark, "snapshot_diff")
    assert "Join" not in text and "EqualTo(l_linenumber,1)" in text and "EqualTo(l_linenumber,2)" in text
    assert all(c == {"l_orderkey", "l_linenumber", "l_quantity"} for c in read_columns(text))


def test_as_of_join_forms_no_pairs(spark):
    assert "Join" not in plan(spark, "asof_join")


def test_range_join_is_by_equality(spark):
    assert "BroadcastNestedLoopJoin" not in plan(spark, "range_join")
