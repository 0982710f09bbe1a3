"""Every registered query of the library itself against its SQL in DuckDB."""

import datetime
import os

import duckdb
import pytest

from lexiframe.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = list(catalogue())
#: Empty only because the smallest tables are.
MAY_BE_EMPTY = {"redundant_assignments", "override_stack", "range_join", "sql_correlated"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def shown(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return f"{float(value):.9g}" if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def as_sorted(rows):
    return sorted(tuple(shown(v) for v in row) for row in rows)


@pytest.mark.parametrize("query", QUERIES, ids=lambda q: q.name)
def test_matches_sql(spark, duck, query):
    assert query.sql is not None
    found = query.build(spark, FOLDER)
    columns = sorted(found.columns)
    wanted = duck.sql(query.sql)
    assert columns == sorted(wanted.columns)
    rows = found.select(*columns).collect()
    assert rows or query.name in MAY_BE_EMPTY
    assert as_sorted(rows) == as_sorted(wanted.select(*(f'"{c}"' for c in columns)).fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
