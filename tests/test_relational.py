"""Joins without a Spark operator against plain loops."""

from lexiframe.operators import relational


def test_as_of(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 5, 3), (None, 5, 4)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("b", 6, "z"), (None, 1, "n")], "k string, t int, v string")
    found = {r.id: r.v for r in relational.as_of(left, right, ["k"], "t", ["v"]).collect()}
    assert found == {1: "y", 2: None, 3: None, 4: "n"}


def test_range_join(spark):
    points = spark.createDataFrame([(1, 0.0), (2, 9.5), (3, 10.0)], "p int, at double")
    spans = spark.createDataFrame([(1, -5.0, 0.0), (2, 0.0, 10.0), (3, 9.0, 11.0), (4, 3.0, 3.0)], "s int, low double, high double")
    found = sorted((r.p, r.s) for r in relational.range_join(points, spans, "at", "low", "high", 4.0).collect())
    assert found == [(1, 2), (2, 2), (2, 3), (3, 3)]
