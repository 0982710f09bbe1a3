"""Streams end where the batch does, and late rows are dropped where the watermark says so."""

import datetime

from pyspark.sql import functions as F

from lexiframe.streaming import feed


def rows(spark, days):
    start = datetime.datetime(2024, 1, 1)
    data = [(n, start + datetime.timedelta(days=day), "k" + str(n % 2), float(n)) for n, day in enumerate(days)]
    return spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, key string, value double")


def write(spark, path, batches):
    for n, days in enumerate(batches):
        rows(spark, days).coalesce(1).write.mode("append").parquet(f"{path}/{n}")


def test_state_over_several_batches(spark, tmp_path):
    path = str(tmp_path / "log")
    for days in ([1, 2], [3, 0], [5]):
        rows(spark, days).coalesce(1).write.mode("append").parquet(path)
    stream = feed.change_feed(spark, path, "ts", files_per_batch=1)
    found = feed.run_to_end(feed.running_state(stream, ["key"], "value", ["ts", "event_id"]), "t", "complete")
    wanted = spark.read.parquet(path).groupBy("key").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))
    assert sorted(found.collect()) == sorted(wanted.collect())


def test_a_batch_that_is_run_again_counts_once(spark, tmp_path):
    one, two = rows(spark, [1, 2]), rows(spark, [3])
    for epoch, batch in ((0, one), (1, two), (1, two), (0, one)):
        feed.put_batch(batch, epoch, str(tmp_path))
    assert feed.left_behind(spark, str(tmp_path), "append", (), one).count() == 3
    assert feed.left_behind(spark, str(tmp_path), "complete", (), one).count() == 1
    newest = feed.left_behind(spark, str(tmp_path), "update", ["event_id"], one).collect()
    assert sorted((r.event_id, r.ts.day) for r in newest) == [(0, 4), (1, 3)]


def test_late_rows_are_dropped_and_siblings_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    for days in ([0, 9], [10], [1, 20], [30]):
        rows(spark, days).coalesce(1).write.mode("append").parquet(path)
    rows(spark, [0] * 50).write.parquet(path + ".bak")
    windows = feed.change_windows(feed.change_feed(spark, path, "ts", files_per_batch=1), "ts", "1 day", "1 day", ["key"])
    found = feed.run_to_end(windows, "w", "append").agg(F.sum("n")).first()[0]
    assert found == 4  # day 1 comes when days 0 to 8 are closed, and day 30 is still open


def test_switches_over_several_batches(spark, tmp_path):
    path = str(tmp_path / "log")
    for days in ([1, 2], [3, 4], [5]):
        rows(spark, days).coalesce(1).write.mode("append").parquet(path)
    stream = feed.change_feed(spark, path, "ts", files_per_batch=1)
    found = feed.run_to_end(feed.change_switches(stream, "key", "value", ["ts"]), "s", "update", ["key"])
    assert sorted((r.key, r.switches, r["last"]) for r in found.collect()) == [("k0", 0, 0.0), ("k1", 0, 1.0)]


def test_append_keeps_open_windows_back(spark, tmp_path):
    path = str(tmp_path / "log")
    rows(spark, [0, 0, 1, 9]).coalesce(1).write.parquet(path)
    windows = feed.change_windows(feed.change_feed(spark, path, "ts"), "ts", "1 day", "1 day", ["key"])
    found = feed.run_to_end(windows, "w", "append")
    assert found.agg(F.sum("n")).first()[0] == 3
