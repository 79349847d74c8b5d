"""Snapshot tables and streams: atomic publish, replay safety, late and repeated rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lakemason.operators import merge as M
from lakemason.session import scratch
from lakemason.sources.snapshots import SnapshotTable
from lakemason.streaming import ingest as I

KEY = ["day", "k"]


def batch(spark, *rows):
    return spark.createDataFrame([(dt.date(2026, 1, d), k, v) for d, k, v in rows], "day date, k int, v long")


def add(now, new):
    return M.upsert_add(now, new, KEY, ["v"], check_source=False)


def content(table):
    return sorted((r["day"].day, r["k"], r["v"]) for r in table.read().collect())


def test_replay_changes_nothing_and_only_touched_partitions_are_written(spark):
    path = scratch(spark, "table")
    table = SnapshotTable(spark, path, spark.createDataFrame([], "day date, k int, v long").schema, "day")
    assert table.apply_once("b1", batch(spark, (1, 1, 10), (2, 1, 20)), add)
    assert table.apply_once("b2", batch(spark, (2, 1, 5), (2, 2, 7)), add)
    assert content(table) == [(1, 1, 10), (2, 1, 25), (2, 2, 7)]
    assert not table.apply_once("b2", batch(spark, (2, 1, 5), (2, 2, 7)), add)
    assert content(table) == [(1, 1, 10), (2, 1, 25), (2, 2, 7)]
    written = [n for n in os.listdir(f"{path.removeprefix('file:')}/v=2/data") if n.startswith("__part")]
    assert written == ["__part=2026-01-02"]
    assert sorted((r["day"].day, r["k"], r["v"]) for r in table.read(1).collect()) == [(1, 1, 10), (2, 1, 20)]


def test_unfinished_publish_is_invisible(spark):
    table = SnapshotTable(spark, scratch(spark, "table"), spark.createDataFrame([], "day date, k int, v long").schema)
    table.apply_once("b1", batch(spark, (1, 1, 10)), add)
    batch(spark, (9, 9, 9)).write.parquet(f"{table.path}/v=2/data/__part=all")  # died before its commit
    assert table.version() == 1 and content(table) == [(1, 1, 10)]
    table.apply_once("b2", batch(spark, (1, 1, 1)), add)
    assert content(table) == [(1, 1, 11)]


EVENTS = "id int, ts timestamp, kind string"


def deliver(spark, path, *rows):
    spark.createDataFrame([(i, dt.datetime(2026, 1, *t), k) for i, t, k in rows], EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_rows_later_than_the_watermark_are_not_counted(spark):
    path = scratch(spark, "landing")
    deliver(spark, path, (1, (1, 10), "a"), (2, (1, 11), "a"))
    deliver(spark, path, (3, (5, 10), "a"))
    deliver(spark, path, (7, (5, 10), "a"))  # rows are judged by the watermark of the batch before
    deliver(spark, path, (4, (1, 12), "a"), (5, (5, 11), "a"))  # the first one is four days late
    deliver(spark, path, (6, (9, 1), "a"))
    stream = I.file_stream(spark, path, spark.createDataFrame([], EVENTS).schema, files_per_batch=1)
    counts = I.daily_counts(stream, "ts", ["kind"], "1 day")
    table = SnapshotTable(spark, scratch(spark, "table"), counts.schema)
    change = lambda now, new: now.unionByName(new)
    I.run_batches(counts, table, change, scratch(spark, "progress")).awaitTermination()
    assert sorted((r["activity_date"].day, r["event_count"]) for r in table.read().collect()) == [(1, 2), (5, 3)]


def test_restarted_stream_continues_where_it_stopped(spark):
    path, progress = scratch(spark, "landing"), scratch(spark, "progress")
    schema = spark.createDataFrame([], EVENTS).schema
    table = SnapshotTable(spark, scratch(spark, "table"), spark.createDataFrame([], "kind string, n long, at timestamp").schema)
    change = I.accumulate(["kind"], {"n": F.lit(1).cast("long")}, F.col("ts"), "at")
    deliver(spark, path, (1, (1, 10), "a"), (2, (1, 11), "b"))
    I.run_batches(I.file_stream(spark, path, schema), table, change, progress).awaitTermination()
    deliver(spark, path, (3, (1, 9), "a"))
    for _ in range(2):
        I.run_batches(I.file_stream(spark, path, schema), table, change, progress).awaitTermination()
    assert sorted((r["kind"], r["n"], r["at"].hour) for r in table.read().collect()) == [("a", 2, 10), ("b", 1, 11)]


def test_latest_row_per_key_wins_within_a_batch(spark):
    path = scratch(spark, "landing")
    deliver(spark, path, (1, (1, 10), "old"), (1, (1, 12), "new"), (2, (1, 1), "x"))
    schema = spark.createDataFrame([], EVENTS).schema
    table = SnapshotTable(spark, scratch(spark, "table"), schema)
    change = I.upsert_latest(table, ["id"], ["ts"], ["ts", "kind"])
    I.run_batches(I.file_stream(spark, path, schema), table, change, scratch(spark, "progress")).awaitTermination()
    assert sorted((r["id"], r["kind"]) for r in table.read().collect()) == [(1, "new"), (2, "x")]
