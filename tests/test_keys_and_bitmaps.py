"""Keys by bucket counts, best details by one aggregate, dimension loads, bitmaps, typed key checks, keyed tables."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemason.operators import bitmaps as B, quality as Q, warehouse as W
from lakemason.session import scratch
from lakemason.sources.snapshots import SnapshotTable


def test_keys_by_bucket_are_dense_stable_and_need_no_range_sort(spark):
    names = spark.range(500).select(F.concat(F.lit("n"), "id").alias("n")).unionAll(spark.createDataFrame([(None,)], "n string"))
    first = W.assign_keys_by_bucket(names.unionAll(names), ["n"], "sk", buckets=7)
    again = W.assign_keys_by_bucket(names.repartition(5), ["n"], "sk", buckets=7)
    assert sorted(r.sk for r in first.collect()) == list(range(1, 502))
    assert first.exceptAll(again).count() == 0
    more = W.assign_keys_by_bucket(names.unionAll(spark.createDataFrame([("new",), ("newer",)], "n string")), ["n"], "sk", first, buckets=7)
    assert first.exceptAll(more).count() == 0 and sorted(r.sk for r in more.collect()) == list(range(1, 504))
    assert "rangepartitioning" not in more._jdf.queryExecution().executedPlan().toString().lower()
    assert W.assign_keys_by_bucket(names.limit(0), ["n"], "sk").count() == 0


def test_best_per_key_equals_the_window(spark):
    rnd = random.Random(6)
    pick = lambda *v: rnd.choice([None, *v])
    rows = [(rnd.choice([1, 2, 3, None]), pick(True, False), pick(dt.datetime(2024, 1, 2), dt.datetime(2024, 5, 6, 7)), pick(dt.date(2024, 1, 1), dt.date(2023, 1, 1)),
             pick(1.5, -2.0), pick("a", "b"), i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, flag boolean, at timestamp_ntz, day date, x double, s string, id int")
    for order in (["-flag", "-at", "id"], ["-day", "s", "-x", "-id"], ["flag", "at", "-id"], ["x", "-id"]):
        want = W.best_row(df, ["k"], order).select("k", "id").collect()
        got = W.best_per_key(df, ["k"], order, ["id"]).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str), order
    plan = W.best_per_key(df, ["k"], ["-flag", "id"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min_by" in plan
    with pytest.raises(TypeError):
        W.best_per_key(df, ["k"], ["-s"], ["id"])


def test_best_detail_falls_back_and_loads_keep_keys(spark):
    details = spark.createDataFrame([(1, "home", True, 1), (1, "work", False, 9), (2, "old", False, 1), (2, "new", None, 2), (None, "lost", True, 1), (4, None, True, 5)], "c int, city string, main boolean, n int")
    people = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (None, "e")], "id int, name string")
    got = W.with_best(people, details, [("id", "c")], F.col("main"), ["-n"], {"city": "nowhere"}, "how")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a", "home", "default"), (2, "b", "new", "newest"), (3, "c", "nowhere", "none"), (4, "d", "nowhere", "default"), (None, "e", "nowhere", "none")]
    member = {"sk": -1, "name": "Unknown"}
    stored = W.with_unknown(spark.createDataFrame([(7, 2, "before"), (9, 5, "gone")], "sk bigint, id int, name string"), member)
    state = W.load_dimension(stored, people.na.drop(), ["id"], "sk")
    assert sorted(map(tuple, state.collect())) == [(-1, None, "Unknown"), (7, 2, "b"), (9, 5, "gone"), (10, 1, "a"), (11, 3, "c"), (12, 4, "d")]
    assert sorted(map(tuple, W.load_dimension(state, people.na.drop(), ["id"], "sk").collect())) == sorted(map(tuple, state.collect()))


def test_bitmap_counts_are_exact_at_every_level(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", None]), rnd.randint(1, 4), rnd.choice([None, -5, 0, 1, rnd.randint(1, 200_000)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, d int, id bigint")
    stored = B.id_bitmaps(df, ["g", "d"], "id")
    known = df.filter("id IS NOT NULL")
    for keys in (["g", "d"], ["g"], ["d"], []):
        want = known.groupBy(*keys).agg(F.count_distinct("id").alias("n_distinct"), F.count("id").alias("row_count")).collect()
        assert sorted(map(tuple, B.distinct_counts(stored, keys).collect()), key=str) == sorted(map(tuple, want), key=str)
    levels = B.distinct_by_levels(stored, [["g", "d"], ["g"], []])
    assert levels.filter("level = 3").first().n_distinct == known.select("id").distinct().count()
    assert "Expand" not in levels._jdf.queryExecution().executedPlan().toString()


def test_orphans_compare_keys_in_their_common_type(spark):
    child = spark.createDataFrame([(1.0, 1, "1", Decimal("1.50"), 7), (2.0, 2, "x", Decimal("2.00"), None), (2.5, None, None, None, 9)], "a double, b int, s string, d decimal(10,2), z smallint")
    ids = spark.createDataFrame([(1,), (2,), (7,)], "id bigint")
    names = spark.createDataFrame([("x",), (None,)], "id string")
    halves = spark.createDataFrame([(1.5,)], "id float")
    got = Q.orphans(child, {"a": ("a", ids, "id"), "b": ("b", ids, "id"), "s": ("s", names, "id"), "d": ("d", ids, "id"), "z": ("z", ids, "id"), "h": ("d", halves, "id")}).collect()
    assert {r.check_name: (r.orphans, r.status) for r in got} == {"a": (1, "FAIL"), "b": (0, "PASS"), "s": (1, "FAIL"), "d": (1, "FAIL"), "z": (1, "FAIL"), "h": (1, "FAIL")}
    with pytest.raises(TypeError):
        Q.orphans(child, {"bad": ("s", ids, "id")})


def test_a_partition_that_does_not_follow_from_the_key_is_refused(spark):
    from lakemason.streaming.ingest import upsert_latest

    schema = spark.createDataFrame([], "k int, d string, v int").schema
    for good in ("k", "pmod(xxhash64(k), 4)", None):
        SnapshotTable(spark, scratch(spark, "t"), schema, good, ["k"])
    with pytest.raises(ValueError, match="outside of the key"):
        SnapshotTable(spark, scratch(spark, "t"), schema, "d", ["k"])
    with pytest.raises(ValueError, match="outside of the key"):
        upsert_latest(SnapshotTable(spark, scratch(spark, "t"), schema, "concat(d, k)"), ["k"], ["v"], ["v"])
    SnapshotTable(spark, scratch(spark, "t"), schema, "d", ["k", "d"])


def test_a_null_key_matches_nothing(spark):
    from lakemason.operators.merge import upsert_replace

    state = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "b"), (None, "n")], "k int, v string")
    for expected in ([(1, "b"), (None, "n")], [(1, "b"), (None, "n"), (None, "n")]):
        state = upsert_replace(state, batch, ["k"], ["v"])
        assert sorted(map(tuple, state.collect()), key=str) == expected
