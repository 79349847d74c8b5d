"""The digest tree against the plain two-way difference, and what it leaves unread."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakemason.operators import digests as D, setops as S

ROW = "k bigint, v string, w double"


def answer(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", [1, 3])
@pytest.mark.parametrize("fanout,leaf", [(4, 0), (4, 20), (1024, 100_000)])
def test_same_answer_as_comparing_all_rows(spark, seed, fanout, leaf):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, rnd.randint(-50, 50), 10**rnd.randint(0, 17)]), rnd.choice(["a", None, ""]), rnd.choice([0.5, None])) for _ in range(80)]
    other = [r for r in rows if rnd.random() > 0.1] + [rnd.choice(rows) for _ in range(rnd.choice([0, 3, 8]))]
    other += [] if seed == 3 else [(None, "new", 1.0), (rnd.randint(-60, 60), "new", None)]
    left, right = spark.createDataFrame(rows, ROW), spark.createDataFrame(other, ROW)
    for key in ("k", "v"):
        assert answer(D.reconcile_by_digest(left, right, key, counts=True, fanout=fanout, leaf_rows=leaf)) == answer(S.reconcile_counts(left, right))
        assert answer(D.reconcile_by_digest(left, right, key, fanout=fanout, leaf_rows=leaf)) == answer(S.reconcile(left, right))


def test_equal_and_empty_tables(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"), F.lit(1.0).alias("w"))
    found = D.differing(rows, rows.orderBy(F.rand(3)), "k")
    assert found.ranges == [] and len(found.levels) == 1
    none = rows.limit(0)
    assert D.reconcile_by_digest(none, none, "k").count() == 0
    assert D.reconcile_by_digest(none, rows, "k").count() == 1000
    swapped = rows.withColumn("v", F.when(F.col("k") == 5, F.lit(None)).otherwise(F.col("v")))
    assert D.reconcile_by_digest(rows, swapped, "k").count() == 2
    with pytest.raises(TypeError):
        D.differing(rows, rows.withColumn("k", F.col("k").cast("string")), "k")


def test_equal_ranges_are_neither_read_again_nor_shuffled(spark, tmp_path):
    base = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("v"), F.lit(1.0).alias("w"))
    base.repartitionByRange(20, "k").sortWithinPartitions("k").write.parquet(f"{tmp_path}/l")
    edited = base.withColumn("v", F.when(F.col("k").isin(77_777, 150_123), "changed").otherwise(F.col("v")))
    edited.repartitionByRange(20, "k").sortWithinPartitions("k").write.parquet(f"{tmp_path}/r")
    left, right = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    found = D.differing(left, right, "k", fanout=16, leaf_rows=500)
    assert [x["ranges"] for x in found.levels] == [1, 2, 2, 2] or [x["ranges"] for x in found.levels] == [2] * len(found.levels)
    # a level reads what the one before left
    assert all(b["rows_read"] == a["rows_left"] for a, b in zip(found.levels, found.levels[1:]))
    rows = D.suspects(left, "k", found)
    assert rows.count() <= 250
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k," in plan and "Exchange" not in plan
    compared = D.reconcile_by_digest(left, right, "k", counts=True, fanout=16, leaf_rows=500)
    assert sorted((r.k, r.diff_type) for r in compared.collect()) == [(k, t) for k in (77_777, 150_123) for t in ("ONLY_IN_PROD", "ONLY_IN_STAGING")]


def test_many_ranges_that_differ(spark):
    """More than are named in a filter: told apart by their numbers, equal neighbours left out."""
    left = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("v"), F.lit(1.0).alias("w"))
    right = left.withColumn("v", F.when(F.col("k") % 200 == 0, "y").otherwise(F.col("v")))
    found = D.differing(left, right, "k", fanout=1000, leaf_rows=0)
    assert len(found.ranges) == 100
    assert D.suspects(left, "k", found).count() == sum(b - a + 1 for a, b in found.ranges)
    assert len(found.bounds()) <= D.NAMED
    assert D.reconcile_by_digest(left, right, "k", fanout=1000, leaf_rows=0).count() == 200


def test_a_key_that_holds_most_rows(spark):
    """Digests are summed where rows are read: a hot key costs nothing until it differs."""
    left = spark.range(30_000).select(F.when(F.col("id") < 25_000, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 3).cast("string").alias("v"), F.lit(None).cast("double").alias("w"))
    right = left.filter("NOT (k = 29000)").unionAll(left.filter("k = 28000"))
    found = D.differing(left, right, "k", fanout=64, leaf_rows=100)
    assert found.levels[-1]["rows_left"] <= 100
    got = D.reconcile_by_digest(left, right, "k", counts=True, fanout=64, leaf_rows=100).collect()
    assert sorted((r.k, r.diff_type, r.surplus) for r in got) == [(28_000, "ONLY_IN_PROD", 1), (29_000, "ONLY_IN_STAGING", 1)]
