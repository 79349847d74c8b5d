"""Split plans must give exactly what the plain window gives, hot key and NULL key included."""

import pytest
from pyspark.sql import Window, functions as F

from lakemason.operators import ordered as O
from lakemason.functions.columns import order_columns

SPLIT = {"max_group_rows": 0, "slices": 5}


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds most rows, one key is NULL, values tie heavily and are sometimes NULL."""
    base = spark.range(400).select(
        "id",
        F.when(F.col("id") % 3 != 0, F.lit("hot")).when(F.col("id") % 30 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.pmod(F.xxhash64("id"), F.lit(9))).cast("int").alias("v"),
    )
    return base.cache()


def same(left, right):
    cols = sorted(left.columns)
    assert sorted(right.columns) == cols
    key = lambda r: tuple(str(x) for x in r)
    a = sorted((tuple(r) for r in left.select(*cols).collect()), key=key)
    b = sorted((tuple(r) for r in right.select(*cols).collect()), key=key)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y) if all(isinstance(z, float) for z in x) else _close(x, y), (x, y)


def _close(x, y):
    return all(p == pytest.approx(q) if isinstance(p, float) else p == q for p, q in zip(x, y))


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", [["v", "id"], ["-v", "-id"], ["id"]])
def test_running(rows, keys, order):
    measures = {
        "s": ("sum", F.col("v")), "c": ("count", F.col("v")), "n": ("count", F.lit(1)),
        "hi": ("max", F.col("v")), "lo": ("min", F.col("v")), "l": ("last", F.col("v")),
    }
    w = Window.partitionBy(*keys).orderBy(*order_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.select("*", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("c"),
                        F.count(F.lit(1)).over(w).alias("n"), F.max("v").over(w).alias("hi"),
                        F.min("v").over(w).alias("lo"), F.last("v", True).over(w).alias("l"))
    same(O.running(rows, keys, order, measures, **SPLIT), plain)
    open_ended = O.running(rows, keys, order, measures, inclusive=False, bounded=True)
    same(O.running(rows, keys, order, measures, inclusive=False, **SPLIT), open_ended)


@pytest.mark.parametrize("keys", [["k"], []])
def test_framed(rows, keys):
    def columns(w):
        return {"p": F.lag("v", 2, -1).over(w), "q": F.lead("id").over(w),
                "m": F.avg("v").over(w.rowsBetween(-3, 1))}
    w = Window.partitionBy(*keys).orderBy(*order_columns(["v", "id"]))
    split = O.framed(rows, keys, ["v", "id"], columns, before=3, after=1, block_rows=7, **SPLIT)
    same(split, rows.withColumns(columns(w)))


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", [["v"], ["-v"]])
def test_value_ranks(rows, keys, order):
    ranks = {"r": "rank", "d": "dense_rank", "p": "percent_rank", "c": "cume_dist"}
    plain = O.value_ranks(rows, keys, order, ranks, bounded=True)
    same(O.value_ranks(rows, keys, order, ranks, **SPLIT), plain)


@pytest.mark.parametrize("n", [1, 3, 4, 50, 500])
def test_buckets(rows, n):
    same(O.buckets(rows, ["k"], ["v", "id"], n, **SPLIT), O.buckets(rows, ["k"], ["v", "id"], n, bounded=True))


def test_bucket_sizes_of_ten(spark):
    df = O.buckets(spark.range(10), [], ["id"], 4, slices=3)
    assert [r["count"] for r in df.groupBy("bucket").count().orderBy("bucket").collect()] == [3, 3, 2, 2]


def test_peers_running(rows):
    w = Window.partitionBy("k").orderBy(*order_columns(["v"]))
    split = O.peers_running(rows, ["k"], ["v"], F.col("id"), "s", **SPLIT)
    same(split, rows.withColumn("s", F.sum("id").over(w)))


def test_only_large_groups_split(rows):
    assert O.largest_group(rows, ["k"]) > 200
    assert not O.must_split(rows, ["k"], None, False)
    assert O.must_split(rows, ["k"], 100, False)
    assert O.must_split(rows, [], None, False)


def test_nth_rows_limits_before_the_shuffle(rows):
    df = O.nth_rows(rows, ["k"], ["-v", "id"], 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert df.count() == rows.groupBy("k").count().filter("count >= 2").count()


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "decimal(18,2)", "decimal(38,10)"])
def test_split_and_plain_have_one_schema(spark, kind):
    df = spark.range(6).select("id", (F.lit(0.0000000001).cast("decimal(38,10)") if kind == "decimal(38,10)" else F.lit(1)).cast(kind).alias("v"))
    measures = {"s": ("sum", F.col("v")), "c": ("count", F.col("v")), "hi": ("max", F.col("v")), "l": ("last", F.col("v"))}
    for inclusive in (True, False):
        plain = O.running(df, [], ["id"], measures, bounded=True, inclusive=inclusive)
        split = O.running(df, [], ["id"], measures, slices=3, inclusive=inclusive)
        assert split.dtypes == plain.dtypes
        assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_split_path_shuffles_rows_once_after_the_range_step(rows):
    plan = O.running(rows, ["k"], ["v", "id"], {"s": ("sum", F.col("v"))}, **SPLIT)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning(") <= 3  # totals, their window, the rows


def test_last_value_skips_nulls_across_slices(spark):
    df = spark.range(40).select("id", F.when(F.col("id").isin(3, 17), F.col("id")).alias("v"))
    got = {r["id"]: r["l"] for r in O.running(df, [], ["-id"], {"l": ("last", F.col("v"))}, slices=6).collect()}
    assert got == {i: 3 if i <= 3 else 17 if i <= 17 else None for i in range(40)}
