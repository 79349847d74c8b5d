"""Profiles kept by partition: stated errors against exact counts, and what an update reads."""

import shutil

import pytest
from pyspark.sql import functions as F

from lakemason.operators import quality as Q, sketches as K

COLUMNS = ["user", "amount", "kind", "day", "nothing"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('table')}/t"
    rows = spark.range(60_000).select(
        (F.col("id") % 3).cast("string").alias("month"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("user"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) / 100).alias("amount"),
        F.when(F.col("id") % 10 < 3, None).otherwise(F.concat(F.lit("k"), (F.sqrt("id") % 7).cast("int").cast("string"))).alias("kind"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 300).cast("int")).alias("day"), F.lit(None).cast("double").alias("nothing"))
    rows.repartition(3).write.partitionBy("month").parquet(path)
    return path


@pytest.fixture(scope="module")
def profiles(spark, table, tmp_path_factory):
    store = K.PartitionProfiles(spark, f"{tmp_path_factory.mktemp('store')}/p", "month")
    assert store.labels() == set()
    assert store.update(spark.read.parquet(table), COLUMNS) == ["0", "1", "2"]
    return store


def test_errors_hold_against_exact_forms(spark, table, profiles):
    rows = spark.read.parquet(table)
    exact = {r.column_name: r for r in Q.profile(rows, COLUMNS).collect()}
    for r in profiles.columns().collect():
        e = exact[r.column_name]
        assert r.row_count == e.row_count == 60_000 and r.null_frac == pytest.approx(float(e.null_frac), abs=1e-4)
        assert abs(r.n_distinct - e.n_distinct) <= 4 * K.DISTINCT_ERROR * e.n_distinct
        assert (r.avg_width is None and e.avg_width is None) or r.avg_width == pytest.approx(float(e.avg_width), abs=0.01)
    points = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = profiles.quantiles(points).collect()
    assert {r.column_name for r in got} == {"user", "amount", "day"}
    numbers = rows.select("user", "amount", F.unix_date("day").alias("day"))
    for r in got:
        below, upto = numbers.agg(F.mean((F.col(r.column_name) < r.value).cast("int")), F.mean((F.col(r.column_name) <= r.value).cast("int"))).first()
        assert below - 2 * K.RANK_ERROR <= r.point <= upto + 2 * K.RANK_ERROR
    common = Q.common_values(rows.select("kind"), ["kind"], 5).collect()
    same = [r for r in profiles.common_values(5).collect() if r.column_name == "kind"]
    assert [(r.value_rank, r.value, r.row_count) for r in sorted(same)] == [(r.value_rank, r.value, r.row_count) for r in sorted(common)]
    users = {r["user"]: r["count"] for r in rows.groupBy("user").count().collect()}
    for r in profiles.common_values(20).filter("column_name = 'user'").collect():
        assert abs(users[int(r.value)] - r.row_count) <= K.COUNT_ERROR * 60_000


def test_an_update_reads_the_new_partition_only(spark, table, profiles, tmp_path):
    copy = f"{tmp_path}/t"
    shutil.copytree(table, copy)
    store = K.PartitionProfiles(spark, f"{tmp_path}/p", "month")
    assert store.update(spark.read.parquet(copy), COLUMNS, ["0", "1"]) == ["0", "1"]
    for old in ("0", "1"):  # unreadable from now on
        for part in (tmp_path / "t" / f"month={old}").glob("*.parquet"):
            part.write_bytes(b"no parquet")
    schema = spark.read.parquet(table).schema
    assert store.update(spark.read.schema(schema).parquet(copy), COLUMNS, ["2"]) == ["2"]
    assert store.labels() == {"0", "1", "2"}
    order = ["column_name"]
    assert store.columns().orderBy(order).drop("n_distinct").collect() == profiles.columns().orderBy(order).drop("n_distinct").collect()
    assert store.columns(["2"]).filter("column_name = 'user'").first().row_count == 20_000


def test_a_partition_profiled_again_is_replaced_and_rows_without_label_count(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "p string, v int")
    store = K.PartitionProfiles(spark, f"{tmp_path}/p", "p")
    assert store.update(rows, ["v"]) == [K.NO_LABEL, "a", "b"]
    assert store.update(rows, ["v"]) == []
    assert store.columns().first().row_count == 4 and store.columns([K.NO_LABEL]).first().row_count == 1
    store.update(rows.filter("v = 1"), ["v"], ["a"])
    assert store.columns().first().row_count == 3
    assert store.update(rows.limit(0), ["v"]) == []
    with pytest.raises(FileNotFoundError):
        K.PartitionProfiles(spark, f"{tmp_path}/none", "p").columns()
