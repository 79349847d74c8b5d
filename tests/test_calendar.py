"""The calendar covers every date of the data; an order without a date comes back whole."""

import os

import pytest
from pyspark.sql import functions as F

from lakemason import plans
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def shifted(spark, sf_dir, tmp_path_factory):
    """The tables with one order before 1995, one after 2001, one without a date, and a shipment after 2001."""
    folder = tmp_path_factory.mktemp("shifted")
    for name in os.listdir(sf_dir):
        if name not in ("orders.parquet", "lineitem.parquet"):
            os.symlink(f"{sf_dir}/{name}", folder / name)
    orders, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem"))
    keys = [r[0] for r in lines.select("l_orderkey").distinct().orderBy("l_orderkey").limit(3).collect()]
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    k = F.col("o_orderkey")
    date = F.when(k == keys[0], day("1980-02-29")).when(k == keys[1], day("2010-05-05")).when(k != keys[2], F.col("o_orderdate"))
    orders.withColumn("o_orderdate", date).write.parquet(str(folder / "orders.parquet"))
    late = F.when(F.col("l_orderkey") == keys[1], day("2011-01-02")).otherwise(F.col("l_shipdate"))
    lines.withColumns({"l_shipdate": late, "l_returnflag": F.when(F.col("l_orderkey") == keys[1], "R").otherwise(F.col("l_returnflag"))}).write.parquet(
        str(folder / "lineitem.parquet"))
    return str(folder), keys, orders.count()


def test_role_views_keep_every_order(spark, shifted):
    folder, keys, n = shifted
    got = {r.o_orderkey: r for r in plans.queries()["dw_role_views"](spark, folder).collect()}
    assert len(got) == n
    assert [(got[k].order_date_key, got[k].order_date, got[k].order_month) for k in keys] == [
        (19800229, "1980-02-29", "February"), (20100505, "2010-05-05", "May"), (-1, "1900-01-01", "Unknown")]


def test_facts_and_reports_keep_the_day(spark, shifted):
    folder, keys, _ = shifted
    fact = plans.queries()["dw_fact_sales"](spark, folder).filter(F.col("l_orderkey").isin(keys)).select("l_orderkey", "order_date_fk").distinct()
    assert sorted(map(tuple, fact.collect())) == sorted(zip(keys, [19800229, 20100505, -1]))
    years = {r.fiscal_year for r in plans.queries()["dw_bi_fiscal"](spark, folder).collect()}
    assert {1980, 2010} <= years


def test_roles_of_lines_keep_the_day(spark, shifted):
    folder, keys, _ = shifted
    got = {(r.ordered_on, r.shipped_on) for r in plans.queries()["join_role"](spark, folder).filter(F.col("l_orderkey") == keys[1]).collect()}
    assert got == {("2010-05-05", "2011-01-02")}


@pytest.mark.parametrize("name", ["dw_dim_date", "dw_role_views", "dw_fact_sales", "dw_bi_fiscal"])
def test_twins_follow_the_same_days(spark, shifted, name):
    folder, _, _ = shifted
    assert compare(plans.queries()[name](spark, folder), connect(folder), plans.oracle_sql()[name]) is None


def test_tables_without_dates_have_one_day(spark, sf_dir):
    from lakemason.operators import warehouse as W

    none = spark.read.parquet(f"{sf_dir}/orders.parquet").limit(0)
    assert W.date_bounds((none, "o_orderdate")) == (W.NO_DATE, W.NO_DATE)
