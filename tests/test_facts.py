"""Loads of line facts: rows stay with their order, and the forms that keep them there equal the plain ones."""

import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemason import plans
from lakemason.operators import merge as M, warehouse as W


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(df):
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_sales_lines_are_shuffled_by_product_and_order_only(spark, sf_dir, no_broadcast):
    seen = Counter(shuffles(plans.queries()["dw_fact_sales"](spark, sf_dir)))
    # of the first load and of the correction: lines by product, lines and headers by order, headers by customer
    assert seen["l_partkey"] == 2 and seen["l_orderkey"] == 2 and seen["o_orderkey"] == 2 and seen["source_key"] == 2
    assert not [keys for keys in seen if "line_id" in keys or "l_orderkey, " in keys]


def test_merge_within_groups_equals_the_merge_by_all_keys(spark, no_broadcast):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "b2"), (2, 1, "c"), (None, 1, "d"), (3, None, "e")], "o int, n int, v string")
    source = spark.createDataFrame([(1, 2, "B"), (1, 2, "B2"), (1, 3, "C"), (4, 1, "D"), (None, 1, "N"), (3, None, "E")], "o int, n int, v string")
    grouped = [df.withColumn("w", F.count("v").over(W.Window.partitionBy("o"))) for df in (target, source)]
    plain = M.upsert_replace(*grouped, ["o", "n"], ["v"], check_source=False)
    within = M.upsert_replace(*grouped, ["o", "n"], ["v"], check_source=False, grouped_by=["o"])
    assert bag(within) == bag(plain) and within.count() == 12
    assert shuffles(plain).count("o, n") == 2 and shuffles(within) == ["o", "o"]


def test_found_keys_are_one_row_until_they_are_settled(spark):
    fact = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30), (5, None), (5, None)], "id int, part int")
    dim = spark.createDataFrame([(10, 100, "x"), (20, 200, "y"), (20, 200, "y"), (20, 200, None), (None, -1, "unknown")], "p int, sk long, cost string")
    found = W.find_keys(fact, dim, [("part", "p")], "sk", "found", {"cost": "unit_cost"})
    assert found.count() == 6 and found.columns == ["id", "part", "found"]
    settled = W.settle_keys(found, "found", "fk", ["unit_cost"]).select("id", "part", "fk", "unit_cost")
    plain = W.lookup_key(fact, dim, [("part", "p")], "sk", "fk", {"cost": "unit_cost"}).select("id", "part", "fk", "unit_cost")
    assert bag(settled) == bag(plain) and settled.count() == 8


def test_shares_within_headers_equal_those_by_join(spark, no_broadcast):
    rows = [(1, 1, "10.00", "7.77"), (1, 2, "20.00", "7.77"), (1, 2, "20.00", "7.77"), (2, 1, "0.00", "5.00"), (2, 2, None, "5.00"), (None, 1, "3.00", "1.00"), (None, 2, "4.00", "1.00")]
    lines = spark.createDataFrame([(h, n, w and Decimal(w), Decimal(a)) for h, n, w, a in rows], "h int, n int, w decimal(18,2), amount decimal(18,2)")
    for options in ({}, {"residual": "largest", "tie_break": ["n"]}):
        plain = W.allocate(lines, ["h"], "w", {"amount": "part"}, **options)
        bounded = W.allocate(lines, ["h"], "w", {"amount": "part"}, bounded=True, **options)
        assert bag(bounded) == bag(plain) and bounded.schema == plain.schema
    assert len(shuffles(W.allocate(lines, ["h"], "w", {"amount": "part"}, bounded=True))) == 1
