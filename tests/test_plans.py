"""The plans are the ones intended: filters reach the scan, no single-task windows over raw rows,
no pair-producing joins, limits before shuffles, buckets without shuffles."""

import re

import pytest

from lakemason import plans
from lakemason.plans.windowing import nth_rows
from lakemason.plans.registry import Tables

RAW_WINDOWS = ["win_rank", "win_percent_rank", "win_cume_dist", "win_numbered_lines", "win_running_total", "win_range_peers", "cte_steps", "prof_correlation"]


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def build(spark, sf_dir, name):
    return plan(plans.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name,pushed", [
    ("flt_eq", "EqualTo(o_orderstatus,F)"), ("flt_halfopen", "GreaterThanOrEqual(o_orderdate"), ("flt_like_suffix", "StringEndsWith(c_name,42)"),
    ("flt_or", "Or("), ("flt_row_value", "Or(LessThan(o_orderdate"), ("flt_in", "In(o_orderstatus"), ("page_keyset", "Or(LessThan(o_orderdate"),
    ("topk_filtered", "EqualTo(o_custkey,42)"), ("cte_inline", "GreaterThanOrEqual(o_orderdate"), ("prj_params", "EqualTo(o_custkey,42)"),
    ("lay_sorted", "GreaterThanOrEqual(o_orderdate"), ("lay_expression", "StringStartsWith(name_reversed,77)"),
])
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    assert pushed in build(spark, sf_dir, name)


@pytest.mark.parametrize("name", RAW_WINDOWS)
def test_no_window_over_raw_rows_in_one_task(spark, sf_dir, name):
    text = build(spark, sf_dir, name)
    # The only keyless window orders per-slice totals: one row per slice.
    for block in re.findall(r"\) Window\n(?:.*\n)*?\n", text):
        spec = re.search(r"windowspecdefinition\(([^,]*)", block).group(1)
        assert "__slice" in spec or "cust" in spec or "day" in spec, block


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - {"str_upsert", "str_dedupe", "str_daily_activity", "str_scd2", "dw_upsert_add"}))
def test_no_pair_producing_join(spark, sf_dir, name):
    """Every join has an equality to shuffle or broadcast on; one-row values are scalar subqueries."""
    text = build(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = build(spark, sf_dir, "agg_having_like")
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_totalprice:double>", text)


def test_group_limit_runs_before_the_shuffle(spark, sf_dir):
    text = plan(nth_rows(Tables(spark, sf_dir).orders, ["o_custkey"], ["-o_orderdate", "-o_orderkey"]))
    partial = text.index("WindowGroupLimit")
    assert text.count("WindowGroupLimit") >= 2 and "Exchange" in text[partial:]


def test_top_k_needs_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in build(spark, sf_dir, "topk")


def test_buckets_join_without_a_shuffle(spark, sf_dir):
    text = build(spark, sf_dir, "lay_merge_ready")
    join = text[text.index("SortMergeJoin"):]
    tree = join[: join.index("\n\n")]
    assert "Exchange" not in tree and "SelectedBucketsCount: 8 out of 8" in text


def test_bucket_pruning(spark, sf_dir):
    assert re.search(r"SelectedBucketsCount: [1-3] out of 8", build(spark, sf_dir, "lay_hash"))


def test_composite_layout_prunes_folders(spark, sf_dir):
    assert "PartitionFilters: [isnotnull(o_orderstatus" in build(spark, sf_dir, "lay_composite")
