"""Timings on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

``r01``..``r10`` are the ten rewrites with their layouts prepared beforehand (as indexes would be);
the other names are registered queries, run whole. Each is run once to warm up, then timed.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from lakemason import plans  # noqa: E402
from lakemason.functions.columns import after_row, day_range, money, typed_equals  # noqa: E402
from lakemason.operators import joins as J, layout as L, topk as K  # noqa: E402
from lakemason.operators.ordered import attach  # noqa: E402
from lakemason.plans.registry import Tables  # noqa: E402
from lakemason.session import local_session, scratch  # noqa: E402

QUERIES = [
    "agg_basic", "agg_distinct", "agg_pivot", "agg_case", "win_row_number", "win_dense_rank", "win_percent_rank", "win_cume_dist",
    "win_ntile", "win_lag", "win_lead", "win_running_total", "win_moving_avg", "win_pct_total", "win_latest_attr", "join_3nf", "join_star",
    "join_semi", "join_anti", "join_anti_notin", "join_asof_point", "join_preagg", "set_reconcile", "rec_rollup", "gap_fill",
    "dq_orphans", "dq_check", "prof_columns", "prof_histogram", "dw_merge", "dw_upsert_changed", "dw_scd2", "dw_allocate",
    "dw_fact_sales", "dw_fact_accumulating", "dw_bi_month_geo", "topk", "page_keyset",
]


def rewrites(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The ten rewritten queries over prepared layouts."""
    t, c = Tables(spark, folder), F.col
    at = {name: scratch(spark, name) for name in ("by_date", "by_name", "by_code", "by_part", "by_status", "by_customer", "lines")}
    L.write_sorted(t.orders, at["by_date"], ["o_orderdate"], 8)
    L.write_derived(t.customer, at["by_name"], {"reversed": F.reverse("c_name"), "code": c("c_custkey").cast("string")}, ["reversed"])
    L.write_derived(t.customer, at["by_code"], {"code": c("c_custkey").cast("string")}, ["code"])
    with_header = t.lineitem.join(t.orders, c("o_orderkey") == c("l_orderkey"))  # the copy covers the header's columns too
    covered = ["l_partkey", "l_orderkey", "l_quantity", "l_extendedprice", *t.orders.columns]
    L.write_covering(with_header, at["by_part"], covered, ["l_partkey", "l_orderkey"])
    L.write_composite(t.orders, at["by_status"], ["o_orderstatus"], ["-o_orderdate", "-o_orderkey"], 8)
    L.write_sorted(t.orders, at["by_customer"], ["o_custkey", "o_orderpriority"], 8)
    L.write_sorted(t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice"), at["lines"], ["l_orderkey"], 8)
    read = {name: spark.read.parquet(path) for name, path in at.items()}

    customers, orders, lines = read["by_name"], read["by_customer"], read["lines"]
    mine = orders.filter("o_custkey = 42").select("o_orderkey", "o_custkey")
    items = lines.join(mine, c("l_orderkey") == c("o_orderkey")).agg(F.sum("l_quantity").alias("items"))
    audits = t.events.filter("user_id = 42").agg(F.count(F.lit(1)).alias("events"))
    spend = orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spend"))
    vip = customers.filter("c_mktsegment = 'BUILDING'").join(spend, c("c_custkey") == c("o_custkey"), "left").fillna(0, ["spend"])
    order = ["-o_orderdate", "-o_orderkey"]
    page = K.page_after(read["by_status"].filter("o_orderstatus = 'F'"), order, [dt.datetime(1998, 6, 1), 5000], 20)
    cancelled = orders.filter("o_orderstatus = 'P' AND o_totalprice > 400000")
    wanted = t.orders.filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderpriority")
    return {
        "r01_date_range": read["by_date"].filter(day_range("o_orderdate", dt.datetime(1997, 6, 15), dt.datetime(1997, 6, 16))),
        "r02_suffix": customers.filter(c("reversed").startswith("24")),
        "r03_typed_literal": read["by_code"].filter(typed_equals(read["by_code"], "code", 500)),
        "r04_preaggregated": attach(items, audits),
        "r05_join_not_subquery": K.top_k(vip, ["-spend", "c_custkey"], 50),
        "r06_keyset_page": page,
        "r07_not_exists": J.not_exists_in(t.customer, cancelled, [("c_custkey", "o_custkey")]),
        "r08_distinct": orders.select("o_custkey", "o_orderpriority").distinct(),
        "r09_covering": read["by_part"].filter("l_partkey = 450"),
        "r10_correlated": lines.join(wanted, c("l_orderkey") == c("o_orderkey")).groupBy("o_orderpriority").agg(
            F.count(F.lit(1)).alias("items"), F.sum(c("l_quantity") * c("l_extendedprice")).alias("value")),
    }


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, repeats: int) -> float:
    run()
    best = float("inf")
    for _ in range(repeats):
        begin = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - begin)
    return round(best, 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    results = {name: timed(lambda df=df: drain(df), 3) for name, df in rewrites(spark, folder).items()}
    registered = plans.queries()
    for name in QUERIES:
        results[name] = timed(lambda run=registered[name]: drain(run(spark, folder)), 1)
    print(json.dumps({
        "metric": "total seconds over all bench queries (best warm run each)", "value": round(sum(results.values()), 3),
        "unit": "sec", "queries": results, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
