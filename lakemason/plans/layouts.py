"""File layouts: write a copy that skips data, then answer from it. Answers equal the plain scan's."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from lakemason.functions.columns import literal, money
from lakemason.operators import layout as L
from lakemason.operators.topk import top_k
from lakemason.plans.registry import Tables, m, query
from lakemason.sources.sinks import scratch
from lakemason.sources.tables import schema_of

c = F.col


def _read(t: Tables, path: str, schema=None):
    return (t.spark.read.schema(schema) if schema else t.spark.read).parquet(path)


@query("lay_sorted", "int: o_orderkey o_custkey; float: o_totalprice", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'""")
def _(t: Tables):
    path = scratch(t.spark, "sorted")
    L.write_sorted(t.orders, path, ["o_orderdate"])
    return _read(t, path, schema_of("orders")).filter(
        (c("o_orderdate") >= literal(dt.datetime(1997, 3, 1))) & (c("o_orderdate") < literal(dt.datetime(1997, 4, 1))))


@query("lay_composite", "int: o_orderkey; text: o_orderstatus; float: o_totalprice", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-01-01'""")
def _(t: Tables):
    path = scratch(t.spark, "composite")
    L.write_composite(t.orders, path, ["o_orderstatus"], ["o_orderdate"])
    return _read(t, path, schema_of("orders")).filter((c("o_orderstatus") == "F") & (c("o_orderdate") >= literal(dt.datetime(2001, 1, 1))))


@query("lay_covering", "int: l_partkey; float: quantity revenue", f"""
    SELECT l_partkey, SUM({m('l_quantity')}) AS quantity, SUM({m('l_extendedprice')}) AS revenue FROM lineitem WHERE l_partkey < 100 GROUP BY 1""")
def _(t: Tables):
    path = scratch(t.spark, "covering")
    L.write_covering(t.lineitem, path, ["l_partkey", "l_quantity", "l_extendedprice"], ["l_partkey"])
    narrow = _read(t, path, "l_partkey bigint, l_quantity double, l_extendedprice double")
    return narrow.filter("l_partkey < 100").groupBy("l_partkey").agg(
        F.sum(money("l_quantity")).alias("quantity"), F.sum(money("l_extendedprice")).alias("revenue"))


def _bucketed(t: Tables, df, key: str, buckets: int = 8):
    name = f"lakemason_bucketed_{uuid.uuid4().hex[:12]}"
    L.write_bucketed(df, name, [key], buckets, scratch(t.spark, "bucketed"))
    return t.spark.table(name)


@query("lay_hash", "int: l_orderkey lines", "SELECT l_orderkey, COUNT(*) AS lines FROM lineitem WHERE l_orderkey IN (7, 42, 1234) GROUP BY 1")
def _(t: Tables):
    """Equality lookup that opens only the matching buckets."""
    return _bucketed(t, t.lineitem, "l_orderkey").filter(c("l_orderkey").isin(7, 42, 1234)).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))


@query("lay_bloom", "int: event_id user_id; text: event_type", "SELECT event_id, user_id, event_type FROM events WHERE user_id = 8")
def _(t: Tables):
    path = scratch(t.spark, "bloom")
    L.write_bloom(t.events, path, "user_id", 10_000)
    return _read(t, path, schema_of("events")).filter("user_id = 8")


@query("lay_partial", "int: o_orderkey; text: o_orderpriority", """
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '2001-06-01'""")
def _(t: Tables):
    path = scratch(t.spark, "partial")
    L.write_partial(t.orders, path, c("o_orderstatus") == "P", ["o_orderdate"])
    return _read(t, path, schema_of("orders")).filter(c("o_orderdate") >= literal(dt.datetime(2001, 6, 1)))


@query("lay_expression", "int: c_custkey; text: c_name", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%77'")
def _(t: Tables):
    """Suffix search as a prefix search on the stored reversed name."""
    path = scratch(t.spark, "expression")
    L.write_derived(t.customer, path, {"name_reversed": F.reverse("c_name"), "name_lower": F.lower("c_name")}, ["name_reversed"])
    return _read(t, path).filter(c("name_reversed").startswith("77"))


@query("lay_merge_ready", "int: o_custkey; float: revenue", f"""
    SELECT o_custkey, SUM({m('l_extendedprice')}) AS revenue FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""")
def _(t: Tables):
    """Both sides in the same buckets: the join needs no shuffle."""
    orders, lines = _bucketed(t, t.orders, "o_orderkey"), _bucketed(t, t.lineitem, "l_orderkey")
    joined = orders.hint("merge").join(lines, c("l_orderkey") == c("o_orderkey"))
    totals = joined.groupBy("o_custkey").agg(F.sum(money("l_extendedprice")).alias("revenue"))
    return top_k(totals, ["-revenue", "o_custkey"], 50)
