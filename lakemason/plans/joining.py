"""Join queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakemason.functions.columns import date_key, literal, money, ratio
from lakemason.operators import joins as J
from lakemason.operators.ordered import attach
from lakemason.operators.scd import history
from lakemason.operators.warehouse import date_bounds, dim_date
from lakemason.plans.registry import Tables, m, query, r

c = F.col
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LINE = "int: l_orderkey l_linenumber l_partkey l_suppkey"


@query("join_inner", _LINE + "; text: c_name", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def _(t: Tables):
    return t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).join(
        t.customer.filter("c_mktsegment = 'BUILDING'"), c("o_custkey") == c("c_custkey"))


@query("join_left", "text: day; int: orders_count", """
    SELECT CAST(d AS DATE) AS day, COALESCE(n, 0) AS orders_count FROM (SELECT unnest(generate_series(
      TIMESTAMP '1996-01-01', TIMESTAMP '1996-12-31', INTERVAL 1 DAY)) AS d) LEFT JOIN (
      SELECT o_orderdate, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON d = o_orderdate""")
def _(t: Tables):
    from lakemason.sources.tables import days
    daily = t.orders.filter("o_orderstatus = 'F'").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("orders_count"))
    return J.left_join_default(days(t.spark, "1996-01-01", "1996-12-31"), daily, ["day"], {"orders_count": 0})


@query("join_left_cond", "int: c_custkey o_orderkey", """
    SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 450000""")
def _(t: Tables):
    return t.customer.join(t.orders, (c("c_custkey") == c("o_custkey")) & (c("o_totalprice") > 450000), "left")


@query("join_3nf", "text: p_type r_name; float: revenue; int: suppliers", f"""
    SELECT p_type, r.r_name, SUM({m('l_extendedprice')}) AS revenue, COUNT(DISTINCT s_suppkey) AS suppliers
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
      LEFT JOIN nation n ON n.n_nationkey = c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
      JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
      LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey
    WHERE EXTRACT(quarter FROM o_orderdate) = 1 AND EXTRACT(year FROM o_orderdate) = 1997 GROUP BY 1, 2""")
def _(t: Tables):
    """The quarter is written as a half-open range, so it reaches the scan of orders."""
    quarter = t.orders.filter((c("o_orderdate") >= literal(dt.datetime(1997, 1, 1))) & (c("o_orderdate") < literal(dt.datetime(1997, 4, 1))))
    places = t.nation.join(t.region, c("n_regionkey") == c("r_regionkey"), "left")
    return (
        quarter.join(t.lineitem, c("l_orderkey") == c("o_orderkey"))
        .join(t.customer, c("c_custkey") == c("o_custkey"))
        .join(places.select("n_nationkey", "r_name"), c("n_nationkey") == c("c_nationkey"), "left")
        .join(t.part, c("p_partkey") == c("l_partkey"))
        .join(t.supplier, c("s_suppkey") == c("l_suppkey"))
        .join(t.nation.select(c("n_nationkey").alias("sn_key"), c("n_name").alias("supplier_nation")), c("sn_key") == c("s_nationkey"), "left")
        .groupBy("p_type", "r_name")
        .agg(F.sum(money("l_extendedprice")).alias("revenue"), F.count_distinct("s_suppkey").alias("suppliers"))
    )


_SHARE = "text: n_name; int: lines; float: revenue share_pct"
_SHARE_SQL = f"""SELECT n_name, COUNT(*) AS lines, SUM({m('l_extendedprice')}) AS revenue,
    {r(f"SUM({m('l_extendedprice')} * {m('l_discount')}) / NULLIF(SUM({m('l_extendedprice')}), 0) * 100")} AS share_pct
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1"""


def _share(joined):
    price = money("l_extendedprice")
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("lines"), F.sum(price).alias("revenue"),
                                        ratio(F.sum(price * money("l_discount")), F.sum(price), 2, 100).alias("share_pct"))


@query("join_snowflake", _SHARE, _SHARE_SQL)
def _(t: Tables):
    return _share(t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey")).join(t.nation, c("s_nationkey") == c("n_nationkey")))


@query("join_star", _SHARE, _SHARE_SQL)
def _(t: Tables):
    """The same report with the nation flattened into the supplier dimension: one hop from the fact."""
    flat = t.supplier.join(t.nation, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", "n_name")
    return _share(t.lineitem.join(flat, c("l_suppkey") == c("s_suppkey")))


@query("join_self_hier", "text: child parent", """
    SELECT n_name AS child, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def _(t: Tables):
    from lakemason.plans.hierarchies import places
    nodes = places(t)
    child, parent = nodes.alias("child"), nodes.alias("parent")
    return child.join(parent, c("child.parent_id") == c("parent.id")).select(
        c("child.name").alias("child"), c("parent.name").alias("parent"))


@query("join_cross", "int: p_partkey; float: above_mean", f"""
    SELECT p_partkey, {r(f"{m('p_retailprice')} - mean", 4)} AS above_mean FROM part,
      (SELECT {r(f"SUM({m('p_retailprice')}) / COUNT(*)", 4)} AS mean FROM part)""")
def _(t: Tables):
    mean = t.part.agg(ratio(F.sum(money("p_retailprice")), F.count(F.lit(1)), 4).alias("mean"))
    return attach(t.part, mean).withColumn("above_mean", money("p_retailprice") - c("mean"))


@query("join_theta_rank", "int: p_partkey dearer; text: p_brand", """
    SELECT a.p_partkey, COUNT(b.p_partkey) AS dearer, a.p_brand FROM part a LEFT JOIN part b
      ON a.p_brand = b.p_brand AND b.p_retailprice > a.p_retailprice GROUP BY 1, 3""")
def _(t: Tables):
    """How many parts of the brand cost more, without building the pairs."""
    return J.count_below(t.part, ["p_brand"], "-p_retailprice", "dearer")


@query("join_semi", "int: c_custkey; text: c_name", """
    SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      WHERE o_custkey = c_custkey AND l_returnflag = 'R' AND l_quantity > 45)""")
def _(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 45")
    return J.exists_in(t.customer, J.exists_in(t.orders, returned, [("o_orderkey", "l_orderkey")]), [("c_custkey", "o_custkey")])


_NO_LINES = "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"


@query("join_anti", "int: o_orderkey", _NO_LINES)
def _(t: Tables):
    return J.not_exists_in(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")])


@query("join_anti_leftnull", "int: o_orderkey", "SELECT o_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL")
def _(t: Tables):
    return J.left_join_is_null(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")])


@query("join_anti_notin", "int: with_null without_null", """
    SELECT (SELECT COUNT(*) FROM orders WHERE o_orderkey NOT IN (SELECT NULLIF(l_orderkey, 7) FROM lineitem)) AS with_null,
      (SELECT COUNT(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS without_null""")
def _(t: Tables):
    """One NULL on the right empties the answer."""
    holed = t.lineitem.select(F.nullif(c("l_orderkey"), F.lit(7)).alias("k"))
    n = F.count(F.lit(1))
    trapped = J.not_in(t.orders, holed, "o_orderkey", "k").agg(n.alias("with_null"))
    plain = J.not_in(t.orders, t.lineitem, "o_orderkey", "l_orderkey").agg(n.alias("without_null"))
    return attach(trapped, plain)


@query("join_role", _LINE + "; text: ordered_on ordered_day shipped_on; bool: ordered_weekend; int: days_to_ship", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(o_orderdate AS DATE) AS ordered_on,
      dayname(o_orderdate) AS ordered_day, COALESCE(CAST(shipped AS DATE), DATE '1900-01-01') AS shipped_on,
      isodow(o_orderdate) >= 6 AS ordered_weekend, date_diff('day', o_orderdate, shipped) AS days_to_ship
    FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS shipped FROM lineitem) JOIN orders ON l_orderkey = o_orderkey""")
def _(t: Tables):
    calendar = dim_date(t.spark, *date_bounds((t.orders, "o_orderdate"), (t.lineitem, "l_shipdate")))
    shipped = F.when(c("l_returnflag") != "N", c("l_shipdate"))
    rows = t.lineitem.withColumn("shipped", shipped).join(t.orders, c("l_orderkey") == c("o_orderkey")).select(
        *LINE_ID, "shipped", date_key("o_orderdate").alias("order_key"), date_key("shipped").alias("ship_key"))
    rows = J.play_role(rows, calendar, "date_key", "order_key", {
        "calendar_date": "ordered_on", "day_name": "ordered_day", "is_weekend": "ordered_weekend"})
    rows = J.play_role(rows, calendar, "date_key", "ship_key", {"calendar_date": "shipped_on"})
    return rows.withColumn("days_to_ship", F.when(c("shipped").isNotNull(), F.datediff("shipped_on", "ordered_on")))


_VERSIONS = """WITH ch AS (SELECT o_custkey, o_orderpriority AS tier, o_orderdate AS chg, o_orderkey FROM (SELECT *,
      ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
    kept AS (SELECT * FROM (SELECT *, LAG(tier) OVER (PARTITION BY o_custkey ORDER BY chg) AS p FROM ch) WHERE p IS NULL OR p <> tier),
    v AS (SELECT o_custkey, tier, chg AS valid_from, COALESCE(LEAD(chg) OVER (PARTITION BY o_custkey ORDER BY chg),
      TIMESTAMP '9999-12-31 23:59:59') AS valid_to FROM kept)"""


def versions(t: Tables):
    """Customer tier history: the priority of each order is a change event."""
    log = t.orders.select(
        "o_custkey", c("o_orderpriority").alias("tier"), c("o_orderdate").alias("at"), "o_orderkey")
    return history(log, "o_custkey", ["tier"], "at", ["o_orderkey"])


@query("join_asof_point", "int: o_orderkey; text: tier", f"""
    {_VERSIONS} SELECT o.o_orderkey, v.tier FROM orders o JOIN v ON v.o_custkey = o.o_custkey
      AND o.o_orderdate >= v.valid_from AND o.o_orderdate < v.valid_to""")
def _(t: Tables):
    """Tier of the customer at the time of each order."""
    return J.as_of(t.orders, versions(t), ["o_custkey"], "o_orderdate", "valid_from", "valid_to", inner=True)


@query("join_preagg", "int: c_custkey orders_count events_count; float: spend", f"""
    SELECT c_custkey, COALESCE(n, 0) AS orders_count, COALESCE(k, 0) AS events_count, COALESCE(s, 0) AS spend FROM customer
    LEFT JOIN (SELECT o_custkey, COUNT(*) AS n, SUM({m('o_totalprice')}) AS s FROM orders GROUP BY 1) ON o_custkey = c_custkey
    LEFT JOIN (SELECT user_id, COUNT(*) AS k FROM events GROUP BY 1) ON user_id = c_custkey""")
def _(t: Tables):
    n = F.count(F.lit(1))
    orders = t.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(n.alias("orders_count"), F.sum(money("o_totalprice")).alias("spend"))
    events = t.events.groupBy(c("user_id").alias("c_custkey")).agg(n.alias("events_count"))
    return J.preaggregated(t.customer, "c_custkey", [orders, events], {"orders_count": 0, "events_count": 0, "spend": 0})


@query("join_fanout_check", "int: rows_before rows_after keys_after multiplied_keys max_copies; bool: fans_out", """
    WITH j AS (SELECT o_orderkey, COUNT(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
    SELECT (SELECT COUNT(*) FROM orders) AS rows_before, SUM(n) AS rows_after, COUNT(*) AS keys_after,
      COUNT(*) FILTER (WHERE n > 1) AS multiplied_keys, MAX(n) AS max_copies, SUM(n) > COUNT(*) AS fans_out FROM j""")
def _(t: Tables):
    joined = t.orders.join(t.lineitem, c("o_orderkey") == c("l_orderkey"))
    return J.fanout_report(t.orders, joined, ["o_orderkey"])


@query("join_dup_pay", _LINE + "; text: p_name c_name o_orderpriority", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, c_name, o_orderpriority FROM lineitem
    LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'
    LEFT JOIN customer ON c_custkey = o_custkey""")
def _(t: Tables):
    """Degenerate columns of the header brought to the line, optional on both hops."""
    filled = t.orders.filter("o_orderstatus = 'F'")
    return t.lineitem.join(t.part, c("p_partkey") == c("l_partkey"), "left").join(
        filled, c("o_orderkey") == c("l_orderkey"), "left").join(t.customer, c("c_custkey") == c("o_custkey"), "left")
