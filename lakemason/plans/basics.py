"""Scans, sinks, filters, projections, aggregates, set operations, sorting, paging and views."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from lakemason.functions.columns import day_range, literal, money, months, name_id, order_columns, ratio, typed_equals
from lakemason.operators import aggregates as A, bitmaps as B, digests as D, setops as S, topk as K
from lakemason.operators.ordered import nth_rows, with_totals
from lakemason.plans.registry import Tables, m, query, r
from lakemason.session import cut
from lakemason.sources import sinks
from lakemason.sources.tables import inline

c = F.col
ORDER = "int: o_orderkey o_custkey; text: o_orderstatus; float: o_totalprice; time: o_orderdate; text: o_orderpriority"


# ---------------------------------------------------------------- sources and sinks
@query("src_table", ORDER, "SELECT * FROM orders")
def _(t: Tables):
    return t.orders


@query("src_inline", "text: o_orderstatus label; int: orders_count", """
    SELECT v.s AS o_orderstatus, v.label, COUNT(o.o_orderkey) AS orders_count
    FROM (VALUES ('F','filled'),('O','open'),('P','partial'),('X','unused')) AS v(s, label)
    LEFT JOIN orders o ON o.o_orderstatus = v.s GROUP BY v.s, v.label""")
def _(t: Tables):
    labels = inline(t.spark, "o_orderstatus string, label string",
                    [("F", "filled"), ("O", "open"), ("P", "partial"), ("X", "unused")])
    counted = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders_count"))
    return labels.join(counted, "o_orderstatus", "left").fillna(0, ["orders_count"])


@query("src_series", "text: day; int: day_no", """
    SELECT CAST(d AS DATE) AS day, date_diff('day', lo, CAST(d AS DATE)) + 1 AS day_no
    FROM (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders) b,
         LATERAL (SELECT unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS d)""")
def _(t: Tables):
    bounds = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return bounds.select("lo", F.explode(F.sequence("lo", "hi")).alias("day")).withColumn(
        "day_no", F.datediff("day", "lo") + 1)


@query("sink_append", "int: o_orderkey; text: o_orderstatus",
       "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F','O')")
def _(t: Tables):
    path = sinks.scratch(t.spark, "append")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    for status in ("F", "O"):
        sinks.append(rows.filter(c("o_orderstatus") == status), path)
    return t.spark.read.schema(rows.schema).parquet(path)


def _table(t: Tables, label: str) -> tuple[str, str]:
    return f"lakemason_{label}_{uuid.uuid4().hex[:12]}", sinks.scratch(t.spark, label)


@query("sink_insert_select", "int: o_custkey orders_count", """
    SELECT o_custkey, COUNT(*) AS orders_count FROM orders GROUP BY o_custkey
    UNION ALL SELECT o_custkey, -COUNT(*) FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""")
def _(t: Tables):
    name, path = _table(t, "insert_select")
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders_count"))
    sinks.create_as(counts, name, path=path)
    filled = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg((-F.count(F.lit(1))).alias("orders_count"))
    sinks.insert_select(filled, name)
    return t.spark.table(name)


@query("sink_ctas", "int: o_custkey; float: total",
       f"SELECT o_custkey, SUM({m('o_totalprice')}) AS total FROM orders GROUP BY o_custkey")
def _(t: Tables):
    name, path = _table(t, "ctas")
    sinks.create_as(t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total")), name, path=path)
    return t.spark.table(name)


@query("sink_replace", "int: o_orderkey", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def _(t: Tables):
    name, path = _table(t, "replace")
    for status in ("F", "P"):
        sinks.replace_table(t.orders.filter(c("o_orderstatus") == status).select("o_orderkey"), name, path=path)
    return t.spark.table(name)


@query("sink_temp", "text: o_orderpriority; int: n",
       "SELECT o_orderpriority, COUNT(*) AS n FROM orders WHERE o_totalprice > 250000 GROUP BY o_orderpriority")
def _(t: Tables):
    with sinks.temporary_view(t.orders.filter("o_totalprice > 250000"), "large_orders_step") as large:
        return large.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("sink_view", "int: o_custkey n", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey")
def _(t: Tables):
    t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).createOrReplaceTempView("lakemason_customer_counts")
    return t.spark.table("lakemason_customer_counts")


# ---------------------------------------------------------------- filters and projections
@query("flt_eq", ORDER, "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'")
def _(t: Tables):
    return t.orders.filter((c("o_orderstatus") == "F") & (c("o_orderpriority") != "5-LOW"))


@query("flt_in", ORDER, """SELECT * FROM orders WHERE o_orderstatus IN ('F','O')
    AND o_orderpriority NOT IN ('1-URGENT','2-HIGH')""")
def _(t: Tables):
    return t.orders.filter(c("o_orderstatus").isin("F", "O") & ~c("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@query("flt_between", ORDER, "SELECT * FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000 AND o_orderkey >= 100")
def _(t: Tables):
    return t.orders.filter(c("o_totalprice").between(100000.0, 200000.0) & (c("o_orderkey") >= 100))


@query("flt_halfopen", ORDER, """SELECT * FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-06-01' AND o_orderdate < TIMESTAMP '1996-07-01'""")
def _(t: Tables):
    return t.orders.filter(day_range("o_orderdate", dt.datetime(1996, 6, 1), dt.datetime(1996, 7, 1)))


@query("flt_like_suffix", "int: c_custkey; text: c_name", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%42'")
def _(t: Tables):
    return t.customer.filter(c("c_name").endswith("42")).select("c_custkey", "c_name")


@query("flt_ci", "int: p_partkey; text: p_name", "SELECT p_partkey, p_name FROM part WHERE LOWER(p_name) = 'red widget'")
def _(t: Tables):
    return t.part.filter(F.lower("p_name") == "RED Widget".lower()).select("p_partkey", "p_name")


@query("flt_or", ORDER, "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 450000")
def _(t: Tables):
    return t.orders.filter((c("o_orderpriority") == "1-URGENT") | (c("o_totalprice") > 450000))


@query("flt_null", "int: c_custkey; bool: has_high; bool: unknown_test", """
    SELECT c_custkey, hi IS NOT NULL AS has_high, (hi > 499000) IS NULL AS unknown_test FROM customer LEFT JOIN
    (SELECT o_custkey, MAX(o_totalprice) AS hi FROM orders WHERE o_totalprice > 400000 GROUP BY o_custkey) h
    ON c_custkey = o_custkey""")
def _(t: Tables):
    high = t.orders.filter("o_totalprice > 400000").groupBy("o_custkey").agg(F.max("o_totalprice").alias("hi"))
    return t.customer.join(high, c("c_custkey") == c("o_custkey"), "left").select(
        "c_custkey", c("hi").isNotNull().alias("has_high"), (c("hi") > 499000).isNull().alias("unknown_test"))


@query("flt_typed", "int: o_orderkey; text: code",
       "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS code FROM orders WHERE CAST(o_custkey AS VARCHAR) = '42'")
def _(t: Tables):
    coded = t.orders.select("o_orderkey", c("o_custkey").cast("string").alias("code"))
    return coded.filter(typed_equals(coded, "code", 42))


@query("flt_row_value", "int: o_orderkey; text: o_orderdate", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    WHERE (o_orderdate, o_orderkey) < (TIMESTAMP '1996-03-01', 7000)""")
def _(t: Tables):
    from lakemason.functions.columns import after_row
    before = after_row(["-o_orderdate", "-o_orderkey"], [dt.datetime(1996, 3, 1), 7000])
    return t.orders.filter(before).select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))


@query("flt_scalar_sub", "int: o_orderkey; float: o_totalprice",
       "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT MAX(o_totalprice) FROM orders)")
def _(t: Tables):
    return t.orders.filter(c("o_totalprice") == t.orders.agg(F.max("o_totalprice")).scalar())


@query("flt_any_array", "int: p_partkey; text: p_name", """
    SELECT p_partkey, p_name FROM part WHERE 'red' = ANY(string_split(p_name, ' '))""")
def _(t: Tables):
    return t.part.filter(F.array_contains(F.split("p_name", " "), "red")).select("p_partkey", "p_name")


@query("prj_expr", "int: l_orderkey l_linenumber l_partkey l_suppkey; float: net; text: label size_class; int: half", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      {r(m('l_extendedprice') + ' * (1 - ' + m('l_discount') + ')')} AS net,
      l_returnflag || '-' || l_linestatus AS label,
      CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class,
      CAST(FLOOR(l_quantity / 2) AS BIGINT) AS half FROM lineitem""")
def _(t: Tables):
    size = F.when(c("l_quantity") < 10, "small").when(c("l_quantity") < 30, "medium").otherwise("large")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(money("l_extendedprice") * (F.lit(1) - money("l_discount")), 2).alias("net"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("label"), size.alias("size_class"),
        F.floor(c("l_quantity") / 2).alias("half"))


@query("prj_distinct", "int: o_custkey; text: o_orderpriority", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def _(t: Tables):
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query("prj_distinct_on", ORDER,
       "SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC")
def _(t: Tables):
    return nth_rows(t.orders, ["o_custkey"], ["-o_orderdate", "-o_orderkey"])


@query("prj_params", "int: o_orderkey; float: o_totalprice",
       "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 42 AND o_totalprice >= 1000")
def _(t: Tables):
    return t.spark.sql("SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_custkey = :customer AND o_totalprice >= :floor",
                       args={"customer": 42, "floor": 1000.0}, orders=t.orders)


# ---------------------------------------------------------------- aggregates
@query("agg_basic", "int: o_custkey n; float: total average lowest highest", f"""
    SELECT o_custkey, COUNT(*) AS n, SUM({m('o_totalprice')}) AS total,
      {r('SUM(' + m('o_totalprice') + ') / COUNT(*)')} AS average,
      MIN(o_totalprice) AS lowest, MAX(o_totalprice) AS highest FROM orders GROUP BY o_custkey""")
def _(t: Tables):
    total, n = F.sum(money("o_totalprice")), F.count(F.lit(1))
    return t.orders.groupBy("o_custkey").agg(
        n.alias("n"), total.alias("total"), ratio(total, n).alias("average"),
        F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest"))


@query("agg_global", "int: n; float: quantity amount; text: first_day last_day", f"""
    SELECT COUNT(*) AS n, SUM({m('l_quantity')}) AS quantity, SUM({m('l_extendedprice')}) AS amount,
      CAST(MIN(l_shipdate) AS DATE) AS first_day, CAST(MAX(l_shipdate) AS DATE) AS last_day FROM lineitem""")
def _(t: Tables):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("l_quantity")).alias("quantity"), F.sum(money("l_extendedprice")).alias("amount"),
        F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day"))


@query("agg_count_kinds", "int: all_rows coded_rows customers codes", """
    SELECT COUNT(*) AS all_rows, COUNT(code) AS coded_rows, COUNT(DISTINCT o_custkey) AS customers,
      COUNT(DISTINCT code) AS codes FROM (SELECT o_custkey, NULLIF(o_orderpriority, '5-LOW') AS code FROM orders)""")
def _(t: Tables):
    coded = t.orders.select("o_custkey", F.nullif(c("o_orderpriority"), F.lit("5-LOW")).alias("code"))
    return coded.agg(F.count(F.lit(1)).alias("all_rows"), F.count("code").alias("coded_rows"),
                     F.count_distinct("o_custkey").alias("customers"), F.count_distinct("code").alias("codes"))


@query("agg_distinct", "text: l_returnflag; int: orders_count lines; float: amount", f"""
    SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders_count, COUNT(*) AS lines,
      SUM({m('l_extendedprice')}) AS amount FROM lineitem GROUP BY l_returnflag""")
def _(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders_count"), F.count(F.lit(1)).alias("lines"),
        F.sum(money("l_extendedprice")).alias("amount"))


@query("agg_distinct_rollup", "int: level year month n_customers row_count; text: day", """
    WITH o AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, CAST(o_orderdate AS DATE) AS day, o_custkey FROM orders)
    SELECT 1 AS level, year, month, day, COUNT(DISTINCT o_custkey) AS n_customers, COUNT(*) AS row_count FROM o GROUP BY year, month, day
    UNION ALL SELECT 2, year, month, NULL, COUNT(DISTINCT o_custkey), COUNT(*) FROM o GROUP BY year, month
    UNION ALL SELECT 3, year, NULL, NULL, COUNT(DISTINCT o_custkey), COUNT(*) FROM o GROUP BY year
    UNION ALL SELECT 4, NULL, NULL, NULL, COUNT(DISTINCT o_custkey), COUNT(*) FROM o""")
def _(t: Tables):
    """Customers by day, month, year and in all, each rolled up from the stored bitmaps of the days."""
    dated = t.orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.to_date("o_orderdate").alias("day"), "o_custkey")
    stored = cut(B.id_bitmaps(dated, ["year", "month", "day"], "o_custkey"))
    return B.distinct_by_levels(stored, [["year", "month", "day"], ["year", "month"], ["year"], []], "n_customers")


@query("agg_multi_key", "int: year quarter; text: p_type; float: quantity", f"""
    SELECT EXTRACT(year FROM l_shipdate) AS year, EXTRACT(quarter FROM l_shipdate) AS quarter, p_type,
      SUM({m('l_quantity')}) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def _(t: Tables):
    return t.lineitem.join(t.part, c("l_partkey") == c("p_partkey")).groupBy(
        F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter"), "p_type"
    ).agg(F.sum(money("l_quantity")).alias("quantity"))


_KPI = "text: c_mktsegment; int: orders_count; float: gross filled open_rate_pct; int: partial_orders"
_KPI_SQL = """SELECT c_mktsegment, COUNT(o_orderkey) AS orders_count, SUM({a}) AS gross, {filled} AS filled,
    {rate} AS open_rate_pct, {partial} AS partial_orders
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment"""


@query("agg_case", _KPI, _KPI_SQL.format(
    a=m("o_totalprice"), filled=f"SUM(CASE WHEN o_orderstatus = 'F' AND o_totalprice > 499900 THEN {m('o_totalprice')} ELSE 0 END)",
    rate=r("100.0 * COUNT(CASE WHEN o_orderstatus = 'O' THEN 1 END) / COUNT(o_orderkey)"),
    partial="COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END)"))
def _(t: Tables):
    filled = (c("o_orderstatus") == "F") & (c("o_totalprice") > 499900)
    return t.customer.join(t.orders, c("c_custkey") == c("o_custkey")).groupBy("c_mktsegment").agg(
        F.count("o_orderkey").alias("orders_count"), F.sum(money("o_totalprice")).alias("gross"),
        A.sum_when(filled, money("o_totalprice")).alias("filled"),
        ratio(A.count_when(c("o_orderstatus") == "O"), F.count("o_orderkey"), 2, 100).alias("open_rate_pct"),
        A.count_when(c("o_orderstatus") == "P").alias("partial_orders"))


@query("agg_filter", _KPI, _KPI_SQL.format(
    a=m("o_totalprice"), filled=f"SUM({m('o_totalprice')}) FILTER (WHERE o_orderstatus = 'F' AND o_totalprice > 499900)",
    rate=r("100.0 * COUNT(*) FILTER (WHERE o_orderstatus = 'O') / COUNT(o_orderkey)"),
    partial="COUNT(*) FILTER (WHERE o_orderstatus = 'P')"))
def _(t: Tables):
    joined = t.customer.join(t.orders, c("c_custkey") == c("o_custkey"))
    return t.spark.sql("""
        SELECT c_mktsegment, count(o_orderkey) AS orders_count, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS gross,
          sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F' AND o_totalprice > 499900) AS filled,
          round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'O') / count(o_orderkey), 2) AS open_rate_pct,
          count(*) FILTER (WHERE o_orderstatus = 'P') AS partial_orders
        FROM {joined} GROUP BY c_mktsegment""", joined=joined)


# The five priorities and the column each becomes.
PRIORITIES = {"1-URGENT": "urgent_amount", "2-HIGH": "high_amount", "3-MEDIUM": "medium_amount",
              "4-NOT SPECIFIED": "unspecified_amount", "5-LOW": "low_amount"}


@query("agg_pivot", f"text: sales_month; int: n; float: {' '.join(PRIORITIES.values())}",
       "SELECT strftime(o_orderdate, '%Y-%m') AS sales_month, COUNT(*) AS n, " + ", ".join(
           f"ROUND(COALESCE(SUM({m('o_totalprice')}) FILTER (WHERE o_orderpriority = '{p}'), 0), 2) AS {o}"
           for p, o in PRIORITIES.items()) + " FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def _(t: Tables):
    filled = t.orders.filter("o_orderstatus = 'F'").withColumn("sales_month", months("o_orderdate"))
    return A.pivot_sum(filled, "sales_month", "o_orderpriority", PRIORITIES, money("o_totalprice"), n=F.count(F.lit(1)))


_COST = "CAST(l_quantity * 100 AS DECIMAL(18,2))"


@query("agg_ratio", "text: p_brand; float: margin_pct", f"""
    SELECT p_brand, {r(f"SUM({m('l_extendedprice')} - {_COST}) / NULLIF(SUM({m('l_extendedprice')}), 0) * 100")} AS margin_pct
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def _(t: Tables):
    price, cost = money("l_extendedprice"), money(c("l_quantity") * 100)
    return t.lineitem.join(t.part, c("l_partkey") == c("p_partkey")).groupBy("p_brand").agg(
        ratio(F.sum(price - cost), F.sum(price), 2, 100).alias("margin_pct"))


@query("agg_subquery_total", "int: c_custkey; text: c_name; float: lifetime_spend", f"""
    SELECT c_custkey, c_name, (SELECT COALESCE(SUM({m('o_totalprice')}), 0) FROM orders WHERE o_custkey = c_custkey
      AND o_orderstatus = 'F') AS lifetime_spend FROM customer WHERE c_mktsegment = 'BUILDING'""")
def _(t: Tables):
    spend = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spend"))
    return t.customer.filter("c_mktsegment = 'BUILDING'").join(spend, c("c_custkey") == c("o_custkey"), "left").select(
        "c_custkey", "c_name", F.coalesce("spend", F.lit(0).cast("decimal(18,2)")).alias("lifetime_spend"))


@query("agg_having_like", "int: o_custkey; float: total",
       f"SELECT * FROM (SELECT o_custkey, SUM({m('o_totalprice')}) AS total FROM orders GROUP BY o_custkey) WHERE total > 3000000")
def _(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total")).filter("total > 3000000")


@query("agg_distribution", "text: o_orderstatus; int: row_count; float: pct_of_table", f"""
    SELECT o_orderstatus, COUNT(*) AS row_count, {r('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()')} AS pct_of_table
    FROM orders GROUP BY o_orderstatus""")
def _(t: Tables):
    return A.distribution(t.orders, "o_orderstatus")


_FAV = """SELECT * FROM (SELECT o_custkey, o_orderpriority AS favourite, COUNT(*) AS uses, ROW_NUMBER() OVER (
    PARTITION BY o_custkey ORDER BY COUNT(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2) WHERE rn = 1"""


@query("agg_in_window", "int: o_custkey; text: favourite; int: uses", _FAV)
@query("agg_mode", "int: o_custkey; text: favourite", _FAV)
def _(t: Tables):
    return A.favourite(t.orders, ["o_custkey"], "o_orderpriority")


@query("agg_grain_snapshot", "text: day; float: closing_total; int: entities", f"""
    SELECT day, SUM(v) AS closing_total, COUNT(*) AS entities FROM (
      SELECT user_id, CAST(ts AS DATE) AS day, {m('value')} AS v, ROW_NUMBER() OVER (
        PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 GROUP BY day""")
def _(t: Tables):
    return A.closing_balance(t.events.withColumn("day", F.to_date("ts")), ["user_id"], "day", ["ts", "event_id"], money("value"))


# ---------------------------------------------------------------- common table expressions
_PIPELINE_COLUMNS = "int: o_custkey; text: c_name favourite; float: lifetime_spend avg_order; int: orders_count"
_PIPELINE = f"""
    WITH spend AS (SELECT o_custkey, COUNT(*) AS n, SUM({m('o_totalprice')}) AS total FROM orders
        WHERE o_orderstatus IN ('F','O') GROUP BY o_custkey),
      ranked AS (SELECT *, NTILE(10) OVER (ORDER BY total DESC, o_custkey) AS decile FROM spend),
      fav AS ({_FAV})
    SELECT ranked.o_custkey, c_name, favourite, total AS lifetime_spend, {r('total / n')} AS avg_order, n AS orders_count
    FROM ranked JOIN customer ON c_custkey = ranked.o_custkey JOIN fav ON fav.o_custkey = ranked.o_custkey WHERE decile = 1"""


@query("cte_pipeline", _PIPELINE_COLUMNS, _PIPELINE)
@query("cte_steps", _PIPELINE_COLUMNS, _PIPELINE)
def _(t: Tables):
    """Top spending decile with favourite priority: named steps are DataFrame variables."""
    from lakemason.operators.ordered import buckets
    total, n = F.sum(money("o_totalprice")), F.count(F.lit(1))
    spend = t.orders.filter(c("o_orderstatus").isin("F", "O")).groupBy("o_custkey").agg(
        n.alias("orders_count"), total.alias("lifetime_spend"))
    top = buckets(spend, [], ["-lifetime_spend", "o_custkey"], 10, "decile").filter("decile = 1")
    liked = A.favourite(t.orders, ["o_custkey"], "o_orderpriority").drop("uses")
    named = t.customer.select(c("c_custkey").alias("o_custkey"), "c_name")
    return top.join(named, "o_custkey").join(liked, "o_custkey").withColumn(
        "avg_order", ratio(c("lifetime_spend"), c("orders_count")))


@query("cte_inline", "int: o_custkey; float: recent_spend", f"""
    WITH recent AS (SELECT * FROM orders) SELECT o_custkey, SUM({m('o_totalprice')}) AS recent_spend FROM recent
    WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey""")
def _(t: Tables):
    recent = t.orders
    return recent.filter(c("o_orderdate") >= literal(dt.datetime(2001, 1, 1))).groupBy("o_custkey").agg(
        F.sum(money("o_totalprice")).alias("recent_spend"))


@query("cte_materialized", "int: l_partkey; float: revenue above_mean", f"""
    WITH stats AS MATERIALIZED (SELECT l_partkey, SUM({m('l_extendedprice')}) AS revenue FROM lineitem GROUP BY l_partkey),
      mean AS (SELECT ROUND(CAST(SUM(revenue) AS DECIMAL(28,2)) * 1.0 / COUNT(*), 2) AS threshold FROM stats)
    SELECT l_partkey, revenue, {r('revenue - threshold')} AS above_mean FROM stats, mean WHERE revenue > threshold""")
def _(t: Tables):
    """The shared step is one exchange that Spark reuses for both of its readers."""
    stats = t.lineitem.groupBy("l_partkey").agg(F.sum(money("l_extendedprice")).alias("revenue"))
    judged = with_totals(stats, [], {"threshold": ratio(F.sum("revenue"), F.count(F.lit(1)), 2)})
    return judged.filter("revenue > threshold").withColumn("above_mean", c("revenue") - c("threshold"))


@query("sub_corr_where", "int: p_partkey; text: p_type; float: p_retailprice", """
    SELECT p_partkey, p_type, p_retailprice FROM part p WHERE CAST(p_retailprice AS DECIMAL(18,2)) >
      (SELECT ROUND(SUM(CAST(q.p_retailprice AS DECIMAL(18,2))) * 1.0 / COUNT(*), 6) FROM part q WHERE q.p_type = p.p_type)""")
def _(t: Tables):
    """Decorrelated by Spark into one aggregate and one join."""
    return t.spark.sql("""
        SELECT p_partkey, p_type, p_retailprice FROM {part} p WHERE CAST(p_retailprice AS DECIMAL(18,2)) >
          (SELECT round(sum(CAST(q.p_retailprice AS DECIMAL(18,2))) / count(*), 6) FROM {part} q WHERE q.p_type = p.p_type)""",
        part=t.part)


@query("sub_corr_select", "int: c_custkey orders_count; float: best", """
    SELECT c_custkey, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS orders_count,
      (SELECT MAX(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS best FROM customer""")
def _(t: Tables):
    return t.spark.sql("""
        SELECT c_custkey, (SELECT count(*) FROM {orders} WHERE o_custkey = c_custkey) AS orders_count,
          (SELECT max(o_totalprice) FROM {orders} WHERE o_custkey = c_custkey) AS best FROM {customer}""",
        orders=t.orders, customer=t.customer)


# ---------------------------------------------------------------- sorting and paging
@query("sort_multi", ORDER, "SELECT * FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey")
def _(t: Tables):
    return K.sort_by(t.orders, ["o_orderstatus", "-o_totalprice", "o_orderkey"])


@query("limit_plain", ORDER)
def _(t: Tables):
    return t.orders.limit(10)


@query("limit_any", "int: row_count known_rows", """
    SELECT least(10, COUNT(*)) AS row_count, least(10, COUNT(*)) AS known_rows FROM orders""")
def _(t: Tables):
    """Which rows a LIMIT without an order gives is open; that they are so many, and rows of the table, is not."""
    some = cut(t.orders.limit(10))
    known = some.join(t.orders.select(*some.columns), some.columns, "left_semi").agg(F.count(F.lit(1)).alias("known_rows"))
    return some.agg(F.count(F.lit(1)).alias("row_count")).select("row_count", known.scalar().alias("known_rows"))


@query("fn_text", "text: padded trimmed cut_left cut_right name_id; int: p_partkey", """
    SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') || rpad(p_brand, 12, '.') AS padded, trim('  ' || p_type || ' ') AS trimmed,
      ltrim(p_name, 'part ') AS cut_left, rtrim(p_name || '---', '-') AS cut_right, p_partkey,
      h[1:8] || '-' || h[9:12] || '-3' || h[14:16] || '-' || translate(h[17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32] AS name_id
    FROM (SELECT *, md5('part:' || p_partkey) AS h FROM part)""")
def _(t: Tables):
    """Padding, trimming, and identifiers named after a key instead of drawn."""
    return t.part.select(
        "p_partkey", F.concat(F.lpad(c("p_partkey").cast("string"), 8, "0"), F.rpad("p_brand", 12, ".")).alias("padded"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"), F.ltrim("p_name", F.lit("part ")).alias("cut_left"),
        F.rtrim(F.concat("p_name", F.lit("---")), F.lit("-")).alias("cut_right"), name_id(F.concat(F.lit("part:"), c("p_partkey").cast("string"))).alias("name_id"))


@query("topk", "int: o_orderkey; float: o_totalprice",
       "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(t: Tables):
    return K.top_k(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 25)


@query("topk_filtered", "int: o_orderkey; float: o_totalprice; text: day", """
    SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_custkey = 42
    AND o_orderdate >= TIMESTAMP '1996-01-01' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def _(t: Tables):
    wanted = t.orders.filter((c("o_custkey") == 42) & (c("o_orderdate") >= literal(dt.datetime(1996, 1, 1))))
    return K.top_k(wanted, ["-o_orderdate", "-o_orderkey"], 10).select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))


_PAGE = "int: o_orderkey; text: day; float: o_totalprice"
_PAGE_SQL = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20 OFFSET 60"""


@query("page_offset", _PAGE, _PAGE_SQL)
def _(t: Tables):
    return K.page_by_offset(t.orders.filter("o_orderstatus = 'F'"), ["-o_orderdate", "-o_orderkey"], 3, 20).withColumn(
        "day", F.to_date("o_orderdate"))


@query("page_keyset", _PAGE, _PAGE_SQL)
def _(t: Tables):
    """Page 3 found by seeking past the last row of page 2 (one row, as a client would hold)."""
    filled, order = t.orders.filter("o_orderstatus = 'F'"), ["-o_orderdate", "-o_orderkey"]
    last = K.page_by_offset(filled, order, 2, 20).collect()[-1]
    return K.page_after(filled, order, [last["o_orderdate"], last["o_orderkey"]], 20).withColumn("day", F.to_date("o_orderdate"))


# ---------------------------------------------------------------- set operations
@query("set_union_all", "text: entity_type; int: nationkey", """
    SELECT 'CUSTOMER' AS entity_type, c_nationkey AS nationkey FROM customer
    UNION ALL SELECT 'SUPPLIER', s_nationkey FROM supplier""")
def _(t: Tables):
    return S.tagged_union({"CUSTOMER": t.customer.select(c("c_nationkey").alias("nationkey")),
                           "SUPPLIER": t.supplier.select(c("s_nationkey").alias("nationkey"))})


@query("set_union", "int: c_nationkey", "SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t: Tables):
    return S.union_distinct(t.customer.select("c_nationkey"), t.supplier.select("s_nationkey"))


@query("set_intersect", "int: s_nationkey", "SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def _(t: Tables):
    return S.intersect_distinct(t.supplier.select("s_nationkey"), t.customer.select("c_nationkey"))


@query("set_except", "int: o_orderkey", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def _(t: Tables):
    return S.except_distinct(t.orders.select("o_orderkey"), t.lineitem.select("l_orderkey"))


_EDIT = """SELECT CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey + 10000000 ELSE o_orderkey END AS o_orderkey,
    CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders"""


@query("set_reconcile", "text: diff_type; int: o_orderkey; text: o_orderstatus", f"""
    WITH staged AS ({_EDIT}), prod AS (SELECT o_orderkey, o_orderstatus FROM orders)
    SELECT 'ONLY_IN_STAGING' AS diff_type, * FROM (SELECT * FROM staged EXCEPT SELECT * FROM prod)
    UNION ALL SELECT 'ONLY_IN_PROD', * FROM (SELECT * FROM prod EXCEPT SELECT * FROM staged)""")
def _(t: Tables):
    staged = t.orders.select(
        F.when(c("o_orderkey") % 5 == 0, c("o_orderkey") + 10000000).otherwise(c("o_orderkey")).alias("o_orderkey"),
        F.when(c("o_orderkey") % 7 == 0, "X").otherwise(c("o_orderstatus")).alias("o_orderstatus"))
    return S.reconcile(staged, t.orders.select("o_orderkey", "o_orderstatus"))


# A fiftieth of the keys, in the middle, is edited: statuses changed, rows dropped, rows doubled.
_LOCAL = """SELECT o_orderkey, o_custkey, CASE WHEN touched AND o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM (SELECT *, o_orderkey * 50 // (SELECT MAX(o_orderkey) + 1 FROM orders) = 25 AS touched FROM orders) o,
      LATERAL (SELECT unnest(range(CASE WHEN touched AND o_orderkey % 5 = 1 THEN 2 ELSE 1 END))) WHERE NOT (touched AND o_orderkey % 5 = 0)"""


@query("set_reconcile_digest", "text: diff_type; int: o_orderkey o_custkey; text: o_orderstatus; int: surplus", f"""
    WITH both_sides AS (SELECT *, 1 AS n FROM ({_LOCAL}) UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, -1 FROM orders)
    SELECT CASE WHEN SUM(n) > 0 THEN 'ONLY_IN_STAGING' ELSE 'ONLY_IN_PROD' END AS diff_type, o_orderkey, o_custkey, o_orderstatus, ABS(SUM(n)) AS surplus
    FROM both_sides GROUP BY o_orderkey, o_custkey, o_orderstatus HAVING SUM(n) <> 0""")
def _(t: Tables):
    prod = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    top = t.orders.agg(F.max("o_orderkey") + 1).scalar()
    touched = F.floor(c("o_orderkey") * 50 / top) == 25
    staged = prod.withColumn("touched", touched).filter(~(c("touched") & (c("o_orderkey") % 5 == 0)))
    copies = F.when(c("touched") & (c("o_orderkey") % 5 == 1), 2).otherwise(1)
    staged = staged.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    status = F.when(c("touched") & (c("o_orderkey") % 3 == 0), "X").otherwise(c("o_orderstatus")).alias("o_orderstatus")
    return D.reconcile_by_digest(cut(staged.select("o_orderkey", "o_custkey", status)), prod, "o_orderkey", counts=True)


# ---------------------------------------------------------------- reporting views
@query("view_customer_summary", "int: o_custkey n; float: revenue average; text: first_day last_day", f"""
    SELECT o_custkey, COUNT(*) AS n, SUM({m('o_totalprice')}) AS revenue, {r(f"SUM({m('o_totalprice')}) / COUNT(*)")} AS average,
      CAST(MIN(o_orderdate) AS DATE) AS first_day, CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY o_custkey""")
def _(t: Tables):
    revenue, n = F.sum(money("o_totalprice")), F.count(F.lit(1))
    return t.orders.groupBy("o_custkey").agg(
        n.alias("n"), revenue.alias("revenue"), ratio(revenue, n).alias("average"),
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))


@query("view_product_sales", "int: l_partkey; text: p_name p_type; float: units revenue", f"""
    SELECT l_partkey, p_name, p_type, SUM({m('l_quantity')}) AS units, SUM({m('l_extendedprice')}) AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, p_name, p_type""")
def _(t: Tables):
    """Aggregated before the join: the join sees one row per product."""
    sales = t.lineitem.groupBy("l_partkey").agg(
        F.sum(money("l_quantity")).alias("units"), F.sum(money("l_extendedprice")).alias("revenue"))
    return sales.join(t.part, c("l_partkey") == c("p_partkey"))


@query("view_daily_revenue", "text: order_date; int: n; float: revenue", f"""
    SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS n, SUM({m('o_totalprice')}) AS revenue FROM orders
    WHERE o_orderstatus NOT IN ('P') GROUP BY 1""")
def _(t: Tables):
    return t.orders.filter(~c("o_orderstatus").isin("P")).groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("revenue"))


@query("view_customer_activity", "int: user_id; text: day; int: event_count event_types", """
    SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS event_count, COUNT(DISTINCT event_type) AS event_types
    FROM events GROUP BY 1, 2""")
def _(t: Tables):
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("event_count"), F.count_distinct("event_type").alias("event_types"))


@query("view_active_spend", "int: c_custkey; text: c_name; float: total_spend", f"""
    SELECT * FROM (SELECT c_custkey, c_name, SUM({m('o_totalprice')}) AS total_spend FROM customer
    JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 0 GROUP BY 1, 2) WHERE total_spend > 2000000""")
def _(t: Tables):
    spend = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total_spend"))
    view = t.customer.filter("c_acctbal > 0").join(spend, c("c_custkey") == c("o_custkey")).select("c_custkey", "c_name", "total_spend")
    return view.filter("total_spend > 2000000")


@query("rpt_service_latency", "text: event_type; int: n; float: average", f"""
    SELECT event_type, COUNT(*) AS n, {r(f"SUM({m('value')}) / COUNT(*)")} AS average FROM events GROUP BY 1 ORDER BY 3 DESC""")
def _(t: Tables):
    n = F.count(F.lit(1))
    return t.events.groupBy("event_type").agg(n.alias("n"), ratio(F.sum(money("value")), n).alias("average")).orderBy(
        *order_columns(["-average"]))
