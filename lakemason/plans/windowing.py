"""Window analytics. Where the workbook style solves a problem twice (with and without window
functions), the SQL twin here is the other formulation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemason.functions.columns import money, months, ratio
from lakemason.operators import joins as J
from lakemason.operators.ordered import (
    buckets, framed, nth_rows, number_rows, peers_running, running, value_ranks, with_totals,
)
from lakemason.plans.registry import Tables, m, query, r

c = F.col
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _latest(name: str, sql: str):
    return query(name, "int: o_custkey o_orderkey; text: day status; float: o_totalprice", sql)


_LATEST_COLUMNS = "o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, o_totalprice"


@_latest("win_row_number", f"""
    SELECT {_LATEST_COLUMNS} FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders n WHERE n.o_custkey = o.o_custkey
      AND (n.o_orderdate, n.o_orderkey) > (o.o_orderdate, o.o_orderkey))""")
def _(t: Tables):
    latest = nth_rows(t.orders, ["o_custkey"], ["-o_orderdate", "-o_orderkey"])
    return latest.select("*", F.to_date("o_orderdate").alias("day"), c("o_orderstatus").alias("status"))


@_latest("win_row_number_ties", f"""
    SELECT {_LATEST_COLUMNS} FROM (SELECT *, RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rk FROM orders)
    WHERE rk = 1""")
def _(t: Tables):
    """Latest orders per customer, ties kept: join on the newest date."""
    newest = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    latest = t.orders.join(newest, ["o_custkey", "o_orderdate"])
    return latest.select("*", F.to_date("o_orderdate").alias("day"), c("o_orderstatus").alias("status"))


def _filled_lines(t: Tables):
    lines = t.lineitem.filter("l_linestatus = 'F'").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("done"))
    return lines.withColumnRenamed("l_suppkey", "s_suppkey")


@query("win_rank", "int: s_suppkey done leader_rank", """
    WITH d AS (SELECT l_suppkey AS s_suppkey, COUNT(*) AS done FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
    SELECT a.s_suppkey, a.done, 1 + COUNT(b.s_suppkey) AS leader_rank FROM d a LEFT JOIN d b ON b.done > a.done GROUP BY 1, 2""")
def _(t: Tables):
    return value_ranks(_filled_lines(t), [], ["-done"], {"leader_rank": "rank"})


@query("win_dense_rank", "int: p_partkey price_rank; text: p_brand; float: p_retailprice", """
    SELECT p_partkey, price_rank, p_brand, p_retailprice FROM (SELECT p.*, (SELECT COUNT(DISTINCT q.p_retailprice) FROM part q
      WHERE q.p_brand = p.p_brand AND q.p_retailprice >= p.p_retailprice) AS price_rank FROM part p) WHERE price_rank <= 3""")
def _(t: Tables):
    """Three highest distinct prices per brand: distinct prices are ranked, then joined to the parts."""
    prices = t.part.select("p_brand", "p_retailprice").distinct()
    top = value_ranks(prices, ["p_brand"], ["-p_retailprice"], {"price_rank": "dense_rank"}).filter("price_rank <= 3")
    return t.part.join(top, ["p_brand", "p_retailprice"])


def _spend(t: Tables):
    return t.orders.filter("o_orderstatus <> 'P'").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spend"))


@query("win_percent_rank", "int: o_custkey; float: spend percentile", f"""
    WITH s AS (SELECT o_custkey, SUM({m('o_totalprice')}) AS spend FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
    SELECT o_custkey, spend, {r('PERCENT_RANK() OVER (ORDER BY spend)', 4)} AS percentile FROM s""")
def _(t: Tables):
    ranked = value_ranks(_spend(t), [], ["spend"], {"p": "percent_rank"})
    return ranked.withColumn("percentile", F.round(c("p").cast("decimal(38,10)"), 4))


@query("win_cume_dist", "int: l_orderkey l_linenumber l_partkey l_suppkey delay; float: share", f"""
    WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', o_orderdate, l_shipdate) AS delay
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT *, {r('CUME_DIST() OVER (ORDER BY delay)', 4)} AS share FROM d""")
def _(t: Tables):
    delays = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).select(
        *LINE_ID, F.datediff("l_shipdate", "o_orderdate").alias("delay"))
    ranked = value_ranks(delays, [], ["delay"], {"s": "cume_dist"})
    return ranked.withColumn("share", F.round(c("s").cast("decimal(38,10)"), 4))


# Names of the four price tiers.
TIERS = ["Budget", "Economy", "Premium", "Luxury"]


@query("win_ntile", "int: p_partkey tier; text: p_type tier_label; float: p_retailprice", """
    SELECT p_partkey, tier, p_type, p_retailprice, CASE tier WHEN 1 THEN 'Budget' WHEN 2 THEN 'Economy' WHEN 3 THEN 'Premium'
      WHEN 4 THEN 'Luxury' END AS tier_label FROM (SELECT *, NTILE(4) OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey)
      AS tier FROM part)""")
def _(t: Tables):
    tiers = buckets(t.part, ["p_type"], ["p_retailprice", "p_partkey"], 4, "tier")
    return tiers.withColumn("tier_label", F.element_at(F.array(*[F.lit(x) for x in TIERS]), c("tier")))


def _monthly(t: Tables):
    """One row per calendar month, so a window over all of it is bounded by the calendar."""
    month = F.trunc("o_orderdate", "month")
    return t.orders.filter("o_orderstatus <> 'P'").groupBy(month.alias("month")).agg(F.sum(money("o_totalprice")).alias("revenue"))


_MONTHLY = f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM({m('o_totalprice')}) AS revenue FROM orders
    WHERE o_orderstatus <> 'P' GROUP BY 1"""
_GROWTH = "text: order_month; float: revenue previous growth growth_pct"


def _growth(df):
    pct = ratio(c("revenue") - c("previous"), c("previous"), 2, 100)
    return df.select(months("month").alias("order_month"), "revenue", "previous",
                     (c("revenue") - c("previous")).alias("growth"), pct.alias("growth_pct"))


@query("win_lag", _GROWTH, f"""
    WITH mr AS ({_MONTHLY}), p AS (SELECT *, LAG(revenue, 1, 0) OVER (ORDER BY month) AS previous FROM mr)
    SELECT strftime(month, '%Y-%m') AS order_month, revenue, previous, revenue - previous AS growth,
      CASE WHEN previous = 0 THEN NULL ELSE {r('(revenue - previous) / previous * 100')} END AS growth_pct FROM p""")
def _(t: Tables):
    """Previous existing month."""
    zero = F.lit(0).cast("decimal(28,2)")
    lagged = framed(_monthly(t), [], ["month"], lambda w: {"previous": F.coalesce(F.lag("revenue").over(w), zero)}, bounded=True)
    return _growth(lagged)


_GROWTH_CALENDAR = f"""
    WITH mr AS ({_MONTHLY}), p AS (SELECT a.*, COALESCE(b.revenue, 0) AS previous FROM mr a LEFT JOIN mr b
      ON b.month = CAST(a.month - INTERVAL 1 MONTH AS DATE))
    SELECT strftime(month, '%Y-%m') AS order_month, revenue, previous, revenue - previous AS growth,
      CASE WHEN previous = 0 THEN NULL ELSE {r('(revenue - previous) / previous * 100')} END AS growth_pct FROM p"""


@query("join_self_prev", _GROWTH, _GROWTH_CALENDAR)
@query("win_lag_calendar", _GROWTH, _GROWTH_CALENDAR)
def _(t: Tables):
    """Exactly the previous calendar month: an equi join on the shifted month."""
    monthly = _monthly(t)
    before = monthly.select(F.add_months("month", 1).alias("month"), c("revenue").alias("previous"))
    return _growth(J.left_join_default(monthly, before, ["month"], {"previous": 0}))


@query("win_lead", "int: user_id event_id; text: event_type next_type; time: ts next_ts; float: minutes", f"""
    SELECT e.user_id, e.event_id, e.event_type, n.event_type AS next_type, e.ts, n.ts AS next_ts,
      {r("date_diff('microsecond', e.ts, n.ts) / 60000000.0")} AS minutes
    FROM events e LEFT JOIN LATERAL (SELECT * FROM events x WHERE x.user_id = e.user_id AND (x.ts, x.event_id) > (e.ts, e.event_id)
      ORDER BY x.ts, x.event_id LIMIT 1) n ON TRUE""")
def _(t: Tables):
    following = framed(t.events, ["user_id"], ["ts", "event_id"], lambda w: {
        "next_type": F.lead("event_type").over(w), "next_ts": F.lead("ts").over(w)}, after=1)
    micros = F.timestamp_diff("MICROSECOND", c("ts"), c("next_ts")).cast("decimal(20,0)")
    return following.withColumn("minutes", F.round(micros / 60000000, 2))


def _picked(t: Tables, order: list[str], n: int, prefix: str):
    pick = nth_rows(t.part.select("p_brand", "p_partkey", "p_name", "p_retailprice"), ["p_brand"], order, n)
    return pick.select("p_brand", c("p_name").alias(f"{prefix}_name"), c("p_retailprice").alias(f"{prefix}_price"))


def _extreme(name: str, prefix: str, order_sql: str, order: list[str]):
    columns = f"int: p_partkey; text: p_brand {prefix}_name; float: p_retailprice {prefix}_price premium"

    @query(name, columns, f"""
        SELECT p_partkey, p.p_brand, {prefix}_name, p_retailprice, {prefix}_price,
          {m('p_retailprice')} - {m(prefix + '_price')} AS premium FROM part p JOIN (
          SELECT DISTINCT ON (p_brand) p_brand, p_name AS {prefix}_name, p_retailprice AS {prefix}_price FROM part
          ORDER BY p_brand, {order_sql}) x ON x.p_brand = p.p_brand""")
    def _(t: Tables):
        joined = t.part.join(_picked(t, order, 1, prefix), "p_brand")
        return joined.withColumn("premium", money("p_retailprice") - money(f"{prefix}_price"))


_extreme("win_first_value", "cheapest", "p_retailprice, p_partkey", ["p_retailprice", "p_partkey"])
_extreme("win_last_value", "dearest", "p_retailprice DESC, p_partkey DESC", ["-p_retailprice", "-p_partkey"])

_NTH = "int: p_partkey; text: p_brand second_name; float: second_price"
_NTH_SQL = """
    SELECT p.p_partkey, p.p_brand, x.second_name, x.second_price FROM part p LEFT JOIN (
      SELECT p_brand, p_name AS second_name, p_retailprice AS second_price FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = 2) x ON x.p_brand = p.p_brand"""


@query("win_nth_value", _NTH, _NTH_SQL)
def _(t: Tables):
    return t.part.join(_picked(t, ["-p_retailprice", "p_partkey"], 2, "second"), "p_brand", "left")


@query("win_offset_sub", "text: p_brand second_name; float: second_price", """
    SELECT b.p_brand, x.p_name AS second_name, x.p_retailprice AS second_price FROM (SELECT DISTINCT p_brand FROM part) b
    JOIN LATERAL (SELECT * FROM part q WHERE q.p_brand = b.p_brand ORDER BY p_retailprice DESC, p_partkey LIMIT 1 OFFSET 1) x ON TRUE""")
def _(t: Tables):
    return _picked(t, ["-p_retailprice", "p_partkey"], 2, "second")


_O = ["o_orderdate", "o_orderkey"]


@query("win_running_total", "int: o_custkey o_orderkey; float: running_total", f"""
    SELECT o.o_custkey, o.o_orderkey, SUM({m('p.o_totalprice')}) AS running_total FROM orders o JOIN orders p
      ON p.o_custkey = o.o_custkey AND (p.o_orderdate, p.o_orderkey) <= (o.o_orderdate, o.o_orderkey) GROUP BY 1, 2""")
def _(t: Tables):
    return running(t.orders, ["o_custkey"], _O, {"running_total": ("sum", money("o_totalprice"))})


def _mean(window, back: int, column: str):
    frame = window.rowsBetween(-back, 0)
    return ratio(F.sum(column).over(frame), F.count(column).over(frame))


@query("win_moving_avg", "int: o_custkey o_orderkey; float: moving_avg", f"""
    SELECT o_custkey, o_orderkey, {r(f"SUM({m('o_totalprice')}) OVER w / COUNT(*) OVER w")} AS moving_avg FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _(t: Tables):
    priced = t.orders.withColumn("amount", money("o_totalprice"))
    return framed(priced, ["o_custkey"], _O, lambda w: {"moving_avg": _mean(w, 2, "amount")}, before=2)


@query("win_moving_avg_daily", "text: day; float: revenue moving_avg", f"""
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM({m('o_totalprice')}) AS revenue FROM orders GROUP BY 1)
    SELECT day, revenue, {r('SUM(revenue) OVER w / COUNT(*) OVER w')} AS moving_avg FROM d
    WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _(t: Tables):
    """One row per calendar day, so the window over all of it is bounded by the calendar."""
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias("revenue"))
    return framed(daily, [], ["day"], lambda w: {"moving_avg": _mean(w, 6, "revenue")}, before=6, bounded=True)


@query("win_total", "int: o_custkey o_orderkey; float: lifetime", f"""
    SELECT o_custkey, o_orderkey, SUM({m('o_totalprice')}) OVER (PARTITION BY o_custkey) AS lifetime FROM orders""")
def _(t: Tables):
    return with_totals(t.orders, ["o_custkey"], {"lifetime": F.sum(money("o_totalprice"))})


@query("win_pct_total", "int: o_custkey o_orderkey; float: pct", f"""
    SELECT o.o_custkey, o_orderkey, {r(f"{m('o_totalprice')} / s.total * 100")} AS pct FROM orders o JOIN (
      SELECT o_custkey, SUM({m('o_totalprice')}) AS total FROM orders GROUP BY 1) s ON s.o_custkey = o.o_custkey""")
def _(t: Tables):
    shares = with_totals(t.orders, ["o_custkey"], {"total": F.sum(money("o_totalprice"))})
    return shares.withColumn("pct", ratio(money("o_totalprice"), c("total"), 2, 100))


@query("win_grand_total", "int: o_orderkey; float: grand_total pct", f"""
    SELECT o_orderkey, SUM({m('o_totalprice')}) OVER () AS grand_total,
      {r(f"{m('o_totalprice')} / SUM({m('o_totalprice')}) OVER () * 100", 6)} AS pct FROM orders""")
def _(t: Tables):
    shares = with_totals(t.orders, [], {"grand_total": F.sum(money("o_totalprice"))})
    return shares.withColumn("pct", ratio(money("o_totalprice"), c("grand_total"), 6, 100))


@query("win_range_peers", "int: o_custkey o_orderkey; float: running_total", f"""
    SELECT o_custkey, o_orderkey, SUM({m('o_totalprice')}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS running_total
    FROM orders""")
def _(t: Tables):
    return peers_running(t.orders, ["o_custkey"], ["o_orderdate"], money("o_totalprice"), "running_total")


@query("win_avg_filter", "int: p_partkey; text: p_type; float: p_retailprice type_average", f"""
    SELECT p.p_partkey, p.p_type, p.p_retailprice, a.type_average FROM part p JOIN (SELECT p_type,
      {r(f"SUM({m('p_retailprice')}) / COUNT(*)", 4)} AS type_average FROM part GROUP BY 1) a ON a.p_type = p.p_type
    WHERE {m('p.p_retailprice')} > a.type_average""")
def _(t: Tables):
    averaged = with_totals(t.part, ["p_type"], {"type_average": ratio(F.sum(money("p_retailprice")), F.count(F.lit(1)), 4)})
    return averaged.filter(money("p_retailprice") > c("type_average"))


@query("win_latest_attr", "int: c_custkey; text: c_name latest_day; float: latest_amount", """
    SELECT c_custkey, c_name, (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P'
        ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) AS latest_day,
      (SELECT o_totalprice FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P'
        ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) AS latest_amount FROM customer""")
def _(t: Tables):
    """Both attributes come from one pass; customers without such orders stay."""
    latest = nth_rows(t.orders.filter("o_orderstatus = 'P'"), ["o_custkey"], ["-o_orderdate", "-o_orderkey"])
    return t.customer.join(latest, c("c_custkey") == c("o_custkey"), "left").select(
        "c_custkey", "c_name", F.to_date("o_orderdate").alias("latest_day"), c("o_totalprice").alias("latest_amount"))


@query("win_numbered_lines", "int: l_orderkey l_linenumber l_partkey l_suppkey rn", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ROW_NUMBER() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber,
      l_partkey, l_suppkey) AS rn FROM lineitem""")
def _(t: Tables):
    """Numbering a whole table in date order, over range slices instead of one task."""
    return number_rows(t.lineitem.select("l_shipdate", *LINE_ID), [], ["l_shipdate", *LINE_ID])
