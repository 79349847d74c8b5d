"""Star schema over the tables: dimensions, facts and reports.

customer = customers, part = products (cost = retail price), supplier = warehouses and carriers,
lineitem = order lines and shipments. A line's net amount is its extended price.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from lakemason.functions.columns import date_key, money, ratio
from lakemason.operators import joins as J, warehouse as W
from lakemason.operators.merge import upsert_ignore, upsert_replace
from lakemason.operators.ordered import nth_rows, number_rows
from lakemason.operators.topk import top_k
from lakemason.plans.generated import _draw
from lakemason.plans.registry import Tables, m, query, r
from lakemason.session import cut
from lakemason.sources.chains import draw

c = F.col
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# ---------------------------------------------------------------- dimensions in SQL, for the twins
_DATE_SQL = """dim_date AS (SELECT -1 AS date_key, DATE '1900-01-01' AS calendar_date, 1900 AS year, 0 AS quarter,
    'Unknown' AS quarter_name, 0 AS month, 'Unknown' AS month_name, 'Unk' AS month_short, '1900-00' AS year_month,
    0 AS day_of_month, 0 AS day_of_week, 'Unknown' AS day_name, FALSE AS is_weekend, 0 AS iso_week, 1900 AS fiscal_year,
    'Unknown' AS fiscal_quarter, FALSE AS is_holiday, 'Not Applicable' AS holiday_name
  UNION ALL SELECT CAST(strftime(d, '%Y%m%d') AS INT), CAST(d AS DATE), year(d), quarter(d), 'Q' || quarter(d), month(d),
    monthname(d), LEFT(monthname(d), 3), strftime(d, '%Y-%m'), day(d), isodow(d), dayname(d), isodow(d) >= 6, week(d),
    (year(d) * 12 + month(d) + 5) // 12,
    'FY' || RIGHT(CAST((year(d) * 12 + month(d) - 7) // 12 AS VARCHAR), 2) || '-Q' || ((month(d) + 5) % 12 // 3 + 1),
    strftime(d, '%m%d') IN ('0101','0704','1225'),
    CASE strftime(d, '%m%d') WHEN '0101' THEN 'New Year''s Day' WHEN '0704' THEN 'Independence Day' WHEN '1225' THEN 'Christmas Day' END
  FROM (SELECT unnest(generate_series(CAST(CAST(MIN(lo) AS DATE) AS TIMESTAMP), CAST(CAST(MAX(hi) AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM (
    SELECT MIN(o_orderdate) AS lo, MAX(o_orderdate) AS hi FROM orders UNION ALL SELECT MIN(l_shipdate), MAX(l_shipdate) FROM lineitem)))"""
_CUSTOMER_SQL = """dim_customer AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey, c_name,
    c_mktsegment, COALESCE(n_name, 'Unknown City') AS city, COALESCE(r_name, 'Unknown Country') AS country FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT -1, NULL, 'Unknown Customer', 'N/A', 'N/A', 'N/A')"""
_PRODUCT_SQL = f"""dim_product AS (SELECT row_number() OVER (ORDER BY p_partkey) AS product_sk, p_partkey, p_name, p_brand,
    COALESCE(NULLIF(p_type, 'PROMO'), 'Uncategorized') AS category, {m('p_retailprice')} AS cost_price FROM part
    UNION ALL SELECT -1, NULL, 'Unknown Product', 'Unknown Brand', 'Uncategorized', 0)"""
def _cents(x: str) -> str:
    return f"CAST({x} * 100 AS HUGEINT)"


def _share_sql(weight: str, total: str, amount: str) -> str:
    """Exact half-up share in integers: twenty digits of ratio, then the amount in cents."""
    one = "CAST(100000000000000000000 AS HUGEINT)"
    ratio20 = f"((2 * {_cents(weight)} * {one} + {_cents(total)}) // (2 * {_cents(total)}))"
    return f"CAST((2 * {ratio20} * {_cents(amount)} + {one}) // (2 * {one}) AS DOUBLE) / 100"


# A tenth of the orders carries a customer key that no dimension row has.
_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


def _fact_sql(price: str) -> str:
    return f"""priced AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS line_id, {price} AS net FROM lineitem),
  raw AS (SELECT l.*, o.*, {m('l_quantity')} AS quantity, {m('o_totalprice')} AS total, ROUND({m('o_totalprice')} * 0.08, 2) AS tax,
    SUM(net) OVER (PARTITION BY l_orderkey) AS subtotal FROM priced l JOIN orders o ON l_orderkey = o_orderkey),
  fact AS (SELECT l_orderkey, line_id, l_linenumber, l_partkey, l_suppkey, COALESCE(d.date_key, -1) AS order_date_fk,
    COALESCE(dc.customer_sk, -1) AS customer_fk, COALESCE(p.product_sk, -1) AS product_fk, o_orderkey AS order_number,
    o_orderstatus AS order_status, quantity, net AS net_sales, ROUND(quantity * COALESCE(p.cost_price, 0), 2) AS cost_amount,
    ROUND(net - quantity * COALESCE(p.cost_price, 0), 2) AS margin,
    CASE WHEN subtotal > 0 THEN {_share_sql('net', 'subtotal', 'total')} ELSE 0 END AS allocated,
    CASE WHEN subtotal > 0 THEN {_share_sql('net', 'subtotal', 'tax')} ELSE 0 END AS allocated_tax
  FROM raw LEFT JOIN dim_date d ON d.date_key = CAST(strftime(o_orderdate, '%Y%m%d') AS INT)
  LEFT JOIN dim_customer dc ON dc.c_custkey = CASE WHEN o_custkey % 10 = 3 THEN -o_custkey ELSE o_custkey END
  LEFT JOIN dim_product p ON p.p_partkey = l_partkey)"""


_DIM_SQL = f"WITH {_DATE_SQL}, {_CUSTOMER_SQL}, {_PRODUCT_SQL}"
_STAR_SQL = f"{_DIM_SQL}, {_fact_sql(m('l_extendedprice'))}"


# ---------------------------------------------------------------- dimensions
def calendar(t: Tables) -> DataFrame:
    """Every day from the first to the last date of orders and shipments."""
    return W.dim_date(t.spark, *W.date_bounds((t.orders, "o_orderdate"), (t.lineitem, "l_shipdate")))


def _keyed(dim: DataFrame, natural: str, key: str, member: dict[str, object]) -> DataFrame:
    """Assign surrogate keys to a fresh dimension and add its unknown member."""
    return W.with_unknown(W.assign_keys(dim, [natural], key).join(dim, natural), member)


def customer_rows(t: Tables) -> DataFrame:
    """Customers with their place flattened in; nation 7 is treated as missing to show the defaults."""
    places = t.nation.filter("n_nationkey <> 7").join(t.region, c("n_regionkey") == c("r_regionkey"), "left")
    return t.customer.join(places, c("c_nationkey") == c("n_nationkey"), "left").select(
        "c_custkey", "c_name", "c_mktsegment", F.coalesce("n_name", F.lit("Unknown City")).alias("city"),
        F.coalesce("r_name", F.lit("Unknown Country")).alias("country"))


def dim_customer(t: Tables) -> DataFrame:
    return _keyed(customer_rows(t), "c_custkey", "customer_sk", {
        "customer_sk": -1, "c_name": "Unknown Customer", "c_mktsegment": "N/A", "city": "N/A", "country": "N/A"})


def dim_product(t: Tables) -> DataFrame:
    category = F.coalesce(F.nullif(c("p_type"), F.lit("PROMO")), F.lit("Uncategorized"))
    rows = t.part.select("p_partkey", "p_name", "p_brand", category.alias("category"), money("p_retailprice").alias("cost_price"))
    return _keyed(rows, "p_partkey", "product_sk", {
        "product_sk": -1, "p_name": "Unknown Product", "p_brand": "Unknown Brand", "category": "Uncategorized", "cost_price": 0})


@query("dw_dim_date", "int: date_key year quarter month day_of_month day_of_week iso_week fiscal_year; "
       "text: calendar_date quarter_name month_name month_short year_month day_name fiscal_quarter holiday_name; bool: is_weekend is_holiday; "
       "int: orders_count", f"""WITH {_DATE_SQL} SELECT dim_date.*, COALESCE(n, 0) AS orders_count FROM dim_date LEFT JOIN (
       SELECT COALESCE(CAST(strftime(o_orderdate, '%Y%m%d') AS INT), -1) AS k, COUNT(*) AS n FROM orders GROUP BY 1) ON k = date_key""")
def _(t: Tables):
    """Every calendar attribute, with the orders of each day."""
    used = t.orders.groupBy(date_key("o_orderdate").alias("date_key")).agg(F.count(F.lit(1)).alias("orders_count"))
    return J.left_join_default(calendar(t), used, ["date_key"], {"orders_count": 0})


@query("dw_dim_customer", "int: customer_sk c_custkey; text: c_name c_mktsegment city country", f"WITH {_CUSTOMER_SQL} SELECT * FROM dim_customer")
def _(t: Tables):
    return dim_customer(t)


@query("dw_dim_product", "int: product_sk p_partkey; text: p_name p_brand category; float: cost_price", f"WITH {_PRODUCT_SQL} SELECT * FROM dim_product")
def _(t: Tables):
    return dim_product(t)


@query("dw_dim_warehouse", "int: s_suppkey; text: s_name", """
    SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0
    UNION ALL SELECT s_suppkey, 'new ' || s_name FROM supplier WHERE s_suppkey % 2 <> 0""")
def _(t: Tables):
    """Insert-only dimension: half the rows are already there and keep their stored name."""
    stored = t.supplier.filter("s_suppkey % 2 = 0").select("s_suppkey", "s_name")
    return upsert_ignore(stored, t.supplier.select("s_suppkey", F.concat(F.lit("new "), "s_name").alias("s_name")), ["s_suppkey"])


@query("dw_best_address", "int: c_custkey user_key; text: kind day", """
    SELECT c_custkey, user_id AS user_key, event_type AS kind, CAST(ts AS DATE) AS day FROM customer LEFT JOIN (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_type = 'signup' DESC, ts DESC, event_id) AS rn FROM events) e
      ON user_id = c_custkey AND rn = 1""")
def _(t: Tables):
    """One preferred row per customer: the default kind first, then the newest."""
    ranked = t.events.withColumn("is_default", c("event_type") == "signup")
    best = W.best_row(ranked, ["user_id"], ["-is_default", "-ts", "event_id"])
    return t.customer.join(best, c("user_id") == c("c_custkey"), "left").select(
        "c_custkey", c("user_id").alias("user_key"), c("event_type").alias("kind"), F.to_date("ts").alias("day"))


@query("dw_surrogate_key", "int: c_custkey customer_sk", """
    WITH known AS (SELECT c_custkey, 1000 + row_number() OVER (ORDER BY c_custkey) AS customer_sk FROM customer WHERE c_custkey % 3 = 0)
    SELECT * FROM known UNION ALL SELECT c_custkey, (SELECT MAX(customer_sk) FROM known) + row_number() OVER (ORDER BY c_custkey)
    FROM customer WHERE c_custkey % 3 <> 0""")
def _(t: Tables):
    """A third of the customers already has keys; the others are numbered after the highest one."""
    third = number_rows(t.customer.filter("c_custkey % 3 = 0").select("c_custkey"), [], ["c_custkey"], "rn")
    known = third.select("c_custkey", (c("rn") + 1000).cast("bigint").alias("customer_sk"))
    return W.assign_keys(t.customer, ["c_custkey"], "customer_sk", known)


# Hash bucket of a customer, in arithmetic that both sides have.
_BUCKET_SQL = f"{_draw('bucket', 'c_custkey')} % 64"


@query("dw_surrogate_key_bucket", "int: c_custkey customer_sk", f"""
    WITH known AS (SELECT c_custkey, 1000 + row_number() OVER (ORDER BY {_BUCKET_SQL}, c_custkey) AS customer_sk FROM customer WHERE c_custkey % 3 = 0)
    SELECT * FROM known UNION ALL SELECT c_custkey, (SELECT MAX(customer_sk) FROM known) + row_number() OVER (ORDER BY {_BUCKET_SQL}, c_custkey)
    FROM customer WHERE c_custkey % 3 <> 0""")
def _(t: Tables):
    """As dw_surrogate_key, numbered by counts of hash buckets instead of a sort of all rows."""
    bucket = draw(42, "bucket", "c_custkey") % 64
    third = W.number_by_bucket(t.customer.filter("c_custkey % 3 = 0").select("c_custkey"), ["c_custkey"], "rn", bucket=bucket)
    known = third.select("c_custkey", (c("rn") + 1000).cast("bigint").alias("customer_sk"))
    return W.assign_keys_by_bucket(t.customer, ["c_custkey"], "customer_sk", known, bucket=bucket)


@query("dw_dim_customer_load", "int: customer_sk c_custkey; text: c_name country address_kind address_day address_choice", """
    WITH ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_type = 'signup' DESC, ts DESC, event_id) AS rn
        FROM events WHERE event_type IN ('signup', 'purchase') AND user_id % 7 <> 0),
      first_keys AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_sk FROM customer WHERE c_custkey % 2 = 0),
      keys AS (SELECT * FROM first_keys UNION ALL SELECT c_custkey, (SELECT COUNT(*) FROM first_keys) + row_number() OVER (ORDER BY c_custkey)
        FROM customer WHERE c_custkey % 2 <> 0)
    SELECT customer_sk, c.c_custkey, c_name, COALESCE(r_name, 'Unknown Country') AS country, COALESCE(event_type, 'no address') AS address_kind,
      COALESCE(CAST(CAST(ts AS DATE) AS VARCHAR), 'never') AS address_day, CASE WHEN event_type = 'signup' THEN 'default' WHEN event_type IS NOT NULL THEN 'newest'
      ELSE 'none' END AS address_choice
    FROM customer c JOIN keys k ON k.c_custkey = c.c_custkey LEFT JOIN ranked ON user_id = c.c_custkey AND rn = 1
      LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT -1, NULL, 'Unknown Customer', 'N/A', 'N/A', 'N/A', 'N/A'""")
def _(t: Tables):
    """Two loads, half of the customers and then all: keys stay, attributes and best address are taken anew."""
    details = t.events.filter("event_type IN ('signup', 'purchase') AND user_id % 7 <> 0").select(
        "user_id", c("event_type").alias("address_kind"), F.to_date("ts").cast("string").alias("address_day"), "ts", "event_id")

    def rows(customers: DataFrame) -> DataFrame:
        flat = customers.select("c_custkey", "c_name", "country")
        return W.with_best(flat, details, [("c_custkey", "user_id")], c("address_kind") == "signup", ["-ts", "event_id"],
                           {"address_kind": "no address", "address_day": "never"}, "address_choice")

    everyone = customer_rows(t)
    member = {"customer_sk": -1, "c_name": "Unknown Customer", **dict.fromkeys(("country", "address_kind", "address_day", "address_choice"), "N/A")}
    first = rows(everyone.filter("c_custkey % 2 = 0"))
    first = W.assign_keys(first, ["c_custkey"], "customer_sk").join(first, "c_custkey").withColumn("c_name", F.lit("as first loaded"))
    stored = cut(W.with_unknown(first.select("customer_sk", "c_custkey", "c_name", "country", "address_kind", "address_day", "address_choice"), member))
    return W.load_dimension(stored, rows(everyone), ["c_custkey"], "customer_sk")


@query("dw_unknown_member", "int: o_orderkey customer_fk", f"""
    WITH {_CUSTOMER_SQL} SELECT o_orderkey, COALESCE(customer_sk, -1) AS customer_fk FROM orders LEFT JOIN dim_customer
      ON c_custkey = CASE WHEN o_custkey % 10 = 3 THEN -o_custkey WHEN o_custkey % 10 = 4 THEN NULL ELSE o_custkey END""")
def _(t: Tables):
    """Orders with a bad key and orders without one both point to -1."""
    key = F.when(c("o_custkey") % 10 == 3, -c("o_custkey")).when(c("o_custkey") % 10 == 4, None).otherwise(c("o_custkey"))
    return W.lookup_key(t.orders.withColumn("source_key", key), dim_customer(t), [("source_key", "c_custkey")], "customer_sk", "customer_fk")


@query("dw_role_views", "int: o_orderkey order_date_key; text: order_date order_month order_quarter order_year_month; bool: order_is_weekend order_is_holiday", f"""
    WITH {_DATE_SQL} SELECT o_orderkey, date_key AS order_date_key, calendar_date AS order_date, month_name AS order_month,
      quarter_name AS order_quarter, year_month AS order_year_month, is_weekend AS order_is_weekend, is_holiday AS order_is_holiday
    FROM orders JOIN dim_date ON date_key = COALESCE(CAST(strftime(o_orderdate, '%Y%m%d') AS INT), -1)""")
def _(t: Tables):
    """Every order; one without a date is shown with the unknown member."""
    view = W.role_view(calendar(t), "order")
    keyed = t.orders.withColumn("order_date_key", date_key("o_orderdate"))
    return J.play_role(keyed, view, "order_date_key", "order_date_key", {name: name for name in view.columns if name != "order_date_key"})


@query("dw_snowflake", "int: p_partkey category_fk; text: category", """
    SELECT p_partkey, category_fk, category FROM part JOIN (SELECT p_type AS category, row_number() OVER (ORDER BY p_type) AS category_fk
      FROM (SELECT DISTINCT p_type FROM part)) ON category = p_type""")
def _(t: Tables):
    sub, narrow = W.snowflaked(t.part.select("p_partkey", c("p_type").alias("category")), "category", "category_fk")
    return narrow.join(sub, "category_fk")


# ---------------------------------------------------------------- facts
def order_lines(t: Tables, lines: DataFrame | None = None, orders: DataFrame | None = None) -> DataFrame:
    """Lines with their header; the header amounts are the total and a tax of eight percent of it."""
    joined = (t.lineitem if lines is None else lines).join(t.orders if orders is None else orders, c("l_orderkey") == c("o_orderkey"))
    return joined.withColumns({
        "net": money("l_extendedprice"), "quantity": money("l_quantity"), "header_amount": money("o_totalprice"),
        "header_tax": F.round(money("o_totalprice") * F.lit(Decimal("0.08")), 2)})


_LINE = "int: l_orderkey l_linenumber l_partkey l_suppkey; float: allocated"


@query("dw_allocate", _LINE, f"""
    SELECT {LINE_KEY}, CASE WHEN s > 0 THEN {_share_sql('w', 's', m('o_totalprice'))} ELSE 0 END AS allocated
    FROM (SELECT *, {m('l_extendedprice')} AS w, SUM({m('l_extendedprice')}) OVER (PARTITION BY l_orderkey) AS s FROM lineitem)
    JOIN orders ON l_orderkey = o_orderkey""")
def _(t: Tables):
    return W.allocate(order_lines(t), ["l_orderkey"], "net", {"header_amount": "allocated"}, bounded=True)


@query("dw_allocate_exact", "int: l_orderkey; float: allocated_total header_amount", f"""
    SELECT l_orderkey, MAX({m('o_totalprice')}) AS allocated_total, MAX({m('o_totalprice')}) AS header_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t: Tables):
    """With the residual on the largest line, the lines add up to the header to the cent."""
    lines = W.allocate(order_lines(t), ["l_orderkey"], "net", {"header_amount": "allocated"}, residual="largest", tie_break=[*LINE_ID[1:], "quantity"],
                       bounded=True)
    return lines.groupBy("l_orderkey").agg(F.sum("allocated").alias("allocated_total"), F.max("header_amount").alias("header_amount"))


class Star:
    """The dimensions that a load or report looks keys up in, each built when first used. Those named in ``stored``
    are written once: name the ones that are read more than once."""

    def __init__(self, t: Tables, *stored: str):
        self.t, self.stored = t, stored

    @cached_property
    def date(self) -> DataFrame:
        return calendar(self.t)

    @cached_property
    def customer(self) -> DataFrame:
        return cut(dim_customer(self.t)) if "customer" in self.stored else dim_customer(self.t)

    @cached_property
    def product(self) -> DataFrame:
        return cut(dim_product(self.t)) if "product" in self.stored else dim_product(self.t)


def keyed_lines(star: Star, lines: DataFrame | None = None) -> DataFrame:
    """Order lines with the surrogate keys of their dimensions and the unit cost of the product.

    Each key is looked up where it is: date and customer once an order, the product at the source line. ``lines`` may
    bring theirs.
    """
    orders = star.t.orders.withColumns({
        "source_key": F.when(c("o_custkey") % 10 == 3, -c("o_custkey")).otherwise(c("o_custkey")), "day_key": date_key("o_orderdate")})
    orders = W.lookup_key(orders, star.date.select("date_key"), [("day_key", "date_key")], "date_key", "order_date_fk")
    orders = W.lookup_key(orders, star.customer, [("source_key", "c_custkey")], "customer_sk", "customer_fk")
    if lines is None:
        lines = W.lookup_key(star.t.lineitem, star.product, [("l_partkey", "p_partkey")], "product_sk", "product_fk", {"cost_price": "unit_cost"})
    return order_lines(star.t, lines, orders)


def fact_sales(keyed: DataFrame, *, kept: Sequence[str] = (), allocated: Sequence[str] = ()) -> DataFrame:
    """Line-grain sales fact of ``keyed_lines``: cost and margin, and the header amounts named in ``allocated``.

    Reports leave the allocated amounts out, and with them the sum over the header's lines.
    """
    shares = {amount: out for out, amount in (("allocated", "header_amount"), ("allocated_tax", "header_tax")) if out in allocated}
    lines = W.allocate(keyed, ["l_orderkey"], "net", shares, bounded=True) if shares else keyed
    cost = c("quantity") * F.coalesce("unit_cost", F.lit(0).cast("decimal(18,2)"))
    return lines.select(
        *LINE_ID, *kept, "order_date_fk", "customer_fk", "product_fk", c("o_orderkey").alias("order_number"),
        c("o_orderstatus").alias("order_status"), "quantity", c("net").alias("net_sales"),
        F.round(cost, 2).alias("cost_amount"), F.round(c("net") - cost, 2).alias("margin"), *allocated)


_FACT_COLUMNS = ("int: l_orderkey line_id l_linenumber l_partkey l_suppkey order_date_fk customer_fk product_fk order_number; text: order_status; "
                 "float: quantity net_sales cost_amount margin allocated allocated_tax")
#: Every fourth order is repriced after the first load.
_REPRICED = f"CASE WHEN l_orderkey % 4 = 0 THEN {m('l_extendedprice')} + 1.25 ELSE {m('l_extendedprice')} END"


@query("dw_fact_sales", _FACT_COLUMNS, f"""{_DIM_SQL}, {_fact_sql(_REPRICED)}
    SELECT * REPLACE (CASE WHEN l_orderkey % 4 = 0 THEN 'repriced' ELSE order_status END AS order_status) FROM fact""")
def _(t: Tables):
    """A first load, then a batch with corrected prices that updates its lines in place.

    A line is known by its order and its number there (line numbers of the source repeat), not by its measures.
    An order has few lines, so they are numbered in a plain window on the key that the header is joined on. The numbers
    are unique within the order, so the merge need not count its source again.

    Lines are shuffled twice, to their product and then to their order. Numbers, header, shares and the merge stay with the
    order. The correction is a quarter of the orders, so it takes that quarter anew rather than the lines of the
    first load from a stored copy, which would have to be shuffled by order again.
    """
    amounts = ["allocated", "allocated_tax"]
    star = Star(t, "customer", "product")
    found = W.find_keys(t.lineitem, star.product, [("l_partkey", "p_partkey")], "product_sk", "found", {"cost_price": "unit_cost"})
    numbered = number_rows(found, ["l_orderkey"], _LINE_ORDER.split(", "), "line_id", bounded=True)
    lines = keyed_lines(star, W.settle_keys(numbered, "found", "product_fk", ["unit_cost"])).select(
        *LINE_ID, "line_id", "o_orderkey", "o_orderstatus", "net", "quantity", "header_amount", "header_tax",
        "order_date_fk", "customer_fk", "product_fk", "unit_cost")
    first = fact_sales(lines, kept=["line_id"], allocated=amounts)
    corrected = lines.filter("l_orderkey % 4 = 0").withColumns({
        "net": (c("net") + F.lit(Decimal("1.25"))).cast("decimal(18,2)"), "o_orderstatus": F.lit("repriced")})
    batch = fact_sales(corrected, kept=["line_id"], allocated=amounts)
    updated = ["order_status", "net_sales", "cost_amount", "margin", *amounts]
    return upsert_replace(first, batch, ["l_orderkey", "line_id"], updated, check_source=False, grouped_by=["l_orderkey"])


@query("dw_fact_verify", "int: total_rows; float: units net_sales margin", f"""{_STAR_SQL}
    SELECT COUNT(*) AS total_rows, SUM(quantity) AS units, SUM(net_sales) AS net_sales, SUM(margin) AS margin FROM fact""")
def _(t: Tables):
    return fact_sales(keyed_lines(Star(t))).agg(F.count(F.lit(1)).alias("total_rows"), F.sum("quantity").alias("units"),
                             F.sum("net_sales").alias("net_sales"), F.sum("margin").alias("margin"))


_MILESTONES_SQL = """ms AS (SELECT l_orderkey, MIN(l_shipdate) AS shipped_at, CASE WHEN MAX(l_shipdate) > MIN(l_shipdate)
    THEN MAX(l_shipdate) END AS delivered_at, MIN(l_shipdate) + INTERVAL 300 DAY AS due_at FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)"""


def _days_sql(later: str, earlier: str) -> str:
    return r(f"date_diff('second', {earlier}, {later}) / 86400.0")


@query("dw_fact_accumulating", "int: o_orderkey order_date_fk shipped_date_fk delivered_date_fk; float: days_to_ship days_in_transit "
       "total_delivery_days o_totalprice; bool: is_delivered is_delayed", f"""WITH {_MILESTONES_SQL}
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS order_date_fk,
      COALESCE(CAST(strftime(shipped_at, '%Y%m%d') AS INT), -1) AS shipped_date_fk,
      COALESCE(CAST(strftime(delivered_at, '%Y%m%d') AS INT), -1) AS delivered_date_fk,
      {_days_sql('shipped_at', 'o_orderdate')} AS days_to_ship, {_days_sql('delivered_at', 'shipped_at')} AS days_in_transit,
      {_days_sql('delivered_at', 'o_orderdate')} AS total_delivery_days, o_totalprice,
      delivered_at IS NOT NULL AS is_delivered, COALESCE(delivered_at > due_at, FALSE) AS is_delayed
    FROM orders LEFT JOIN ms ON l_orderkey = o_orderkey""")
def _(t: Tables):
    """Order lifecycle: first filled line ships, last one delivers. A half-loaded fact is updated in place."""
    shipped = F.min("l_shipdate")
    milestones = t.lineitem.filter("l_linestatus = 'F'").groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        shipped.alias("shipped_at"), F.max("l_shipdate").alias("last_at")).withColumns({
            "delivered_at": F.when(c("last_at") > c("shipped_at"), c("last_at")), "due_at": c("shipped_at") + F.expr("INTERVAL 300 DAYS")})
    full = W.accumulating(t.orders, milestones, "o_orderkey", "o_orderdate", "shipped_at", "delivered_at", "due_at").drop("last_at")
    updated = ["shipped_date_fk", "delivered_date_fk", "days_to_ship", "days_in_transit", "total_delivery_days", "is_delivered", "is_delayed"]
    early = full.filter("o_orderkey % 2 = 0").withColumns({"is_delivered": F.lit(False), "delivered_date_fk": F.lit(-1)})
    return upsert_replace(early, full, ["o_orderkey"], updated, check_source=False)


@query("dw_fact_periodic", "int: user_id; text: day; float: balance", f"""
    WITH last AS (SELECT user_id, CAST(ts AS DATE) AS day, {m('value')} AS v, ROW_NUMBER() OVER (
        PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'purchase'),
      cal AS (SELECT CAST(unnest(generate_series((SELECT MIN(day) FROM last), (SELECT MAX(day) FROM last), INTERVAL 1 DAY)) AS DATE) AS day),
      grid AS (SELECT u.user_id, cal.day FROM (SELECT user_id, MIN(day) AS lo FROM last GROUP BY 1) u JOIN cal ON cal.day >= lo)
    SELECT g.user_id, g.day, (SELECT v FROM last l WHERE l.user_id = g.user_id AND l.rn = 1 AND l.day <= g.day ORDER BY l.day DESC LIMIT 1)
      AS balance FROM grid g""")
def _(t: Tables):
    bought = t.events.filter("event_type = 'purchase'").withColumn("day", F.to_date("ts"))
    daily = nth_rows(bought, ["user_id", "day"], ["-ts", "-event_id"]).select("user_id", "day", money("value").alias("value"))
    return W.periodic_snapshot(daily, "user_id", "day", "value")


@query("dw_drill_across", "text: year_month; float: sales; int: visits", f"""
    SELECT COALESCE(a.ym, b.ym) AS year_month, COALESCE(s, 0) AS sales, COALESCE(v, 0) AS visits FROM
      (SELECT strftime(l_shipdate, '%m') AS ym, SUM({m('l_extendedprice')}) AS s FROM lineitem GROUP BY 1) a
      FULL JOIN (SELECT strftime(ts, '%m') AS ym, COUNT(*) AS v FROM events GROUP BY 1) b ON a.ym = b.ym""")
def _(t: Tables):
    """Two facts with different grains, aggregated to calendar month first and joined afterwards."""
    sales = t.lineitem.groupBy(F.date_format("l_shipdate", "MM").alias("year_month")).agg(F.sum(money("l_extendedprice")).alias("sales"))
    visits = t.events.groupBy(F.date_format("ts", "MM").alias("year_month")).agg(F.count(F.lit(1)).alias("visits"))
    return W.drill_across({"sales": sales, "visits": visits}, ["year_month"])


# ---------------------------------------------------------------- reports
_MARGIN_SQL = r("SUM(margin) / NULLIF(SUM(net_sales), 0) * 100")


@query("dw_bi_month_geo", "text: year_month country; int: total_orders; float: units revenue profit margin_pct", f"""{_STAR_SQL}
    SELECT year_month, country, COUNT(DISTINCT order_number) AS total_orders, SUM(quantity) AS units, SUM(net_sales) AS revenue,
      SUM(margin) AS profit, {_MARGIN_SQL} AS margin_pct FROM fact JOIN dim_date ON order_date_fk = date_key
    JOIN dim_customer ON customer_fk = customer_sk GROUP BY 1, 2""")
def _(t: Tables):
    star = Star(t, "customer")
    sales = fact_sales(keyed_lines(star)).join(star.date, c("order_date_fk") == c("date_key")).join(star.customer, c("customer_fk") == c("customer_sk"))
    return sales.groupBy("year_month", "country").agg(
        F.count_distinct("order_number").alias("total_orders"), F.sum("quantity").alias("units"), F.sum("net_sales").alias("revenue"),
        F.sum("margin").alias("profit"), ratio(F.sum("margin"), F.sum("net_sales"), 2, 100).alias("margin_pct"))


@query("dw_bi_fiscal", "int: fiscal_year; text: fiscal_quarter category; float: units sales profit average_line", f"""{_STAR_SQL}
    SELECT fiscal_year, fiscal_quarter, category, SUM(quantity) AS units, SUM(net_sales) AS sales, SUM(margin) AS profit,
      {r('SUM(net_sales) / COUNT(*)')} AS average_line FROM fact JOIN dim_date ON order_date_fk = date_key
    JOIN dim_product ON product_fk = product_sk GROUP BY 1, 2, 3""")
def _(t: Tables):
    star = Star(t, "product")
    sales = fact_sales(keyed_lines(star)).join(star.date, c("order_date_fk") == c("date_key")).join(star.product, c("product_fk") == c("product_sk"))
    return sales.groupBy("fiscal_year", "fiscal_quarter", "category").agg(
        F.sum("quantity").alias("units"), F.sum("net_sales").alias("sales"), F.sum("margin").alias("profit"),
        ratio(F.sum("net_sales"), F.count(F.lit(1))).alias("average_line"))


@query("dw_bi_customer_value", "int: customer_sk orders_placed; text: c_name city country; float: items spend profit margin_pct", f"""{_STAR_SQL}
    SELECT customer_sk, COUNT(DISTINCT order_number) AS orders_placed, c_name, city, country, SUM(quantity) AS items,
      SUM(net_sales) AS spend, SUM(margin) AS profit, {r("SUM(margin) / NULLIF(SUM(net_sales), 0) * 100", 1)} AS margin_pct
    FROM fact JOIN dim_customer ON customer_fk = customer_sk WHERE customer_sk <> -1 GROUP BY customer_sk, c_name, city, country
    ORDER BY spend DESC, customer_sk LIMIT 15""")
def _(t: Tables):
    """Aggregated by key first; only the top customers are joined to their attributes."""
    star = Star(t, "customer")
    spend = fact_sales(keyed_lines(star)).filter("customer_fk <> -1").groupBy("customer_fk").agg(
        F.count_distinct("order_number").alias("orders_placed"), F.sum("quantity").alias("items"), F.sum("net_sales").alias("spend"),
        F.sum("margin").alias("profit"), ratio(F.sum("margin"), F.sum("net_sales"), 1, 100).alias("margin_pct"))
    best = top_k(spend, ["-spend", "customer_fk"], 15)
    return best.join(star.customer, c("customer_fk") == c("customer_sk"))


@query("dw_bi_distribution_items", "text: city; int: items; float: value", f"""
    SELECT n_name AS city, COUNT(*) AS items, SUM({m('l_extendedprice')}) AS value FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus = 'P' AND n_name IN ('NATION_2','NATION_5')
    GROUP BY 1""")
def _(t: Tables):
    wanted = t.customer.join(t.nation.filter(c("n_name").isin("NATION_2", "NATION_5")), c("n_nationkey") == c("c_nationkey"))
    pending = t.orders.filter("o_orderstatus = 'P'").join(wanted, c("c_custkey") == c("o_custkey"))
    return t.lineitem.join(pending, c("l_orderkey") == c("o_orderkey")).groupBy(c("n_name").alias("city")).agg(
        F.count(F.lit(1)).alias("items"), F.sum(money("l_extendedprice")).alias("value"))


@query("dw_bi_carrier_lag", "int: o_orderkey days_to_ship days_in_transit total_days; text: carrier order_day", f"""WITH {_MILESTONES_SQL},
    f AS (SELECT l_orderkey, s_name FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey)
      AS rn FROM lineitem WHERE l_linestatus = 'F') JOIN supplier ON s_suppkey = l_suppkey WHERE rn = 1)
    SELECT o_orderkey, date_diff('day', o_orderdate, shipped_at) AS days_to_ship, date_diff('day', shipped_at, delivered_at) AS days_in_transit,
      date_diff('day', o_orderdate, delivered_at) AS total_days, s_name AS carrier, dayname(o_orderdate) AS order_day
    FROM orders JOIN ms ON ms.l_orderkey = o_orderkey JOIN f ON f.l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND delivered_at IS NOT NULL
    ORDER BY total_days DESC, o_orderkey LIMIT 15""")
def _(t: Tables):
    lines = t.lineitem.filter("l_linestatus = 'F'")
    spans = lines.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("shipped_at"), F.max("l_shipdate").alias("delivered_at")).filter("delivered_at > shipped_at")
    first = nth_rows(lines.select(c("l_orderkey").alias("f_orderkey"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"),
                     ["f_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"])
    orders = t.orders.filter("o_orderstatus = 'F'")
    joined = orders.join(spans, c("l_orderkey") == c("o_orderkey")).drop("l_orderkey")
    days = calendar(t)
    keyed = joined.withColumns({"order_key": date_key("o_orderdate"), "ship_key": date_key("shipped_at"), "deliver_key": date_key("delivered_at")})
    for key, columns in (("order_key", {"calendar_date": "ordered", "day_name": "order_day"}), ("ship_key", {"calendar_date": "shipped"}),
                         ("deliver_key", {"calendar_date": "delivered"})):
        keyed = J.play_role(keyed, days, "date_key", key, columns)
    lags = keyed.withColumns({"days_to_ship": F.datediff("shipped", "ordered"), "days_in_transit": F.datediff("delivered", "shipped"),
                              "total_days": F.datediff("delivered", "ordered")})
    top = top_k(lags, ["-total_days", "o_orderkey"], 15)
    return top.join(first, c("f_orderkey") == c("o_orderkey")).join(t.supplier, c("s_suppkey") == c("l_suppkey")).withColumn("carrier", c("s_name"))


@query("dw_bi_fk_lookup", "int: o_orderkey l_linenumber l_suppkey; text: order_day; float: l_quantity l_extendedprice", """
    SELECT o_orderkey, l_linenumber, l_suppkey, CAST(o_orderdate AS DATE) AS order_day, l_quantity, l_extendedprice
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_partkey = 450""")
def _(t: Tables):
    one = t.lineitem.filter("l_partkey = 450").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    return one.join(t.orders, c("o_orderkey") == c("l_orderkey")).withColumn("order_day", F.to_date("o_orderdate"))
