"""Related synthetic tables over the orders' keys and dates. The twins repeat the integer arithmetic and walk by recursion."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemason.plans.registry import Tables, query
from lakemason.session import cut
from lakemason.sources import chains as G

c = F.col
_P = G.PRIME


def _draw(name: str, row: str) -> str:
    s = G.stream(42, name)
    folded = f"(({row})::BIGINT % {_P} + (({row})::BIGINT // 2147483648) * 7919 + {s}) % {_P}"
    one = f"(({folded}) * 48271 + 11) % {_P}"
    three = f"(xor({one}, ({one}) >> 13) * 1597334677 + {s}) % {_P}"
    return f"(xor({three}, ({three}) >> 16) * 69621 % {_P})"


def _between(name: str, row: str, least: int, most: int) -> str:
    return f"({_draw(name, row)} % {most - least + 1} + {least})"


def _permuted(name: str, x: str, n: str) -> str:
    keys = ", ".join(str(G.stream(42, f"{name} round {i}")) for i in range(G.ROUNDS))
    mirror = f"(((key - spot) % {n} + {n}) % {n})"
    swap = f"CASE WHEN {_draw(name, f'greatest(spot, {mirror}) + key')} % 2 = 1 THEN {mirror} ELSE spot END"
    return f"list_reduce([{keys}]::BIGINT[], lambda spot, key: {swap}, ({x})::BIGINT)"


def _moves(moves: G.Moves) -> str:
    rows = []
    for state, options in moves.items():
        low, total = 0, sum(o[1] for o in options)
        for target, weight, least, most in options:
            rows.append(f"('{state}', {'NULL' if target is None else repr(target)}, {low}, {low + weight}, {total}, {least}, {most})")
            low += weight
    return ", ".join(rows)


def _walk(table: str, name: str, start: str, source: str, moves: G.Moves, longest: int) -> str:
    """A recursive table of the steps of each row of ``source``."""
    place = f"w.order_id * {longest} + w.step"
    return f"""{table}_moves(state, target, low, high, total, least, most) AS (VALUES {_moves(moves)}),
    {table} AS (SELECT order_id, 1 AS step, '{start}' AS state, 0::BIGINT AS after FROM {source}
      UNION ALL SELECT w.order_id, w.step + 1, v.target, w.after + v.least * 3600 + {_draw(f'{name} time', place)} % ((v.most - v.least) * 3600 + 1)
      FROM {table} w JOIN {table}_moves v ON v.state = w.state AND {_draw(f'{name} move', place)} % v.total >= v.low
        AND {_draw(f'{name} move', place)} % v.total < v.high WHERE v.target IS NOT NULL AND w.step < {longest})"""


_STATES = f"""WITH RECURSIVE base AS (SELECT o_orderkey AS order_id, o_orderdate AS ordered_at FROM orders),
    {_walk('steps', 'order', 'pending', 'base', G.ORDER_MOVES, G.ORDER_STEPS)},
    ended AS (SELECT order_id, arg_max(state, step) AS status, max(after) FILTER (WHERE state = 'shipped') AS gone,
      max(after) FILTER (WHERE state = 'delivered') AS come FROM steps GROUP BY order_id)"""
_ITEMS = f"""items AS (SELECT order_id, line_number, product_id, {_between('quantity', 'place', 1, 4)} AS quantity,
      {_between('price', 'product_id', 500, 20000)} AS unit_cents
    FROM (SELECT *, {_permuted('product', 'product_rank', 'n')} AS product_id
      FROM (SELECT *, ((((u * u) >> 31) * u >> 31) * n) >> 31 AS product_rank
        FROM (SELECT *, order_id * 5 + line_number AS place, {_draw('product rank', 'order_id * 5 + line_number')} AS u
          FROM (SELECT order_id, unnest(range(1, {_between('lines', 'order_id', 1, 5)} + 1)) AS line_number, (SELECT COUNT(*) FROM part) AS n FROM base)))))"""
_CARRIERS = ", ".join(f"'{x}'" for x in G.CARRIERS)
_SHIPMENTS = f"""gone AS (SELECT order_id, ordered_at, gone, come, status FROM ended JOIN base USING (order_id) WHERE gone IS NOT NULL),
    {_walk('parcel', 'parcel', 'shipment_created', 'gone', G.PARCEL_MOVES, G.PARCEL_STEPS)},
    sized AS (SELECT order_id, max(step) AS size, max(after) AS tail FROM parcel GROUP BY order_id),
    way AS (SELECT g.*, size, tail, CASE WHEN come IS NULL THEN {_draw('parcel now', 'g.order_id')} % size + 1 ELSE size END AS passed
      FROM gone g JOIN sized s ON s.order_id = g.order_id),
    happened AS (
      SELECT w.order_id, step AS event_no, state AS event_type,
        CASE WHEN come IS NULL THEN after ELSE after * (come - gone) // (tail + 3600) END AS after FROM parcel p JOIN way w ON w.order_id = p.order_id WHERE step <= passed
      UNION ALL SELECT order_id, size + 1, 'delivered', come - gone FROM way WHERE come IS NOT NULL),
    sent AS (SELECT order_id, {_permuted('tracking', 'order_id', 'ids')} AS tracking_no, {_draw('warehouse', 'order_id')} % 10 AS warehouse_id,
        [{_CARRIERS}][{_draw('carrier', 'order_id')} % 5 + 1] AS carrier,
        (SELECT arg_max(event_type, event_no) FROM happened h WHERE h.order_id = w.order_id) AS shipment_status, ordered_at + to_seconds(gone) AS shipped_at,
        ordered_at + to_seconds(COALESCE(greatest(come - {_between('late', 'order_id', -24, 48)} * 3600, gone + 86400),
          gone + {_between('promise', 'order_id', 1, 7)} * 86400)) AS promised_at, ordered_at + to_seconds(come) AS delivered_at
      FROM (SELECT *, (SELECT MAX(o_orderkey) + 1 FROM orders) AS ids FROM way) w),
    events AS (SELECT order_id, event_no, event_type, shipped_at + to_seconds(after) AS happened_at FROM happened JOIN sent USING (order_id))"""


def _orders(t: Tables):
    return G.with_states(t.orders.select(c("o_orderkey").alias("order_id"), c("o_orderdate").alias("ordered_at")))


def _items(t: Tables):
    return G.order_items(_orders(t), t.part.agg(F.count(F.lit(1))).scalar())


def _shipments(t: Tables):
    return G.shipments(_orders(t), t.orders.agg(F.max("o_orderkey") + 1).scalar())


@query("src_synth", "int: o_orderkey; text: status; float: fee", f"""
    {_STATES} SELECT order_id AS o_orderkey, status, {_between('fee', 'order_id', 100, 2000)} / 100 AS fee FROM ended""")
def _(t: Tables):
    return _orders(t).select(c("order_id").alias("o_orderkey"), "status", (G.between(42, "fee", "order_id", 100, 2000) / 100).alias("fee"))


@query("src_synth_states", "int: order_id step; text: state; time: happened_at", f"""
    {_STATES} SELECT order_id, step, state, ordered_at + to_seconds(after) AS happened_at FROM steps JOIN base USING (order_id)""")
def _(t: Tables):
    return G.order_states(_orders(t))


@query("src_synth_items", "int: order_id line_number product_id quantity unit_cents", f"{_STATES}, {_ITEMS} SELECT * FROM items")
def _(t: Tables):
    return _items(t)


@query("src_synth_shipments", "int: order_id tracking_no warehouse_id; text: carrier shipment_status; time: shipped_at promised_at delivered_at", f"""
    {_STATES}, {_SHIPMENTS} SELECT * FROM sent""")
def _(t: Tables):
    return _shipments(t)


@query("src_synth_events", "int: order_id event_no; text: event_type; time: happened_at", f"{_STATES}, {_SHIPMENTS} SELECT * FROM events")
def _(t: Tables):
    return G.delivery_events(_shipments(t))


@query("src_synth_checks", "text: check_name; int: row_count violations", f"""
    {_STATES}, {_ITEMS}, {_SHIPMENTS}
    SELECT 'item has its order' AS check_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM base)) AS violations FROM items
    UNION ALL SELECT 'shipment follows its order', COUNT(*), COUNT(*) FILTER (WHERE shipped_at < ordered_at OR status NOT IN ('shipped', 'delivered', 'refunded'))
      FROM sent JOIN base USING (order_id) JOIN ended USING (order_id)
    UNION ALL SELECT 'delivery follows its shipment', COUNT(*), COUNT(*) FILTER (WHERE delivered_at < shipped_at OR (delivered_at IS NULL) <> (status = 'shipped'))
      FROM sent JOIN ended USING (order_id)
    UNION ALL SELECT 'event lies in its shipment', COUNT(*), COUNT(*) FILTER (WHERE happened_at < shipped_at OR happened_at > delivered_at)
      FROM events JOIN sent USING (order_id)
    UNION ALL SELECT 'tracking number is unique', COUNT(*), COUNT(*) - COUNT(DISTINCT tracking_no) FROM sent""")
def _(t: Tables):
    orders, sent = cut(_orders(t)), _shipments(t)
    return G.violations(orders, _items(t), sent, G.delivery_events(sent))
