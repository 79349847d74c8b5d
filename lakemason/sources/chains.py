"""Related synthetic tables: order states that follow one another, and the items, shipments and delivery events
that follow them.

Everything is integer arithmetic on 64-bit numbers that stay far from overflow, so any engine that has ``%``, shifts
and XOR repeats it value for value. A value depends on the seed, a name and the row's own id alone: tables are made
in parallel, without a shuffle, and a lost partition is made again as it was.

* ``draw``      an even number for (seed, name, id).
* ``permuted``  a keyed permutation of 0..n-1 for any n, for keys that must be unique, and to scatter the ranks of
  ``skewed`` over all keys.
* ``walk``      a seeded walk through a table of moves between states, with the seconds that each move takes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.session import cut

#: Draws lie below this prime.
PRIME = 2_147_483_647
HOUR = 3600
#: Rounds of the permutation.
ROUNDS = 12

#: A move: next state (None: the walk ends here), weight, fewest and most hours it takes.
Moves = Mapping[str, Sequence[tuple[str | None, int, int, int]]]

# Out of 100 orders, how many take each step. The final states have the shares of ``ORDER_STATUS``.
ORDER_MOVES: Moves = {
    "pending": [(None, 3, 0, 0), ("cancelled", 3, 1, 24), ("confirmed", 94, 0, 12)],
    "confirmed": [(None, 10, 0, 0), ("cancelled", 3, 1, 24), ("packed", 81, 1, 24)],
    "packed": [(None, 10, 0, 0), ("cancelled", 2, 1, 24), ("shipped", 69, 3, 36)],
    "shipped": [(None, 10, 0, 0), ("delivered", 59, 12, 216)],
    "delivered": [(None, 55, 0, 0), ("refunded", 4, 24, 720)],
}
ORDER_STEPS = 6
#: A parcel may pass several hubs.
PARCEL_MOVES: Moves = {
    "shipment_created": [("picked_up", 1, 1, 8)],
    "picked_up": [("in_transit", 1, 1, 12)],
    "in_transit": [("arrived_at_hub", 1, 2, 24)],
    "arrived_at_hub": [("in_transit", 2, 1, 6), ("out_for_delivery", 3, 2, 12)],
}
PARCEL_STEPS = 12
CARRIERS = ["Delhivery", "BlueDart", "DHL", "FedEx", "Ecom Express"]


def stream(seed: int, name: str) -> int:
    """The number that stands for a seed and a name."""
    return zlib.crc32(f"{seed}:{name}".encode()) % PRIME


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def draw(seed: int, name: str, row: Column | str) -> Column:
    """An even number from 0 to ``PRIME`` - 1 for a non-negative id; NULL for NULL."""
    row = (F.col(row) if isinstance(row, str) else row).cast("bigint")
    s = stream(seed, name)
    folded = (row % PRIME + F.floor(row / F.lit(1 << 31)) * 7919 + s) % PRIME
    one = (folded * 48271 + 11) % PRIME
    two = one.bitwiseXOR(F.shiftright(one, 13))
    three = (two * 1597334677 + s) % PRIME
    four = three.bitwiseXOR(F.shiftright(three, 16))
    return four * 69621 % PRIME


def choice(seed: int, name: str, row: Column | str, values: Sequence[str]) -> Column:
    """One of the values, each as likely as the others."""
    return F.element_at(F.array(*map(F.lit, values)), (draw(seed, name, row) % len(values) + 1).cast("int"))


def between(seed: int, name: str, row: Column | str, least: int, most: int) -> Column:
    """A whole number from ``least`` to ``most``."""
    return draw(seed, name, row) % (most - least + 1) + least


def skewed(seed: int, name: str, row: Column | str, n: Column) -> Column:
    """A rank from 0 to n - 1; low ranks are drawn far more often: a share x of the ranks gets the cube root of x."""
    u = draw(seed, name, row)
    cube = F.shiftright(F.shiftright(u * u, 31) * u, 31)
    return F.shiftright(cube * n, 31)


def permuted(seed: int, name: str, x: Column, n: Column) -> Column:
    """``x`` (0 to n - 1) under a keyed permutation of 0..n-1.

    Each round pairs every number with its mirror image (key - number, modulo n) and swaps the pair or not by a
    draw on the pair; both members see the same draw, so each round is a permutation, whatever n is.
    """
    keys = F.array(*[F.lit(stream(seed, f"{name} round {r}")).cast("bigint") for r in range(ROUNDS)])

    def swap(at: Column, key: Column) -> Column:
        mirror = F.pmod(key - at, n)
        larger = F.greatest(at, mirror)
        return F.when(draw(seed, name, larger + key) % 2 == 1, mirror).otherwise(at)

    return F.aggregate(keys, x.cast("bigint"), swap)


def walk(seed: int, name: str, row: Column | str, start: str, moves: Moves, longest: int) -> Column:
    """The states a row passes, as ``array<struct<state, after>>``: ``after`` is seconds since the first state.

    Each step draws a move of the present state by weight and then its time. A walk ends in a state without moves,
    by drawing an end, or after ``longest`` states.
    """
    row = F.col(row) if isinstance(row, str) else row
    kind = "struct<state:string,after:bigint>"
    first = F.array(F.struct(F.lit(start).alias("state"), F.lit(0).cast("bigint").alias("after"))).cast(f"array<{kind}>")
    begun = F.struct(first.alias("path"), F.lit(False).alias("ended"))

    nothing = F.lit(None).cast(kind)

    def following(last: Column, drawn: Column, paced: Column) -> Column:
        result = nothing
        for state, options in moves.items():
            upper, ends = [], []
            for target, weight, least, most in options:
                upper.append(weight + (upper[-1] if upper else 0))
                seconds = last["after"] + least * HOUR + paced % ((most - least) * HOUR + 1)
                ends.append(nothing if target is None else F.struct(F.lit(target).alias("state"), seconds.alias("after")).cast(kind))
            chosen = ends[-1]
            for bound, end in reversed(list(zip(upper[:-1], ends))):
                chosen = F.when(drawn % upper[-1] < bound, end).otherwise(chosen)
            result = F.when(last["state"] == state, chosen).otherwise(result)
        return result

    def step(known: Column, number: Column) -> Column:
        place = row * F.lit(longest) + number
        drawn, paced = draw(seed, f"{name} move", place), draw(seed, f"{name} time", place)
        both = F.struct(drawn.alias("drawn"), paced.alias("paced"))
        chosen = _let(both, lambda d: following(F.element_at(known["path"], -1), d["drawn"], d["paced"]))
        moved = _let(chosen, lambda end: F.when(end.isNull(), F.struct(known["path"].alias("path"), F.lit(True).alias("ended"))).otherwise(
            F.struct(F.array_append(known["path"], end).alias("path"), F.lit(False).alias("ended"))))
        return F.when(known["ended"], known).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(longest - 1)), begun, step, lambda known: known["path"])


def _later(moment: Column, seconds: Column) -> Column:
    return moment + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("int"))


def with_states(orders: DataFrame, seed: int = 42) -> DataFrame:
    """Orders (``order_id``, ``ordered_at``, any others) with ``states``, the walk they made, and ``status``, its end."""
    walked = orders.withColumn("states", walk(seed, "order", "order_id", "pending", ORDER_MOVES, ORDER_STEPS))
    return walked.withColumn("status", F.element_at("states", -1)["state"])


def order_states(orders: DataFrame) -> DataFrame:
    """One row for each state of each order of ``with_states``: ``order_id, step, state, happened_at``."""
    rows = orders.select("order_id", "ordered_at", F.posexplode("states").alias("step", "s"))
    return rows.select("order_id", (F.col("step") + 1).alias("step"), "s.state", _later(F.col("ordered_at"), F.col("s.after")).alias("happened_at"))


def order_items(orders: DataFrame, products: Column, seed: int = 42, most: int = 5) -> DataFrame:
    """One to ``most`` lines for each order: ``order_id, line_number, product_id, quantity, unit_cents``. Product ids
    are 0 to ``products`` - 1, a few of them very frequent and scattered over all ids; a product has one price."""
    count = between(seed, "lines", "order_id", 1, most).cast("int")
    line = orders.select("order_id", F.explode(F.sequence(F.lit(1), count)).alias("line_number")).withColumn("__n", products.cast("bigint"))
    row, n = F.col("order_id") * most + F.col("line_number"), F.col("__n")
    line = line.withColumn("product_id", permuted(seed, "product", skewed(seed, "product rank", row, n), n))
    return line.select(
        "order_id", "line_number", "product_id", between(seed, "quantity", row, 1, 4).alias("quantity"),
        between(seed, "price", "product_id", 500, 20_000).alias("unit_cents"))


def shipments(orders: DataFrame, ids: Column, warehouses: int = 10, seed: int = 42) -> DataFrame:
    """One row for each order of ``with_states`` that was shipped; ``ids`` is more than any order id.

    The orders, the parcels' walks and the shipments are written to the checkpoint folder, so that each is made once.

    A shipment leaves when its order reaches ``shipped`` and arrives when it reaches ``delivered``; the arrival was
    promised up to two days off. ``tracking_no`` is unique. ``events`` is the parcel's own walk, stretched over its way.
    """

    def reached(state: str) -> Column:
        return F.get(F.filter("states", lambda s: s["state"] == state), F.lit(0))["after"]

    sent = cut(orders).withColumns({"__out": reached("shipped"), "__in": reached("delivered"), "__ids": ids}).filter(F.col("__out").isNotNull())
    promised = F.coalesce(
        F.greatest(F.col("__in") - between(seed, "late", "order_id", -24, 48) * HOUR, F.col("__out") + 24 * HOUR),
        F.col("__out") + between(seed, "promise", "order_id", 1, 7) * 24 * HOUR)
    sent = cut(sent.withColumn("__path", walk(seed, "parcel", "order_id", "shipment_created", PARCEL_MOVES, PARCEL_STEPS)))
    full = F.size("__path")
    passed = F.when(F.col("__in").isNull(), draw(seed, "parcel now", "order_id") % full + 1).otherwise(full).cast("int")
    way = F.coalesce(F.col("__in") - F.col("__out"), F.element_at("__path", -1)["after"])
    whole = F.element_at("__path", -1)["after"] + F.lit(HOUR)  # the last stretch, to the door, takes an hour of the walk
    scaled = F.transform(
        F.slice("__path", F.lit(1), passed),
        lambda e: F.struct(e["state"].alias("state"), F.when(F.col("__in").isNull(), e["after"]).otherwise(
            F.floor(e["after"] * way / whole)).cast("bigint").alias("after")))
    arrived = F.array(F.struct(F.lit("delivered").alias("state"), way.cast("bigint").alias("after")))
    events = F.when(F.col("__in").isNull(), scaled).otherwise(F.concat(scaled, arrived))
    at = F.col("ordered_at")
    return cut(sent.select(
        "order_id", permuted(seed, "tracking", F.col("order_id"), F.col("__ids")).alias("tracking_no"),
        (draw(seed, "warehouse", "order_id") % warehouses).alias("warehouse_id"), choice(seed, "carrier", "order_id", CARRIERS).alias("carrier"),
        F.element_at(events, -1)["state"].alias("shipment_status"), _later(at, F.col("__out")).alias("shipped_at"),
        _later(at, promised).alias("promised_at"), _later(at, F.col("__in")).alias("delivered_at"), events.alias("events")))


def delivery_events(sent: DataFrame) -> DataFrame:
    """One row for each event of each shipment, in order of time: ``order_id, event_no, event_type, happened_at``."""
    rows = sent.select("order_id", "shipped_at", F.posexplode("events").alias("n", "e"))
    return rows.select("order_id", (F.col("n") + 1).alias("event_no"), F.col("e.state").alias("event_type"), _later(F.col("shipped_at"), F.col("e.after")).alias("happened_at"))


def violations(orders: DataFrame, items: DataFrame, sent: DataFrame, events: DataFrame) -> DataFrame:
    """``check_name, row_count, violations`` of the rules that tie the tables together; all violations are 0.

    Each child is compared with its parent in one join on the order id.
    """
    parent = orders.select(F.col("order_id").alias("__id"), "ordered_at", "status")

    def checked(name: str, child: DataFrame, wrong: Column, other: DataFrame = parent) -> DataFrame:
        joined = child.join(other, F.col("order_id") == F.col("__id"), "left")
        return joined.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("__id").isNull() | wrong).alias("violations")).select(F.lit(name).alias("check_name"), "*")

    owner = sent.select(F.col("order_id").alias("__id"), "shipped_at", "delivered_at", "shipment_status")
    arrived = F.col("event_type") == "delivered"
    parts = [
        checked("item has its order", items, F.lit(False)),
        checked("shipment follows its order", sent, (F.col("shipped_at") < F.col("ordered_at")) | ~F.col("status").isin("shipped", "delivered", "refunded")),
        checked("delivery follows its shipment", sent, (F.col("delivered_at") < F.col("shipped_at")) | (F.col("delivered_at").isNotNull() == (F.col("status") == "shipped"))),
        checked("event lies in its shipment", events, (F.col("happened_at") < F.col("shipped_at")) | (F.col("happened_at") > F.col("delivered_at")) | (arrived & ~F.col("happened_at").eqNullSafe(F.col("delivered_at"))), owner),
    ]
    twice = sent.groupBy("tracking_no").agg(F.count(F.lit(1)).alias("n"))
    twice = twice.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count_if(F.col("n") > 1).alias("violations"))
    parts.append(twice.select(F.lit("tracking number is unique").alias("check_name"), "*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out
