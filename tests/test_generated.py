"""Related generators: draws, permutations and walks against plain Python, and the ties between the tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakemason.sources import chains as G


def plain_draw(seed, name, row):
    s, p = G.stream(seed, name), G.PRIME
    x = (row % p + row // 2**31 * 7919 + s) % p
    x = (x * 48271 + 11) % p
    x = ((x ^ x >> 13) * 1597334677 + s) % p
    return (x ^ x >> 16) * 69621 % p


def test_draws_are_portable_even_and_independent(spark):
    ids = [0, 1, 2, 77, G.PRIME - 1, G.PRIME, 2**31, 2**40 + 3, 2**62]
    rows = spark.createDataFrame([(i,) for i in ids + [None]], "id bigint").select("id", G.draw(7, "x", "id").alias("d")).collect()
    assert {r.id: r.d for r in rows} == {i: plain_draw(7, "x", i) for i in ids} | {None: None}
    many = spark.range(100_000).select(G.draw(7, "x", "id").alias("x"), G.draw(7, "y", "id").alias("y"), G.draw(8, "x", "id").alias("z"))
    tenths = many.groupBy((F.col("x") * 10 / G.PRIME).cast("int").alias("k")).count().collect()
    assert len(tenths) == 10 and all(9_500 < r["count"] < 10_500 for r in tenths)
    assert all(abs(many.select(F.corr("x", c)).first()[0]) < 0.02 for c in ("y", "z"))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 4096])
def test_permutations_hit_each_number_once(spark, n):
    for seed in (1, 2):
        out = [r.p for r in spark.range(n).select(G.permuted(seed, "p", F.col("id"), F.lit(n).cast("bigint")).alias("p")).collect()]
        assert sorted(out) == list(range(n))
        assert n < 90 or sum(a == b for a, b in enumerate(out)) < n / 10


def test_skewed_ranks_are_scattered_over_the_keys(spark):
    n = F.lit(1000).cast("bigint")
    drawn = spark.range(50_000).select(G.skewed(1, "s", "id", n).alias("rank"))
    drawn = drawn.withColumn("key", G.permuted(1, "k", F.col("rank"), n))
    rows = drawn.groupBy("rank", "key").count().collect()
    assert len({r.rank for r in rows}) == len({r.key for r in rows}) == len(rows)
    assert 0.42 < sum(r["count"] for r in rows if r["rank"] < 100) / 50_000 < 0.50  # a tenth: the cube root of 0.1
    top = sorted(rows, key=lambda r: -r["count"])[:10]
    assert max(r.key for r in top) - min(r.key for r in top) > 300


@pytest.fixture(scope="module")
def shop(spark):
    # one order in three has the same moment: dates do not matter to a walk, ids do
    orders = spark.range(6000).select(F.col("id").alias("order_id"), F.lit("2024-02-28 12:00:00").cast("timestamp_ntz").alias("ordered_at"), F.lit("x").alias("extra"))
    orders = G.with_states(orders)
    sent = G.shipments(orders, F.lit(6000))
    return orders, G.order_items(orders, F.lit(50)), sent, G.delivery_events(sent)


def test_walks_follow_their_moves_and_weights(shop):
    orders = shop[0].collect()
    ends = Counter(r.status for r in orders)
    shares = {"pending": 3, "confirmed": 10, "packed": 10, "shipped": 10, "delivered": 55, "cancelled": 8, "refunded": 4}
    assert all(abs(ends[s] / 6000 - share / 100) < 0.02 for s, share in shares.items()) and set(ends) == set(shares)
    for row in orders:
        for a, b in zip(row.states, row.states[1:]):
            move = next(m for m in G.ORDER_MOVES[a.state] if m[0] == b.state)
            assert move[2] * G.HOUR <= b.after - a.after <= move[3] * G.HOUR
        assert row.states[0].state == "pending" and row.states[0].after == 0 and row.extra == "x"


def test_tables_hang_together(spark, shop):
    assert all(r.violations == 0 and r.row_count > 0 for r in G.violations(*shop).collect())
    broken = G.violations(shop[0].filter("order_id % 2 = 0"), *shop[1:]).collect()
    assert all(r.violations > 0 for r in broken[:2])
    orders, items, sent, events = shop
    assert sent.count() == orders.filter("status IN ('shipped', 'delivered', 'refunded')").count()
    late = events.alias("a").join(events.alias("b"), F.expr("a.order_id = b.order_id AND a.event_no + 1 = b.event_no AND a.happened_at > b.happened_at"))
    assert late.count() == 0
    last = events.groupBy("order_id").agg(F.max_by("event_type", "event_no").alias("t")).join(sent, "order_id")
    assert last.filter("t <> shipment_status OR (delivered_at IS NOT NULL) <> (t = 'delivered')").count() == 0
    assert items.groupBy("product_id").agg(F.count_distinct("unit_cents").alias("n")).filter("n > 1").count() == 0
    assert items.filter("product_id < 0 OR product_id >= 50 OR quantity NOT BETWEEN 1 AND 4").count() == 0


def test_parts_of_a_table_are_made_alike(spark, shop):
    some = shop[0].filter("order_id BETWEEN 100 AND 199").select("order_id", "ordered_at")
    again = G.order_items(G.with_states(some.repartition(7)), F.lit(50))
    assert again.exceptAll(shop[1]).count() == 0 and again.count() == shop[1].filter("order_id BETWEEN 100 AND 199").count()
    none = G.with_states(some.limit(0))
    assert G.shipments(none, F.lit(1)).count() == 0 and G.order_items(none, F.lit(1)).count() == 0
