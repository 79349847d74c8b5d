"""Small inputs with the answers stated for them."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from lakemason.operators import aggregates as A, hierarchy as H, joins as J, merge as M, quality as Q, scd as D, setops as S, warehouse as W
from lakemason.operators.ordered import with_totals
from lakemason.operators.layout import write_sorted
from lakemason.functions.columns import json_contains, json_field, ratio

T = dt.datetime(2026, 9, 1, 8, 0)
OLD = dt.datetime(2026, 8, 31, 8, 0)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


# ---------------------------------------------------------------- sets and joins
def test_not_in_trap(spark):
    promos = spark.createDataFrame([("SAVE10",), ("SUMMER20",), (None,)], "code string")
    applied = spark.createDataFrame([("SAVE10",), ("FALL50",), (None,)], "code string")
    assert rows(J.not_in(applied, promos, "code", "code")) == []
    assert rows(J.not_exists_in(applied.filter("code IS NOT NULL"), promos, ["code"])) == [("FALL50",)]
    known = promos.filter("code IS NOT NULL")
    assert rows(J.not_in(applied, known, "code", "code")) == [("FALL50",)]  # a NULL on the left is dropped
    assert J.not_in(applied, promos.limit(0), "code", "code").count() == 3  # an empty right side keeps all
    assert J.check_not_in(promos, "code").first()["rewrite_is_safe"] is False


def test_reconcile(spark):
    schema = "customer_code string, status string"
    stage = spark.createDataFrame([("CUST-001", "active"), ("CUST-002", "inactive"), ("CUST-003", "active")], schema)
    prod = spark.createDataFrame([("CUST-001", "active"), ("CUST-002", "active"), ("CUST-004", "active")], schema)
    assert rows(S.reconcile(stage, prod)) == [
        ("ONLY_IN_PROD", "CUST-002", "active"), ("ONLY_IN_PROD", "CUST-004", "active"),
        ("ONLY_IN_STAGING", "CUST-002", "inactive"), ("ONLY_IN_STAGING", "CUST-003", "active")]
    assert S.reconcile(stage, stage).count() == 0
    doubled = stage.unionAll(stage.limit(1))
    assert S.reconcile(doubled, stage).count() == 0 and S.reconcile_counts(doubled, stage).first()["surplus"] == 1


def test_set_operations_treat_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    b = spark.createDataFrame([(1, None), (3, "y")], "i int, s string")
    assert rows(S.intersect_distinct(a, b)) == [(1, None)]
    assert rows(S.except_distinct(a, b)) == [(2, "x")]
    assert S.union_distinct(a, b).count() == 3


@pytest.mark.parametrize("options", [{}, {"max_group_rows": 0, "slices": 3}])
def test_as_of(spark, options):
    versions = spark.createDataFrame([("a", 10, 20, "one"), ("a", 20, 30, "two"), ("b", 5, 6, "x")], "k string, f int, u int, v string")
    facts = spark.createDataFrame([(1, "a", 9), (2, "a", 10), (3, "a", 19), (4, "a", 20), (5, "a", 30), (6, "c", 1), (7, "b", 5)], "id int, k string, t int")
    hit = J.as_of(facts, versions, ["k"], "t", "f", "u", **options)
    assert rows(hit, "id", "v") == [(1, None), (2, "one"), (3, "one"), (4, "two"), (5, None), (6, None), (7, "x")]
    assert J.as_of(facts, versions, ["k"], "t", "f", "u", inner=True, **options).count() == 4


def test_fanout(spark):
    left = spark.range(3).withColumnRenamed("id", "k")
    right = spark.createDataFrame([(0,), (0,), (1,)], "k long")
    report = J.fanout_report(left, left.join(right, "k"), ["k"]).first()
    assert (report["rows_after"], report["multiplied_keys"], report["fans_out"]) == (3, 1, True)


# ---------------------------------------------------------------- aggregates
def test_count_kinds_and_share(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, None), (3, "A"), (3, "A")], "customer int, code string")
    got = df.agg(F.count(F.lit(1)), F.count("code"), F.count_distinct("customer"), F.count_distinct("code")).first()
    assert tuple(got) == (5, 4, 3, 2)
    orders = spark.createDataFrame([(1, 100), (1, 300), (2, 200), (2, 50)], "c int, amount int")
    share = with_totals(orders, ["c"], {"t": F.sum("amount")}).withColumn("p", ratio(F.col("amount"), F.col("t"), 0, 100))
    assert [int(r[0]) for r in share.orderBy("c", "amount").select("p").collect()] == [25, 75, 20, 80]


def test_case_gives_zero_and_filter_gives_null(spark):
    df = spark.createDataFrame([("x", 1)], "s string, v int")
    got = df.agg(A.sum_when(F.col("s") == "y", F.col("v")).alias("a"), A.sum_when(F.col("s") == "y", F.col("v"), None).alias("b")).first()
    assert got["a"] == 0 and got["b"] is None


def test_last_value_default_frame_is_a_trap(spark):
    df = spark.createDataFrame([("b", 1), ("b", 2)], "g string, v int")
    default = F.last("v").over(Window.partitionBy("g").orderBy("v"))
    assert rows(df.select("v", default.alias("l"))) == [(1, 1), (2, 2)]


# ---------------------------------------------------------------- merge and upserts
MERGE_SCHEMA = "sku string, product_name string, cost_price decimal(10,2), status string, is_deleted boolean, last_synced_at timestamp_ntz"


def merged(spark, batch):
    from decimal import Decimal as X
    target = spark.createDataFrame([("SKU-101", "Wireless Mouse", X("25.00"), "active", False, OLD), ("SKU-102", "Keyboard", X("80.00"), "active", False, OLD),
                                    ("SKU-103", "HDMI Cable", X("10.00"), "active", False, OLD)], MERGE_SCHEMA)
    source = spark.createDataFrame(batch, "sku string, product_name string, cost_price string, status string, action string").withColumn(
        "cost_price", F.col("cost_price").cast("decimal(10,2)"))
    s, t, now = (lambda c: F.col(f"source.{c}")), (lambda c: F.col(f"target.{c}")), F.lit(T).cast("timestamp_ntz")
    shared = {c: s(c) for c in ("product_name", "cost_price", "status")} | {"last_synced_at": now}
    return M.merge(target, source, ["sku"], [
        M.Matched(None, s("action") == "DELETE"),
        M.Matched(shared, (t("cost_price") != s("cost_price")) | (t("product_name") != s("product_name"))),
    ], [M.NotMatched(shared | {"sku": s("sku"), "is_deleted": F.lit(False)})])


def test_merge(spark):
    got = merged(spark, [("SKU-101", "Wireless Mouse V2", "28.50", "active", "UPSERT"), ("SKU-103", "HDMI Cable", "10.00", "discontinued", "DELETE"),
                         ("SKU-104", "USB-C Hub", "45.00", "active", "UPSERT")])
    assert [(a, b, str(c), d, e) for a, b, c, d, e in rows(got, "sku", "product_name", "cost_price", "is_deleted", "last_synced_at")] == [
        ("SKU-101", "Wireless Mouse V2", "28.50", False, T), ("SKU-102", "Keyboard", "80.00", False, OLD), ("SKU-104", "USB-C Hub", "45.00", False, T)]


def test_merge_ignores_status_only_change_and_inserts_unknown_delete(spark):
    got = merged(spark, [("SKU-102", "Keyboard", "80.00", "discontinued", "UPSERT"), ("SKU-999", "Ghost", "1.00", "active", "DELETE")])
    assert rows(got.filter("sku = 'SKU-102'"), "status", "last_synced_at") == [("active", OLD)]
    assert got.filter("sku = 'SKU-999'").count() == 1


def test_merge_rejects_a_repeated_source_key(spark):
    with pytest.raises(PySparkException, match="duplicate key in source"):
        merged(spark, [("SKU-101", "a", "1.00", "x", "UPSERT"), ("SKU-101", "b", "2.00", "x", "UPSERT")]).collect()


STOCK = "warehouse string, sku string, stock int, reserved int, updated_at timestamp_ntz"


def test_upsert_chain(spark):
    key = ["warehouse", "sku"]
    stock = spark.createDataFrame([("W", "SKU-001", 100, 10, OLD), ("W", "SKU-002", 50, 5, OLD)], STOCK)
    ignored = M.upsert_ignore(stock, spark.createDataFrame([("W", "SKU-001", 100, 10, T), ("W", "SKU-003", 200, 0, T)], STOCK), key)
    assert rows(ignored, "sku", "stock", "updated_at") == [("SKU-001", 100, OLD), ("SKU-002", 50, OLD), ("SKU-003", 200, T)]
    batch = spark.createDataFrame([("W", "SKU-001", 85, 15, T), ("W", "SKU-002", 50, 5, T)], STOCK)
    changed = M.upsert_changed(ignored, batch, key, ["stock", "reserved", "updated_at"], ["stock", "reserved"])
    assert rows(changed, "sku", "stock", "reserved", "updated_at") == [("SKU-001", 85, 15, T), ("SKU-002", 50, 5, OLD), ("SKU-003", 200, 0, T)]
    bulk = spark.createDataFrame([("W", "SKU-001", 120, T), ("W", "SKU-004", 300, T)], "warehouse string, sku string, stock int, updated_at timestamp_ntz")
    replaced = M.upsert_replace(changed, bulk, key, ["stock", "updated_at"], defaults={"reserved": F.lit(0)})
    assert rows(replaced.filter("sku IN ('SKU-001', 'SKU-004')"), "sku", "stock", "reserved") == [("SKU-001", 120, 15), ("SKU-004", 300, 0)]
    again = M.upsert_replace(replaced, bulk, key, ["stock", "updated_at"], defaults={"reserved": F.lit(0)})
    assert rows(again) == rows(replaced)


def test_change_detection_with_null(spark):
    target = spark.createDataFrame([(1, None, OLD)], "k int, v string, at timestamp_ntz")
    source = spark.createDataFrame([(1, "x", T)], "k int, v string, at timestamp_ntz")
    plain = M.upsert_changed(target, source, ["k"], ["v", "at"], ["v"])
    safe = M.upsert_changed(target, source, ["k"], ["v", "at"], ["v"], null_safe=True)
    assert plain.first()["v"] is None and safe.first()["v"] == "x"


def test_batch_is_accumulated_or_deduplicated(spark):
    day = dt.date(2026, 9, 10)
    at = lambda m: dt.datetime(2026, 9, 10, 10, m)
    batch = spark.createDataFrame([(at(0), day, 1, 2, 50), (at(5), day, 1, 3, 75), (at(2), day, 2, 1, 120)], "ts timestamp_ntz, d date, p int, q long, v long")
    totals = M.batch_totals(batch, ["d", "p"], {"units": F.col("q"), "revenue": F.col("v")}, F.col("ts"), "last_at")
    assert rows(totals, "p", "units", "revenue", "last_at") == [(1, 5, 125, at(5)), (2, 1, 120, at(2))]
    once = M.upsert_add(totals.limit(0), totals, ["d", "p"], ["units", "revenue"], ["last_at"])
    assert rows(once, "p", "units", "revenue", "last_at") == rows(totals, "p", "units", "revenue", "last_at")
    twice = M.upsert_add(once, totals, ["d", "p"], ["units", "revenue"], ["last_at"])
    assert rows(twice, "p", "units", "revenue") == [(1, 10, 250), (2, 2, 240)]
    assert rows(M.latest_per_key(batch, ["d", "p"], ["ts"]), "p", "q", "v") == [(1, 3, 75), (2, 1, 120)]


def test_delete_cascade(spark):
    parents = spark.createDataFrame([(1, "x"), (2, "y")], "id int, s string")
    children = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "cid int, pid int")
    p, c = M.delete_cascade(parents, children, "id", "pid", F.col("s") == "x")
    assert rows(p, "id") == [(2,)] and rows(c, "cid") == [(11,), (12,)]


# ---------------------------------------------------------------- slowly changing dimensions
def test_scd0_and_scd1_and_scd3(spark):
    dim = spark.createDataFrame([(1, "organic_search")], "id int, channel string")
    assert rows(D.scd0(dim, spark.createDataFrame([(1, "paid_ads")], dim.schema), "id")) == [(1, "organic_search")]
    person = spark.createDataFrame([(1, "Alice", "Smith", "alice@oldmail.com")], "id int, first string, last string, email string")
    news = spark.createDataFrame([(1, "ALICE", "Smith-Johnson", "alice@newmail.com")], person.schema)
    assert rows(D.scd1(person, news, "id", ["last", "email"])) == [(1, "Alice", "Smith-Johnson", "alice@newmail.com")]
    tiers = spark.createDataFrame([(1, "Bronze", None), (2, "Gold", "Silver")], "id int, tier string, previous string")
    batch = spark.createDataFrame([(1, "Gold"), (2, "Gold"), (3, "New")], "id int, tier string")
    assert rows(D.scd3(tiers, batch, "id", "tier", "previous")) == [(1, "Gold", "Bronze"), (2, "Gold", "Silver"), (3, "New", None)]


SCD2 = "id int, code string, tier string, country string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
END = dt.datetime(9999, 12, 31, 23, 59, 59)
JAN, JUN = dt.datetime(2026, 1, 1), dt.datetime(2026, 6, 1, 12)


def change(spark, *batch):
    return spark.createDataFrame(list(batch), "id int, code string, tier string, country string, at timestamp_ntz, seq int")


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame([(1, "CUST-001", "Bronze", "UK", JAN, END, True)], SCD2)


@pytest.mark.parametrize("limit", [None, 0])
def test_scd2(spark, bronze, limit):
    step = lambda dim, *batch: D.scd2(dim, change(spark, *batch), "id", ["tier", "country"], "at", ["seq"], max_group_rows=limit)
    dim = step(bronze, (1, "CUST-001", "Gold", "USA", JUN, 1))
    assert rows(dim, "tier", "country", "valid_from", "valid_to", "is_current") == [("Bronze", "UK", JAN, JUN, False), ("Gold", "USA", JUN, END, True)]
    middle = F.lit(dt.datetime(2026, 3, 15, 15)).cast("timestamp_ntz")
    assert rows(D.as_of_time(dim, middle), "tier", "country") == [("Bronze", "UK")]
    assert rows(D.current(dim), "tier") == [("Gold",)]
    assert rows(step(dim, (1, "CUST-001", "Gold", "USA", JUN, 1))) == rows(dim)  # replay
    assert rows(step(dim, (1, "CUST-001", "Gold", "USA", dt.datetime(2026, 7, 1), 1))) == rows(dim)  # no-op


def test_scd2_many_changes_new_keys_and_late_arrival(spark, bronze):
    m = lambda n: dt.datetime(2026, n, 1)
    batch = change(spark, (1, "c", "Silver", "UK", m(3), 1), (1, "c", "Silver", "UK", m(4), 2), (1, "c", "Gold", "UK", m(5), 3),
                   (2, "d", "Bronze", "FR", m(2), 4), (1, "c", "Iron", "UK", m(6), 5), (1, "c", "Tin", "UK", m(6), 6))
    dim = D.scd2(bronze, batch, "id", ["tier", "country"], "at", ["seq"])
    assert rows(dim, "id", "tier", "valid_from", "valid_to") == [
        (1, "Bronze", JAN, m(3)), (1, "Gold", m(5), m(6)), (1, "Silver", m(3), m(5)), (1, "Tin", m(6), END), (2, "Bronze", m(2), END)]
    late = D.scd2(dim, change(spark, (1, "c", "Late", "UK", dt.datetime(2026, 4, 15), 9)), "id", ["tier", "country"], "at", ["seq"])
    assert rows(late.filter("tier IN ('Silver', 'Late')"), "tier", "valid_from", "valid_to") == [
        ("Late", dt.datetime(2026, 4, 15), m(5)), ("Silver", m(3), dt.datetime(2026, 4, 15))]
    assert late.filter("is_current").groupBy("id").count().filter("count <> 1").count() == 0
    assert Q.overlaps(late, ["id"], "valid_from", "valid_to", []).count() == 0
    known = D.scd2(bronze, batch, "id", ["tier"], "at", ["seq"], insert_new=False)
    assert known.filter("id = 2").count() == 0


def test_scd2_null_change(spark, bronze):
    batch = change(spark, (1, "CUST-001", "Bronze", None, JUN, 1))
    assert D.scd2(bronze, batch, "id", ["tier", "country"], "at", ["seq"]).count() == 1
    assert D.scd2(bronze, batch, "id", ["tier", "country"], "at", ["seq"], null_safe=True).count() == 2


# ---------------------------------------------------------------- hierarchies
def test_cycle_is_survived_and_marked(spark):
    edges = spark.createDataFrame([(1, None, "root"), (2, 1, "a"), (3, 2, "b"), (2, 3, "back")], "id int, parent int, name string")
    walked = H.safe_tree(edges, "id", "parent", "name")
    assert all(len(set(r["visited_ids"])) == len(r["visited_ids"]) for r in walked.collect()) and walked.count() == 3
    assert rows(H.marked_tree(edges, "id", "parent").filter("is_cycle"), "id", "path") == [(2, [1, 2, 3, 2])]
    assert H.closure(edges.dropDuplicates(["id"]), "id", "parent").count() > 0
    looped = spark.createDataFrame([(1, 2), (2, 1)], "id int, parent int")
    assert rows(H.closure(looped, "id", "parent")) == [(1, 1, 0), (1, 2, 1), (2, 1, 1), (2, 2, 0)]


def test_deep_chain_has_no_level_cap(spark):
    chain = spark.range(1, 31).select(F.col("id"), F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), F.col("id").cast("string").alias("name"))
    assert H.tree(chain, "id", "parent", "name").agg(F.max("level_depth")).first()[0] == 30


# ---------------------------------------------------------------- warehouse
def test_dim_date(spark):
    d = W.dim_date(spark, "2024-01-01", "2030-12-31")
    assert d.count() == 2558
    pick = {r["date_key"]: r for r in d.filter(F.col("date_key").isin(20250101, 20260704, 20261225, -1)).collect()}
    assert (pick[20250101]["fiscal_quarter"], pick[20250101]["holiday_name"]) == ("FY24-Q3", "New Year's Day")
    assert (pick[20260704]["is_weekend"], pick[20260704]["fiscal_quarter"], pick[20260704]["fiscal_year"]) == (True, "FY26-Q1", 2027)
    assert (pick[20261225]["fiscal_quarter"], pick[20261225]["holiday_name"]) == ("FY26-Q2", "Christmas Day")
    assert pick[-1]["day_name"] == "Unknown" and pick[-1]["quarter_name"] == "Unknown"
    ending = W.dim_date(spark, "2026-07-01", "2026-07-01", label_year="end").filter("date_key > 0").first()
    assert ending["fiscal_quarter"] == "FY27-Q1"


def test_keys_are_stable(spark):
    first = W.assign_keys(spark.createDataFrame([("b",), ("a",)], "n string"), ["n"], "sk", slices=3)
    assert rows(first) == [("a", 1), ("b", 2)]
    news = spark.createDataFrame([("c",), ("a",), ("0",), ("c",)], "n string")
    second = W.assign_keys(news, ["n"], "sk", first, slices=2)
    assert rows(second) == [("0", 3), ("a", 1), ("b", 2), ("c", 4)]
    assert rows(W.assign_keys(news, ["n"], "sk", second, slices=2)) == rows(second)


def test_allocation_residual(spark):
    from decimal import Decimal as X
    lines = spark.createDataFrame([(1, i, X("10.00"), X("10.00")) for i in range(3)] + [(2, 0, X("0.00"), X("7.00"))], "o int, n int, w decimal(12,2), tax decimal(14,2)")
    plain = W.allocate(lines, ["o"], "w", {"tax": "part"})
    assert [str(r["part"]) for r in plain.orderBy("o", "n").collect()] == ["3.33", "3.33", "3.33", "0.00"]
    exact = W.allocate(lines, ["o"], "w", {"tax": "part"}, residual="largest", tie_break=["n"])
    assert [str(r["part"]) for r in exact.orderBy("o", "n").collect()] == ["3.34", "3.33", "3.33", "0.00"]


def test_functional_dependency(spark):
    models = {0: ("911", "Cayenne"), 1: ("Camry", "Corolla"), 2: ("M3", "X5"), 3: ("Civic", "Accord"), 4: ("Focus", "F150")}
    makes = ["Porsche", "Toyota", "BMW", "Honda", "Ford"]
    table = spark.createDataFrame([(m, p, makes[m], models[m][p]) for m in range(5) for p in range(2)], "m int, p int, make string, model string")
    cars = spark.range(100_000).select((F.col("id") % 5).cast("int").alias("m"), (F.col("id") % 2).cast("int").alias("p")).join(table, ["m", "p"])
    report = Q.dependency(cars, "model", "make").first()
    assert (report["n_distinct_first"], report["n_distinct_second"], report["n_distinct_pair"]) == (10, 5, 10)
    assert float(report["first_determines_second"]) == 1.0 and float(report["second_determines_first"]) == 0.0
    pair = Q.selectivity(cars, "make", "model").filter("make = 'Porsche' AND model = '911'").first()
    assert pair["actual_rows"] == 10_000 and float(pair["independent_rows"]) == 2_000


def test_rules_let_null_pass(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    assert rows(Q.rule_violations(df, {"positive": F.col("v") > 0})) == [("positive", 1, "FAIL")]


@pytest.mark.parametrize("limit", [None, 0])
def test_overlaps(spark, limit):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 3), ("a", 5, 6), ("a", 10, 12), ("b", 1, 2)], "k string, f int, t int")
    assert rows(Q.overlaps(df, ["k"], "f", "t", [], max_group_rows=limit), "f") == [(2,), (5,)]


def test_sketched_profiles_are_close(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("v"))
    exact, near = Q.profile(df, ["v"]).first(), Q.profile_approx(df, ["v"]).first()
    assert abs(near["n_distinct"] - exact["n_distinct"]) / exact["n_distinct"] < 0.1
    bounds = {r["bound"]: r["value"] for r in Q.histogram(df, "v", 4, slices=3).collect()}
    assert bounds == {0: 0, 1: 1249, 2: 2499, 3: 3749, 4: 4999}
    assert all(abs(r["value"] - bounds[r["bound"]]) <= 5 for r in Q.histogram_approx(df, "v", 4).collect())


def test_repeated_source_key_fails_whatever_is_read(spark):
    from lakemason.operators.merge import unique_source

    source = unique_source(spark.createDataFrame([(1, 2), (1, 3)], "k int, v int"), ["k"])
    for read in (source.collect, source.count, source.select("k").collect):
        with pytest.raises(Exception, match="duplicate key"):
            read()


def test_long_chain_comes_back_whole(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None, str(i)) for i in range(30)], "id int, parent_id int, name string")
    assert H.safe_tree(chain, "id", "parent_id", "name").count() == 30


def test_draws_do_not_repeat(spark):
    from lakemason.sources.synthetic import uniform

    drawn = spark.range(200_000).select(uniform(1, "x").alias("x"))
    assert drawn.distinct().count() == 200_000 and drawn.filter("x < 0 OR x >= 1").count() == 0


def test_nulls_in_as_of_roles_keys_and_headers(spark):
    from lakemason.operators.joins import as_of, play_role
    from lakemason.operators.warehouse import allocate, assign_keys

    rows = spark.createDataFrame([("a", 5), ("a", None), (None, 5)], "k string, t int")
    versions = spark.createDataFrame([("a", 1, "v"), (None, 1, "w")], "k string, since int, name string")
    assert {(r.k, r.t): r.name for r in as_of(rows, versions, ["k"], "t", "since").collect()} == {("a", 5): "v", ("a", None): None, (None, 5): None}
    dim = spark.createDataFrame([(-1, "unknown"), (1, "one")], "key int, name string")
    roles = play_role(spark.createDataFrame([(1,), (None,), (9,)], "k int"), dim, "key", "k", {"name": "role"})
    assert sorted(r.role for r in roles.collect()) == ["one", "unknown", "unknown"]
    names = spark.createDataFrame([("a",), (None,)], "n string")
    keyed = assign_keys(names, ["n"], "id")
    assert sorted(map(tuple, assign_keys(names, ["n"], "id", keyed).collect()), key=str) == sorted(map(tuple, keyed.collect()), key=str)
    lines = spark.createDataFrame([(None, 1.0, 10.0), (1, 1.0, 10.0)], "h int, w double, amount double")
    assert allocate(lines, ["h"], "w", {"amount": "part"}).count() == 2


def test_moved_rows_are_refused(spark, tmp_path):
    from lakemason.sources.snapshots import SnapshotTable

    table = SnapshotTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "d string, k int").schema, "d")
    make = lambda *rows: spark.createDataFrame(list(rows), "d string, k int")
    table.publish(make(("d1", 1), ("d2", 3)))
    with pytest.raises(ValueError, match="moved"):
        table.apply_once("b", make(("d1", 1)), lambda now, batch: make(("d2", 9)))
    assert sorted(map(tuple, table.read().collect())) == [("d1", 1), ("d2", 3)]


@pytest.mark.parametrize("kind", ["int", "decimal(18,2)", "double"])
def test_split_windows_have_the_types_of_plain_ones(spark, kind):
    from lakemason.operators.ordered import running, value_ranks

    df = spark.range(50).selectExpr("id % 2 AS k", "id", f"CAST(id AS {kind}) AS v")
    sums = [running(df, ["k"], ["id"], {"s": ("sum", F.col("v"))}, max_group_rows=n) for n in (1, 100)]
    ranks = [value_ranks(df, ["k"], ["v"], {"r": "rank", "d": "dense_rank", "p": "percent_rank"}, max_group_rows=n) for n in (1, 100)]
    for split, plain in (sums, ranks):
        assert [(f.name, f.dataType) for f in split.schema] == [(f.name, f.dataType) for f in plain.schema]
        assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))


# ---------------------------------------------------------------- JSON, key checks, layouts
def test_json_fields(spark):
    told = spark.createDataFrame(
        [(1, '{"k": 5}'), (2, '{"k": "5", "on": true}'), (3, "{broken"), (4, None), (5, ""), (6, "[1]"), (7, '{"k": null}')], "id int, p string")
    assert rows(told.select("id", json_field("p", "k", "int").alias("k"))) == [(1, 5), (2, 5), (3, None), (4, None), (5, None), (6, None), (7, None)]
    assert rows(told.filter(json_contains("p", {"k": 5})), "id") == [(1,)]
    assert rows(told.filter(json_contains("p", {"k": "5", "on": True})), "id") == [(2,)]
    assert told.filter(json_contains("p", {})).count() == 7


def test_orphans_of_one_table(spark):
    child = spark.createDataFrame([(1, 1), (1, 9), (7, None), (7, 2)], "a int, b int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    found = Q.orphans(child, {"t.a": ("a", parent, "id"), "t.b": ("b", parent, "id"), "t.c": ("b", parent.filter("id = 9"), "id")})
    assert rows(found) == [("t.a", 2, "FAIL"), ("t.b", 1, "FAIL"), ("t.c", 3, "FAIL")]
    assert rows(Q.orphans(child.limit(0), {"t.a": ("a", parent, "id")})) == [("t.a", 0, "PASS")]


def test_frequent_value_spreads_over_files(spark, tmp_path):
    skewed = spark.range(20_000).select(F.lit(1).alias("k"), "id")
    write_sorted(skewed, str(tmp_path / "sorted"), ["k"], files=8)
    back = spark.read.parquet(str(tmp_path / "sorted"))
    assert back.select(F.input_file_name()).distinct().count() >= 6 and back.exceptAll(skewed).count() == 0 and back.count() == 20_000
