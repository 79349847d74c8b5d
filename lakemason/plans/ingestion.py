"""Merge, upserts, slowly changing dimensions and their streaming forms.

Batches are derived from the tables by modulo, so that the SQL twin can derive the same ones.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from lakemason.functions.columns import literal, money, utc_instant
from lakemason.operators import merge as M, scd as D
from lakemason.plans.joining import _VERSIONS, versions
from lakemason.plans.registry import Tables, m, query
from lakemason.sources.sinks import scratch
from lakemason.sources.snapshots import SnapshotTable
from lakemason.sources.tables import schema_of
from lakemason.streaming import ingest as I, stateful as V

c = F.col
LOADED = dt.datetime(2024, 1, 1)
_TARGET = "SELECT p_partkey, p_name, p_type, CAST(p_retailprice AS DECIMAL(12,2)) AS price, TIMESTAMP '2023-01-01' AS synced_at FROM part"
_SHIFT = 100_000_000
_PRODUCT = "int: p_partkey; text: p_name p_type; float: price; time: synced_at"


def products(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name", "p_type", c("p_retailprice").cast("decimal(12,2)").alias("price"),
                         literal(dt.datetime(2023, 1, 1)).alias("synced_at"))


def product_batch(t: Tables) -> DataFrame:
    """Every third part: some unchanged, some repriced, some renamed, some to delete, some new."""
    k = c("p_partkey")
    return t.part.filter(k % 3 == 0).select(
        F.when(k % 9 == 0, k + _SHIFT).otherwise(k).alias("p_partkey"),
        F.when(k % 15 == 0, F.concat("p_name", F.lit(" v2"))).otherwise(c("p_name")).alias("p_name"),
        F.when(k % 4 == 0, "STATUS ONLY").otherwise(c("p_type")).alias("p_type"),
        (c("p_retailprice").cast("decimal(12,2)") + F.when(k % 6 == 0, 5).otherwise(0)).cast("decimal(12,2)").alias("price"),
        literal(LOADED).alias("synced_at"),
        F.when(k % 21 == 0, "DELETE").otherwise("UPSERT").alias("action"))


_BATCH = f"""SELECT CASE WHEN p_partkey % 9 = 0 THEN p_partkey + {_SHIFT} ELSE p_partkey END AS p_partkey,
    CASE WHEN p_partkey % 15 = 0 THEN p_name || ' v2' ELSE p_name END AS p_name,
    CASE WHEN p_partkey % 4 = 0 THEN 'STATUS ONLY' ELSE p_type END AS p_type,
    CAST(p_retailprice AS DECIMAL(12,2)) + CASE WHEN p_partkey % 6 = 0 THEN 5 ELSE 0 END AS price, TIMESTAMP '2024-01-01' AS synced_at,
    CASE WHEN p_partkey % 21 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS action FROM part WHERE p_partkey % 3 = 0"""
_WITH = f"WITH tgt AS ({_TARGET}), src AS ({_BATCH})"
_COLS = ["p_name", "p_type", "price", "synced_at"]


def _pick(changed: str, columns: list[str] = _COLS) -> str:
    return ", ".join(f"CASE WHEN {changed} THEN s.{x} ELSE t.{x} END AS {x}" if x in columns else f"t.{x}" for x in _COLS)


_NEW = "SELECT p_partkey, p_name, p_type, price, synced_at FROM src WHERE p_partkey NOT IN (SELECT p_partkey FROM tgt)"


@query("dw_merge", _PRODUCT, f"""{_WITH}
    SELECT t.p_partkey, {_pick("s.price <> t.price OR s.p_name <> t.p_name")} FROM tgt t LEFT JOIN src s ON s.p_partkey = t.p_partkey
    WHERE s.action IS DISTINCT FROM 'DELETE' UNION ALL {_NEW}""")
def _(t: Tables):
    """Delete, update on a new price or name only, insert the rest - deletions of unknown keys included."""
    s, g = (lambda x: c(f"source.{x}")), (lambda x: c(f"target.{x}"))
    return M.merge(
        products(t), product_batch(t), ["p_partkey"],
        matched=[M.Matched(None, s("action") == "DELETE"),
                 M.Matched({x: s(x) for x in _COLS}, (g("price") != s("price")) | (g("p_name") != s("p_name")))],
        not_matched=[M.NotMatched({x: s(x) for x in ["p_partkey", *_COLS]})])


@query("dw_upsert_ignore", _PRODUCT, f"{_WITH} SELECT * FROM tgt UNION ALL {_NEW}")
def _(t: Tables):
    """The batch is delivered twice; the second delivery of a new key is ignored too."""
    twice = product_batch(t).withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "price", F.when(c("delivery") == 2, c("price") + 1).otherwise(c("price")))
    return M.upsert_ignore(products(t), twice, ["p_partkey"], ["delivery"])


@query("dw_upsert_replace", _PRODUCT, f"""{_WITH} SELECT t.p_partkey, {_pick("s.p_partkey IS NOT NULL", ["price", "synced_at"])} FROM tgt t
    LEFT JOIN src s ON s.p_partkey = t.p_partkey UNION ALL {_NEW}""")
def _(t: Tables):
    return M.upsert_replace(products(t), product_batch(t), ["p_partkey"], ["price", "synced_at"])


@query("dw_upsert_changed", _PRODUCT, f"""{_WITH} SELECT t.p_partkey, {_pick("s.price <> t.price OR s.p_type <> t.p_type")} FROM tgt t
    LEFT JOIN src s ON s.p_partkey = t.p_partkey UNION ALL {_NEW}""")
def _(t: Tables):
    """Rows whose tracked columns did not change keep their old time."""
    return M.upsert_changed(products(t), product_batch(t), ["p_partkey"], _COLS, ["price", "p_type"])


_SUMMARY = "text: summary_date; int: l_partkey; float: units revenue; time: last_at"
_SUMMARY_SQL = f"""SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS summary_date, l_partkey, SUM({m('l_quantity')}) AS units,
    SUM({m('l_extendedprice')}) AS revenue, MAX(l_shipdate) AS last_at FROM lineitem {{where}} GROUP BY 1, 2"""


def sales(t: Tables) -> DataFrame:
    return t.lineitem.withColumn("summary_date", F.trunc("l_shipdate", "month"))


def summarized(lines: DataFrame) -> DataFrame:
    """Monthly totals per part, with the storage types of the summary table."""
    totals = M.batch_totals(lines, ["summary_date", "l_partkey"], {"units": money("l_quantity"), "revenue": money("l_extendedprice")},
                            c("l_shipdate"), "last_at")
    return totals.withColumns({x: c(x).cast("decimal(18,2)") for x in ("units", "revenue")})


@query("dw_batch_agg", _SUMMARY, _SUMMARY_SQL.format(where=""))
def _(t: Tables):
    return summarized(sales(t))


@query("dw_upsert_add", _SUMMARY, _SUMMARY_SQL.format(where=""))
def _(t: Tables):
    """Two batches accumulated; the second one is replayed and its ledger entry stops it."""
    schema = summarized(sales(t)).schema
    key, measures = ["summary_date", "l_partkey"], ["units", "revenue"]
    table = SnapshotTable(t.spark, scratch(t.spark, "summary"), schema, "year(summary_date)", key)
    for part, batch_id in ((0, "a"), (1, "b"), (1, "b")):
        batch = summarized(sales(t).filter(c("l_orderkey") % 2 == part))
        table.apply_once(batch_id, batch, lambda now, new: M.upsert_add(now, new, key, measures, latest=["last_at"], check_source=False))
    return table.read()


@query("dw_dedupe_latest", "int: user_id event_id; text: event_type; time: ts", """
    SELECT DISTINCT ON (user_id, event_type) user_id, event_id, event_type, ts FROM events ORDER BY user_id, event_type, ts DESC, event_id DESC""")
def _(t: Tables):
    """At-least-once delivery: every event twice, newest per user and type kept."""
    return M.latest_per_key(t.events.unionAll(t.events), ["user_id", "event_type"], ["ts", "event_id"])


# ---------------------------------------------------------------- slowly changing dimensions
def _segments(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Stored customers (two thirds) and a batch that changes some of them and brings the rest."""
    k = c("c_custkey")
    stored = t.customer.filter(k % 3 != 0).select("c_custkey", c("c_mktsegment").alias("segment"))
    batch = t.customer.filter(k % 2 == 0).select("c_custkey", F.when(k % 4 == 0, "VIP").otherwise(c("c_mktsegment")).alias("segment"))
    return stored, batch


_SEGMENT = "WITH st AS (SELECT c_custkey, c_mktsegment AS segment FROM customer WHERE c_custkey % 3 <> 0), b AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'VIP' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 2 = 0)"


@query("dw_scd0", "int: c_custkey; text: segment",
       f"{_SEGMENT} SELECT * FROM st UNION ALL SELECT * FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM st)")
def _(t: Tables):
    return D.scd0(*_segments(t), "c_custkey")


@query("dw_scd1", "int: c_custkey; text: segment",
       f"{_SEGMENT} SELECT * FROM b UNION ALL SELECT * FROM st WHERE c_custkey NOT IN (SELECT c_custkey FROM b)")
def _(t: Tables):
    return D.scd1(*_segments(t), "c_custkey", ["segment"])


@query("dw_scd3", "int: c_custkey; text: segment previous_segment", f"""{_SEGMENT}
    SELECT COALESCE(st.c_custkey, b.c_custkey) AS c_custkey, COALESCE(b.segment, st.segment) AS segment,
      CASE WHEN b.segment <> st.segment THEN st.segment END AS previous_segment FROM st FULL JOIN b ON b.c_custkey = st.c_custkey""")
def _(t: Tables):
    stored, batch = _segments(t)
    stored = stored.withColumn("previous_segment", F.lit(None).cast("string"))
    return D.scd3(stored, batch, "c_custkey", "segment", "previous_segment")


_VERSION = "int: o_custkey; text: tier; time: valid_from valid_to; bool: is_current"
_ALL_VERSIONS = f"{_VERSIONS} SELECT o_custkey, tier, valid_from, valid_to, year(valid_to) = 9999 AS is_current FROM v"
VERSION_SCHEMA = "o_custkey bigint, tier string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
_CUT = dt.datetime(1998, 1, 1)


@query("dw_scd2", _VERSION, _ALL_VERSIONS)
def _(t: Tables):
    """History until 1998 is stored; later changes arrive as one batch, several per customer, and
    with them a replay of the year before. The result is the history of the whole log."""
    log = t.orders.select(
        "o_custkey", c("o_orderpriority").alias("tier"), c("o_orderdate").alias("at"), "o_orderkey")
    stored = D.history(log.filter(c("at") < literal(_CUT)), "o_custkey", ["tier"], "at", ["o_orderkey"])
    batch = log.filter(c("at") >= literal(dt.datetime(1997, 1, 1)))
    return D.scd2(stored, batch, "o_custkey", ["tier"], "at", ["o_orderkey"], null_safe=True)


@query("dw_scd2_current", "int: o_custkey; text: tier", f"SELECT o_custkey, tier FROM ({_ALL_VERSIONS}) WHERE is_current")
def _(t: Tables):
    return D.current(versions(t))


@query("dw_scd2_asof", "int: o_custkey; text: tier",
       f"{_VERSIONS} SELECT o_custkey, tier FROM v WHERE valid_from <= TIMESTAMP '1997-06-15' AND TIMESTAMP '1997-06-15' < valid_to")
def _(t: Tables):
    return D.as_of_time(versions(t), literal(dt.datetime(1997, 6, 15)))


# ---------------------------------------------------------------- streams
def _landing(df: DataFrame, column: str, deliveries: int = 3) -> tuple[str, int]:
    """The table delivered to a landing folder in time order; also the files one delivery has."""
    spark, path = df.sparkSession, scratch(df.sparkSession, "landing")
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    edges = [span["lo"] + (span["hi"] - span["lo"]) * i / deliveries for i in range(1, deliveries)]
    delivery = sum([F.when(c(column) >= literal(e), 1).otherwise(0) for e in edges], F.lit(0))
    for i in range(deliveries):
        df.filter(delivery == i).write.mode("append").parquet(path)
    return path, max(1, len(spark.read.schema(df.schema).parquet(path).inputFiles()) // deliveries)


def _stream_session(t: Tables):
    """A session of its own for the stream: state is kept per shuffle partition for the life of the
    query, so there are at most as many as the cluster has cores."""
    session = t.spark.newSession()
    cores = t.spark.sparkContext.defaultParallelism
    partitions = min(cores, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def _run(t: Tables, stream: DataFrame, schema, change, key: list[str], partition_by: str, **options) -> DataFrame:
    table = SnapshotTable(t.spark, scratch(t.spark, "stream-table"), schema, partition_by, key)
    I.run_batches(stream, table, change, scratch(t.spark, "stream-progress"), **options).awaitTermination()
    return table.read()


@query("str_upsert", _SUMMARY, _SUMMARY_SQL.format(where=""))
def _(t: Tables):
    """Lines arrive file by file; monthly totals per part are accumulated batch by batch."""
    path, files = _landing(t.lineitem, "l_shipdate")
    stream = I.file_stream(_stream_session(t), path, schema_of("lineitem"), files_per_batch=files).withColumn("summary_date", F.trunc("l_shipdate", "month"))
    change = I.accumulate(["summary_date", "l_partkey"], {"units": money("l_quantity"), "revenue": money("l_extendedprice")}, c("l_shipdate"), "last_at")
    return _run(t, stream, summarized(sales(t)).schema, change, ["summary_date", "l_partkey"], "summary_date")


@query("str_dedupe", "int: event_id user_id; text: event_type", "SELECT event_id, user_id, event_type FROM events")
def _(t: Tables):
    """Every event is delivered twice, a few minutes apart, and kept once."""
    twice = t.events.withColumn("ts", F.explode(F.array(c("ts"), c("ts") + F.expr("INTERVAL 5 MINUTES"))))
    path, files = _landing(twice, "ts")
    stream = I.file_stream(_stream_session(t), path, schema_of("events"), files_per_batch=files).withColumn("ts", utc_instant("ts"))
    unique = I.without_redelivery(stream, "ts", ["event_id"], "2 hours").select("event_id", "user_id", "event_type")
    path = scratch(t.spark, "events-once")
    I.append_files(unique, path, scratch(t.spark, "stream-progress")).awaitTermination()
    return t.spark.read.schema(unique.schema).parquet(path)


@query("str_daily_activity", "int: user_id event_count event_types; text: activity_date", """
    SELECT user_id, COUNT(*) AS event_count, COUNT(DISTINCT event_type) AS event_types, CAST(ts AS DATE) AS activity_date
    FROM events GROUP BY 1, 4""")
def _(t: Tables):
    """Running counts per user, type and day are upserted; distinct types are counted on read."""
    path, files = _landing(t.events, "ts")
    stream = I.file_stream(_stream_session(t), path, schema_of("events"), files_per_batch=files).withColumn("ts", utc_instant("ts"))
    counts = I.daily_counts(stream, "ts", ["user_id", "event_type"], "1 day")
    key = ["activity_date", "user_id", "event_type"]
    change = lambda now, batch: M.upsert_replace(now, batch, key, ["event_count"], check_source=False)
    table = _run(t, counts, counts.schema, change, key, "activity_date", output_mode="update")
    return table.groupBy("activity_date", "user_id").agg(F.sum("event_count").alias("event_count"), F.count(F.lit(1)).alias("event_types"))


@query("str_scd2", _VERSION, _ALL_VERSIONS)
def _(t: Tables):
    """The change log arrives in deliveries and ends as the same history."""
    log = t.orders.select(
        "o_custkey", c("o_orderpriority").alias("tier"), c("o_orderdate").alias("at"), "o_orderkey")
    path, files = _landing(log, "at")
    schema = t.spark.createDataFrame([], VERSION_SCHEMA).schema
    stream = I.file_stream(_stream_session(t), path, log.schema, files_per_batch=files)
    return _run(t, stream, schema, I.version_changes("o_custkey", ["tier"], "at", ["o_orderkey"]), ["o_custkey"], "pmod(xxhash64(o_custkey), 16)")


@query("str_scd2_state", _VERSION, _ALL_VERSIONS)
def _(t: Tables):
    """The same history with each customer's open version in the state store: batches append, nothing stored is read."""
    log = t.orders.select("o_custkey", c("o_orderpriority").alias("tier"), c("o_orderdate").alias("at"), "o_orderkey")
    path, files = _landing(log, "at")
    session = _stream_session(t)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", V.PROVIDER)
    told = V.version_stream(I.file_stream(session, path, log.schema, files_per_batch=files), "o_custkey", ["tier"], "at", ["o_orderkey"])
    out = scratch(t.spark, "versions")
    V.run_versions(told, out, scratch(t.spark, "stream-progress")).awaitTermination()
    return V.read_versions(t.spark, out, told.schema)
