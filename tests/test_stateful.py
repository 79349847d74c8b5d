"""Type-2 history from keyed state: the same as in one batch, over restarts, replays and late changes."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Row, functions as F
from pyspark.sql.types import _parse_datatype_string

from lakemason.operators import scd as D
from lakemason.session import scratch
from lakemason.streaming import ingest as I, stateful as V

CHANGE = "k int, tier string, at timestamp_ntz, seq int"


@pytest.fixture
def session(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "2")
    own.conf.set("spark.sql.streaming.stateStore.providerClass", V.PROVIDER)
    return own


def moment(day):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def deliver(spark, path, rows):
    spark.createDataFrame([(k, t, moment(d), s) for k, t, d, s in rows], CHANGE).coalesce(1).write.mode("append").parquet(path)


def run(session, path, out, checkpoint):
    stream = I.file_stream(session, path, session.createDataFrame([], CHANGE).schema, files_per_batch=1)
    told = V.version_stream(stream, "k", ["tier"], "at", ["seq"])
    V.run_versions(told, out, checkpoint).awaitTermination()
    return told.schema


def test_history_equals_the_batch_form_over_a_restart(spark, session):
    rnd = random.Random(4)
    # rising days in each delivery, out of order within it; instants with several changes; NULL tiers
    deliveries = [[(rnd.randint(1, 6), rnd.choice(["a", "b", None]), 10 * n + rnd.randint(0, 9), 100 * n + i) for i in range(40)] for n in range(3)]
    path, out, checkpoint = (scratch(spark, n) for n in ("in", "out", "progress"))
    for n, rows in enumerate(deliveries):
        deliver(spark, path, rows)
        if n != 1:  # two deliveries are read by the restarted query
            schema = run(session, path, out, checkpoint)
    log = spark.createDataFrame([(k, t, moment(d), s) for rows in deliveries for k, t, d, s in rows], CHANGE)
    want = D.history(log, "k", ["tier"], "at", ["seq"]).select("k", "tier", "valid_from", "valid_to", "is_current")
    got = V.read_versions(spark, out, schema).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() > 20
    assert V.read_late(spark, out, schema).count() == 0


def test_replays_change_nothing_and_late_changes_are_told(spark, session):
    path, out, checkpoint = (scratch(spark, n) for n in ("in", "out", "progress"))
    deliver(spark, path, [(1, "a", 1, 1), (1, "b", 5, 2), (2, "x", 3, 3), (None, "lost", 1, 4)])
    schema = run(session, path, out, checkpoint)
    before = sorted(map(tuple, V.read_versions(spark, out, schema).collect()))
    assert [(k, t, f, e.year) for k, t, f, e, _ in before] == [(1, "a", moment(1), 2024), (1, "b", moment(5), 9999), (2, "x", moment(3), 9999)]
    deliver(spark, path, [(1, "b", 5, 2), (2, "x", 3, 3), (1, "c", 2, 9), (2, "x", 8, 10)])  # two replayed, one late, one no-op
    run(session, path, out, checkpoint)
    assert sorted(map(tuple, V.read_versions(spark, out, schema).collect())) == before
    assert [tuple(r) for r in V.read_late(spark, out, schema).collect()] == [(1, "c", moment(2))]


def test_batches_do_not_read_what_is_stored(spark, session):
    path, out, checkpoint = (scratch(spark, n) for n in ("in", "out", "progress"))
    deliver(spark, path, [(1, "a", 1, 1)])
    schema = run(session, path, out, checkpoint)
    folder = out.removeprefix("file:")
    for name in os.listdir(folder):
        if name.startswith("part-"):
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"no parquet")
    deliver(spark, path, [(1, "b", 2, 2)])
    run(session, path, out, checkpoint)  # the open version came from the state
    new = [f"{folder}/{n}" for n in os.listdir(folder) if n.startswith("part-") and os.path.getsize(f"{folder}/{n}") > 20]
    rows = spark.read.schema(schema).parquet(*new).orderBy("kind").collect()
    assert [(r.kind, r.tier, r.valid_from, r.valid_to) for r in rows] == [("closed", "a", moment(1), moment(2)), ("opened", "b", moment(2), None)]


class Store:
    """A value state that counts how often it is asked."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def test_the_state_is_asked_once_a_bucket_and_batch():
    schema = _parse_datatype_string(CHANGE)
    processor, store = V.OpenVersion("k", ["tier"], "at", ["seq"], schema), Store()
    processor.init(store)
    for n, kinds in enumerate((["opened"], ["closed", "opened"])):
        rows = [Row(k=k, tier="ab"[n], at=moment(n), seq=k) for k in range(300)]
        told = list(processor.handleInputRows((7,), iter(rows), None))
        assert sorted((r.kind, r.k) for r in told) == sorted((kind, k) for k in range(300) for kind in kinds)
        assert store.calls == 2 * (n + 1)
    # a batch with one key of the bucket leaves the others as they are
    told = list(processor.handleInputRows((7,), iter([Row(k=5, tier="a", at=moment(9), seq=1)]), None))
    assert [(r.kind, r.tier) for r in told] == [("closed", "b"), ("opened", "a")]
    assert sorted(store.value[0]) == [(k, *(("a", moment(9)) if k == 5 else ("b", moment(1)))) for k in range(300)]


@pytest.mark.parametrize("kind", ["string", "double", "binary", "array<int>"])
def test_any_key_that_groups_has_its_history(spark, session, kind):
    keys = {"string": ["x", "", "1"], "double": ["NaN", "0.0", "-0.0", "NaN"], "binary": ["a", "b", "a"],
            "array<int>": ["[1,2]", "[]", "[1,2]"]}[kind]
    parse = F.from_json("text", kind) if "<" in kind else F.col("text").cast(kind)
    path, out, checkpoint = (scratch(spark, n) for n in ("in", "out", "progress"))
    rows = [(k, t, moment(10 * n + i), i) for n, t in enumerate("ab") for i, k in enumerate(keys)]
    log = spark.createDataFrame(rows, "text string, tier string, at timestamp_ntz, seq int").select(parse.alias("k"), "tier", "at", "seq")
    for tier in "ab":
        log.filter(F.col("tier") == tier).coalesce(1).write.mode("append").parquet(path)
    told = V.version_stream(I.file_stream(session, path, log.schema, files_per_batch=1), "k", ["tier"], "at", ["seq"], buckets=2)
    V.run_versions(told, out, checkpoint).awaitTermination()
    want = D.history(log, "k", ["tier"], "at", ["seq"]).select("k", "tier", "valid_from", "valid_to", "is_current")
    got = V.read_versions(spark, out, told.schema).select(*want.columns)
    groups = log.select("k").distinct().count()
    assert got.filter("is_current").count() == groups
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
