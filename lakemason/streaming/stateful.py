"""Type-2 history with the open version of each key in the state store.

A micro-batch reads and writes only what it brings: the state of its keys, and rows appended to a folder. No stored
table is read or rewritten, so the cost of a batch follows its own size, not that of the history. Python asks the state
store and answers Spark once a group, which costs more than a key's few rows; so a group is a hash bucket of keys,
and its state the open versions of these keys. The folder takes three
kinds of rows: ``opened`` (a version starts), ``closed`` (it ends) and ``late`` (a change older than the version that is
open, which is told and not applied). The file sink and the state commit together with the batch, so a restart
repeats nothing.
"""

from __future__ import annotations

import operator
from collections import defaultdict
from collections.abc import Hashable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, StructField, StructType

from lakemason.operators.scd import OPEN_END
from lakemason.streaming.ingest import append_files

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Hash buckets that keys are kept in; part of the state, so never changed for a stream once started.
BUCKETS = 1 << 14


def _ident(key: object) -> Hashable:
    """What equal keys have in common: the key, or its text where equal values need not be equal in Python (NaN) or
    cannot be looked up."""
    return repr(key) if isinstance(key, (float, bytearray, list, tuple, dict)) else key


class OpenVersion(StatefulProcessor):
    """State of a bucket: of each of its keys the attributes of the open version, and when it started."""

    def __init__(self, key: str, tracked: Sequence[str], at: str, tie_break: Sequence[str], schema: StructType):
        self.key, self.tracked, self.at, self.ties, self.schema = key, list(tracked), at, list(tie_break), schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        version = StructType([self.schema[c] for c in [self.key, *self.tracked, self.at]])
        self.open = handle.getValueState("open", StructType([StructField("versions", ArrayType(version))]))

    def _row(self, kind: str, key: object, values: Sequence[object], start: object, end: object = None) -> Row:
        return Row(**{"kind": kind, self.key: key, **dict(zip(self.tracked, values)), "valid_from": start, "valid_to": end})

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers: object) -> Iterator[Row]:
        """Changes of one bucket and batch, key by key."""
        by_key = defaultdict(list)
        for row in rows:
            by_key[_ident(row[self.key])].append(row)
        state = self.open.get()
        versions = {_ident(v[0]): tuple(v) for v in state[0]} if state else {}
        for ident, changes in by_key.items():
            before = versions.get(ident)
            current = yield from self._told(changes[0][self.key], changes, before and before[1:])
            if current is not None:
                versions[ident] = (before[0] if before else changes[0][self.key], *current)
        if versions:
            self.open.update(([*versions.values()],))

    def _told(self, key: object, rows: Sequence[Row], current: tuple | None) -> Iterator[Row]:
        """Changes of one key, in order of time; of several at one instant the last by ``tie_break`` counts. Returns the
        version that is open after them.

        A change at the start of the open version came with a batch of its own and is late: what it would
        override is told already.
        """
        order = operator.itemgetter(self.at, *self.ties)
        changes: dict[object, tuple] = {}
        for row in sorted(rows, key=lambda r: tuple((v is not None, v) for v in (order(r) if self.ties else (r[self.at],)))):
            changes[row[self.at]] = tuple(row[c] for c in self.tracked)
        for moment, values in changes.items():
            if moment is None or current is not None and moment <= current[-1]:
                if current is None or moment is None or values != current[:-1] or moment != current[-1]:
                    yield self._row("late", key, values, moment)
            elif current is None or values != current[:-1]:
                if current is not None:
                    yield self._row("closed", key, current[:-1], current[-1], moment)
                yield self._row("opened", key, values, moment)
                current = (*values, moment)
        return current

    def close(self) -> None:
        pass


def version_stream(stream: DataFrame, key: str, tracked: Sequence[str], at: str, tie_break: Sequence[str] = (), *, buckets: int = BUCKETS) -> DataFrame:
    """Rows ``kind, key, tracked..., valid_from, valid_to`` from a stream of changes. Rows without a key are left out.
    The session of the stream needs ``spark.sql.streaming.stateStore.providerClass`` set to ``PROVIDER``."""
    schema = stream.schema
    names = {"kind": "string", key: schema[key].dataType.simpleString(), **{c: schema[c].dataType.simpleString() for c in tracked}}
    names |= dict.fromkeys(("valid_from", "valid_to"), schema[at].dataType.simpleString())
    told = ", ".join(f"`{n}` {t}" for n, t in names.items())
    changes = stream.filter(F.col(key).isNotNull()).select(key, *tracked, at, *[c for c in tie_break if c != at])
    if names[key] in ("float", "double"):
        changes = changes.withColumn(key, F.col(key) + F.lit(0).cast(names[key]))  # one zero
    grouped = changes.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(buckets))).groupBy("__bucket")
    return grouped.transformWithState(OpenVersion(key, tracked, at, tie_break, schema), told, "Append", "None")


def run_versions(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Append the rows of ``version_stream`` to ``path``."""
    return append_files(stream, path, checkpoint, **options)


def read_versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The history so far: every version that was opened, with its end or the open end."""
    rows = spark.read.schema(schema).parquet(path).filter("kind <> 'late'")
    kept = [c for c in schema.fieldNames() if c not in ("kind", "valid_from", "valid_to")]
    ends = rows.groupBy(*kept, "valid_from").agg(F.max("valid_to").alias("valid_to"))
    open_end = F.lit(OPEN_END).cast(schema["valid_to"].dataType)
    return ends.select(*kept, "valid_from", F.coalesce("valid_to", open_end).alias("valid_to"), F.col("valid_to").isNull().alias("is_current"))


def read_late(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Changes that came too late to be applied."""
    return spark.read.schema(schema).parquet(path).filter("kind = 'late'").drop("kind", "valid_to").withColumnRenamed("valid_from", "changed_at")
