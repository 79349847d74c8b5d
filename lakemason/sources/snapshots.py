"""Row-level change on Parquet: every change publishes new files, readers see old or new.

Layout of version N: ``v=N/data`` (rewritten rows), ``v=N/manifest`` (which version holds each
partition), ``v=N/batches`` (ids of batches applied so far) and an empty marker ``v=N/_COMMITTED``,
created last. The current state is the highest committed version; a job that dies half way leaves a
folder that no reader looks at.

With ``partition_by`` only the partitions a batch touches are read and rewritten; the manifest
keeps pointing at the older files of the others. It is an SQL expression over the merge key: a column
that batches are local in (a date), or a hash bucket as in ``pmod(xxhash64(id), 64)``. A partition that does
not follow from the key would store a key twice once it comes with another value, so a table that is
told its ``key`` refuses such an expression, and changes that merge on a key ask for it (``keyed_by``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_PART = "__part"


class SnapshotTable:
    """A versioned table in shared storage, written by one job at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_by: str | None = None, key: Sequence[str] | None = None):
        self.spark, self.path, self.schema, self.partition_by = spark, path, schema, partition_by
        self._root = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())
        if key is not None:
            self.keyed_by(key)

    def keyed_by(self, key: Sequence[str]) -> None:
        """Fails unless rows with the same ``key`` always lie in the same partition."""
        if self.partition_by is None:
            return
        only = self.spark.createDataFrame([], StructType([f for f in self.schema if f.name in key]))
        try:
            only.select(F.expr(self.partition_by)).schema
        except AnalysisException as error:
            raise ValueError(f"partition {self.partition_by!r} reads columns outside of the key {list(key)}") from error

    def _child(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def version(self) -> int:
        """Highest committed version; 0 before the first publish."""
        if not self._fs.exists(self._root):
            return 0
        names = [status.getPath().getName() for status in self._fs.listStatus(self._root)]
        found = sorted((int(n[2:]) for n in names if n.startswith("v=")), reverse=True)
        return next((n for n in found if self._fs.exists(self._child(f"v={n}/_COMMITTED"))), 0)

    def _manifest(self, version: int) -> dict[str, int]:
        """Partition label -> version that holds its rows. One small row per partition."""
        if version == 0:
            return {}
        rows = self.spark.read.schema("part string, version int").json(f"{self.path}/v={version}/manifest")
        return {row["part"]: row["version"] for row in rows.collect()}

    def _rows(self, manifest: dict[str, int]) -> DataFrame:
        folders = [f"{self.path}/v={v}/data/{_PART}={part}" for part, v in sorted(manifest.items())]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        """The whole table, now or at an earlier version."""
        return self._rows(self._manifest(self.version() if version is None else version))

    def batches(self) -> DataFrame:
        at = self.version()
        if at == 0:
            return self.spark.createDataFrame([], "batch_id string")
        return self.spark.read.schema("batch_id string").parquet(f"{self.path}/v={at}/batches")

    def _label(self, df: DataFrame) -> DataFrame:
        label = F.coalesce(F.expr(self.partition_by).cast("string"), F.lit("null")) if self.partition_by else F.lit("all")
        return df.withColumn(_PART, F.regexp_replace(label, "[^A-Za-z0-9_.-]", "_"))

    def _labels(self, df: DataFrame) -> list[str]:
        """Partition labels in ``df``: as many rows as partitions, not as rows."""
        return [row[_PART] for row in self._label(df).select(_PART).distinct().collect()] if self.partition_by else ["all"]

    def publish(self, state: DataFrame, batch_id: str | None = None, parts: list[str] | None = None) -> int:
        """Make ``state`` the content of ``parts`` (default: of the whole table)."""
        current = self.version()
        target, folder = current + 1, self._child(f"v={current + 1}")
        if self._fs.exists(folder):  # left behind by a job that died before its commit
            self._fs.delete(folder, True)
        data = f"{self.path}/v={target}/data"
        # Rebalancing gives each partition few files, and splits one that is too large for a task.
        rows = self._label(state.select(*self.schema.fieldNames())).hint("rebalance", _PART)
        rows.write.partitionBy(_PART).parquet(data)
        written = [s.getPath().getName() for s in self._fs.listStatus(self._child(f"v={target}/data"))]
        fresh = {name.split("=", 1)[1]: target for name in written if name.startswith(f"{_PART}=")}
        if parts is not None and (stray := fresh.keys() - set(parts)):
            self._fs.delete(folder, True)  # committing would replace rows that were never read
            raise ValueError(f"rows moved to partitions the batch does not touch: {sorted(stray)}")
        kept = {p: v for p, v in self._manifest(current).items() if parts is not None and p not in parts}
        manifest = self.spark.createDataFrame(list((kept | fresh).items()), "part string, version int")
        manifest.coalesce(1).write.json(f"{self.path}/v={target}/manifest")
        done = self.batches()
        if batch_id is not None:
            done = done.unionAll(self.spark.createDataFrame([(batch_id,)], "batch_id string")).distinct()
        done.coalesce(1).write.parquet(f"{self.path}/v={target}/batches")
        self._fs.create(self._child(f"v={target}/_COMMITTED"), False).close()
        return target

    def apply_once(self, batch_id: str, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Publish ``change(current, batch)`` unless this batch was applied before; says whether it ran.

        ``current`` holds the partitions the batch touches, so rows must not move to another
        partition. The batch id commits together with the rows: a replay cannot be added twice.
        """
        if not self.batches().filter(F.col("batch_id") == batch_id).isEmpty():
            return False
        parts = self._labels(batch)
        touched = {p: v for p, v in self._manifest(self.version()).items() if p in parts}
        self.publish(change(self._rows(touched), batch), batch_id, parts)
        return True
