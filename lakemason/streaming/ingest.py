"""File streams into snapshot tables. Every job runs with ``availableNow`` by default and can be
restarted: source progress is in the query checkpoint, applied batches are in the table's ledger."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakemason.operators.merge import latest_per_key, upsert_add, upsert_replace
from lakemason.operators.scd import scd2
from lakemason.sources.snapshots import SnapshotTable


def file_stream(spark: SparkSession, path: str, schema: StructType, *, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def without_redelivery(stream: DataFrame, event_time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Drop re-delivered events; state is kept only for ``delay``."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_counts(stream: DataFrame, event_time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Events per key and tumbling UTC day; rows later than ``delay`` are not counted."""
    day = F.window(event_time, "1 day")
    counted = stream.withWatermark(event_time, delay).groupBy(day, *keys).agg(F.count(F.lit(1)).alias("event_count"))
    return counted.select(_utc_date(F.col("window.start")).alias("activity_date"), *keys, "event_count")


def _utc_date(moment: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_micros(moment) / 86_400_000_000).cast("int"))


def run_batches(
    stream: DataFrame,
    table: SnapshotTable,
    change: Callable[[DataFrame, DataFrame], DataFrame],
    checkpoint: str,
    *,
    job: str = "stream",
    output_mode: str = "append",
    continuous_every: str | None = None,
) -> StreamingQuery:
    """Apply ``change(current, batch)`` per micro-batch, at most once per batch id."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for its partitions, then for its rows
        try:
            table.apply_once(f"{job}-{batch_id}", batch, change)
        finally:
            batch.unpersist()

    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(apply)
    writer = writer.trigger(processingTime=continuous_every) if continuous_every else writer.trigger(availableNow=True)
    return writer.start()


def append_files(stream: DataFrame, path: str, checkpoint: str, *, continuous_every: str | None = None) -> StreamingQuery:
    """Add the rows of a stream to a folder of Parquet files, each once: nothing stored is read or rewritten."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous_every) if continuous_every else writer.trigger(availableNow=True)
    return writer.start(path)


def upsert_latest(table: SnapshotTable, keys: Sequence[str], order_by: Sequence[str], update: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Micro-batch change: newest row per key replaces the stored one."""
    table.keyed_by(keys)
    return lambda current, batch: upsert_replace(
        current, latest_per_key(batch, keys, order_by), keys, update, check_source=False
    )


def accumulate(keys: Sequence[str], measures: dict[str, Column], latest: Column, latest_out: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Micro-batch change: add the batch totals to the stored ones."""

    def change(current: DataFrame, batch: DataFrame) -> DataFrame:
        totals = batch.groupBy(*keys).agg(*[F.sum(c).alias(o) for o, c in measures.items()], F.max(latest).alias(latest_out))
        return upsert_add(current, totals, keys, list(measures), latest=[latest_out], check_source=False)

    return change


def version_changes(key: str, tracked: Sequence[str], at: str, tie_break: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Micro-batch change: type-2 versions of the batch's change feed."""
    return lambda current, batch: scd2(current, batch, key, tracked, at, tie_break, null_safe=True)
