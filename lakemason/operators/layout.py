"""File layouts that let later scans skip data: sorted, partitioned, narrow, bucketed, filtered.

Each writer leaves the rows unchanged; readers are plain scans whose filters reach the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.functions.columns import order_columns, order_names


def _spread(df: DataFrame, ranges: list[Column], files: int | None) -> DataFrame:
    """Range partitions; a hash of the row behind the keys lets one frequent value span several of them."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    rest = [F.xxhash64(*hashed)] if hashed else []
    return df.repartitionByRange(files, *ranges, *rest) if files else df.repartitionByRange(*ranges, *rest)


def write_sorted(df: DataFrame, path: str, order_by: Sequence[str], files: int | None = None) -> None:
    """Range-clustered files sorted inside: row groups outside a range are skipped by min/max.

    A frequent value spreads over several files; only rows equal in every column stay together.
    """
    ranges = order_columns(order_by)
    _spread(df, ranges, files).sortWithinPartitions(*ranges).write.parquet(path)


def write_composite(df: DataFrame, path: str, equality: Sequence[str], order_by: Sequence[str], files: int | None = None) -> None:
    """Folders by the equality columns, files ranged and sorted by the order columns.

    Ranging on both spreads one dominant equality value over many tasks and files.
    """
    ranges = [F.col(c).asc() for c in equality] + order_columns(order_by)
    _spread(df, ranges, files).sortWithinPartitions(*ranges).write.partitionBy(*equality).parquet(path)


def write_covering(df: DataFrame, path: str, columns: Sequence[str], order_by: Sequence[str]) -> None:
    """Narrow sorted copy with just the columns a report reads."""
    missing = set(order_names(order_by)) - set(columns)
    if missing:
        raise ValueError(f"order columns not in the copy: {sorted(missing)}")
    write_sorted(df.select(*columns), path, order_by)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Hash buckets, sorted inside: equi joins and groupings on ``keys`` need no shuffle.

    A dominant key fills one bucket; bucket unique or evenly used keys only.
    """
    dealt = df.repartition(buckets, *keys)  # the table's own hash: one file a bucket
    writer = dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_bloom(df: DataFrame, path: str, column: str, distinct_values: int) -> None:
    """Bloom filters for equality lookups on an unsorted column."""
    df.write.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
        f"parquet.bloom.filter.expected.ndv#{column}", str(distinct_values)
    ).parquet(path)


def write_partial(df: DataFrame, path: str, hot: Column, order_by: Sequence[str]) -> None:
    """Sorted copy of the rows that are asked for often."""
    write_sorted(df.filter(hot), path, order_by)


def write_derived(df: DataFrame, path: str, derived: dict[str, Column], order_by: Sequence[str]) -> None:
    """Store expressions as columns, so filters on them reach the files (lower-cased or reversed text)."""
    write_sorted(df.withColumns(derived), path, order_by)
