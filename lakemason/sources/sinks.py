"""Sinks: append, insert-select, create-as-select, idempotent rebuild, views."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakemason.session import scratch

__all__ = ["append", "create_as", "insert_select", "replace", "replace_table", "scratch", "temporary_view"]


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Drop and rebuild: running it again leaves the same table."""
    df.write.mode("overwrite").parquet(path)


def insert_select(df: DataFrame, table: str) -> None:
    """INSERT INTO table SELECT: columns are matched by position, as SQL does."""
    df.write.insertInto(table)


def create_as(df: DataFrame, table: str, **options) -> None:
    """CREATE TABLE AS SELECT; fails when the table exists."""
    df.write.options(**options).format("parquet").saveAsTable(table)


def replace_table(df: DataFrame, table: str, **options) -> None:
    """DROP + CREATE + INSERT in one step."""
    df.write.options(**options).format("parquet").mode("overwrite").saveAsTable(table)


@contextmanager
def temporary_view(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A view that lives for one step and is dropped after it."""
    df.createOrReplaceTempView(name)
    try:
        yield df.sparkSession.table(name)
    finally:
        df.sparkSession.catalog.dropTempView(name)
