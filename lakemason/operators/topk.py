"""Sorting with stated NULL order, top-k and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakemason.functions.columns import after_row, order_columns
from lakemason.operators.ordered import number_rows


def sort_by(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Global sort with NULLs last on ascending and first on descending keys."""
    return df.orderBy(*order_columns(order_by))


def top_k(df: DataFrame, order_by: Sequence[str], k: int) -> DataFrame:
    """ORDER BY ... LIMIT: each task keeps its own best ``k``."""
    return sort_by(df, order_by).limit(k)


def page_by_offset(df: DataFrame, order_by: Sequence[str], page: int, size: int, deep: bool = False) -> DataFrame:
    """Page ``page`` (from 0). With ``deep`` it is selected by exact row number over range slices, so
    the skipped rows never meet in one task; else from one sorted head, which is lazy and cheaper for early pages."""
    if not deep:
        return sort_by(df, order_by).offset(page * size).limit(size)
    numbered = number_rows(df, [], order_by, "__rn")
    wanted = F.col("__rn").between(page * size + 1, (page + 1) * size)
    return sort_by(numbered.filter(wanted).drop("__rn"), order_by)


def page_after(df: DataFrame, order_by: Sequence[str], last_row: Sequence[object], size: int) -> DataFrame:
    """Seek paging: the next ``size`` rows after ``last_row`` (values of the order columns)."""
    return top_k(df.filter(after_row(order_by, last_row)), order_by, size)
