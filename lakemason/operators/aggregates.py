"""Grouped measures: conditional totals, pivots, favourites, shares and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.functions.columns import ratio
from lakemason.operators.ordered import nth_rows, with_totals


def sum_when(condition: Column, amount: Column, empty: object = 0) -> Column:
    """Conditional sum: 0 when nothing matches (CASE form), or NULL with ``empty=None`` (FILTER form)."""
    matched = F.when(condition, amount)
    return F.sum(matched) if empty is None else F.sum(F.coalesce(matched, F.lit(empty).cast("decimal(18,2)")))


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def pivot_sum(df: DataFrame, row: str, pivot: str, values: dict[str, str], amount: Column, **extra: Column) -> DataFrame:
    """Rows to columns: one summed column per listed value, 0 where a cell is empty.

    ``values`` maps a pivot value to its output column. Listing them avoids a pass over the data
    to discover them, and the conditional sums need a single partial aggregate.
    """
    cells = [sum_when(F.col(pivot) == value, amount).alias(out) for value, out in values.items()]
    return df.groupBy(row).agg(*[c.alias(n) for n, c in extra.items()], *cells)


def favourite(df: DataFrame, keys: Sequence[str], value: str, out: str = "favourite") -> DataFrame:
    """Most frequent value per key; ties go to the smaller value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("uses"))
    return nth_rows(counts, keys, ["-uses", value]).select(*keys, F.col(value).alias(out), "uses")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of the table per value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    shares = with_totals(counts, [], {"__all": F.sum("row_count")})
    return shares.withColumn("pct_of_table", ratio(F.col("row_count"), F.col("__all"), 2, 100)).drop("__all")


def closing_balance(df: DataFrame, entity: Sequence[str], period: str, order_by: Sequence[str], value: Column) -> DataFrame:
    """Semi-additive measure: last value per entity and period, then summed over entities."""
    descending = [n[1:] if n.startswith("-") else f"-{n}" for n in order_by]
    last = nth_rows(df, [*entity, period], descending)
    return last.groupBy(period).agg(F.sum(value).alias("closing_total"), F.count(F.lit(1)).alias("entities"))
