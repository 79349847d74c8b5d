"""Seeded synthetic columns as Spark expressions: the same id and seed always give the same row.

Every value is a hash of (seed, column, id), so generation is parallel, needs no state, and a
recomputed partition repeats itself exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def uniform(seed: int, name: str, row_id: Column | str = "id") -> Column:
    """Hash-based number in [0, 1)."""
    row = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(name), row), 11) / F.lit(2.0**53)


def weighted(seed: int, name: str, choices: Sequence[tuple[str, int]], row_id: Column | str = "id") -> Column:
    """Pick a label with the given integer weights."""
    total = sum(weight for _, weight in choices)
    draw = uniform(seed, name, row_id) * F.lit(total)
    result = F.lit(choices[-1][0])
    for (label, _), upper in reversed(list(zip(choices, accumulate(w for _, w in choices)))):
        result = F.when(draw < F.lit(upper), F.lit(label)).otherwise(result)
    return result


def amount(seed: int, name: str, low: float, high: float, row_id: Column | str = "id") -> Column:
    """Money between ``low`` and ``high``."""
    return F.round(F.lit(low) + uniform(seed, name, row_id) * F.lit(high - low), 2).cast("decimal(12,2)")


def moment(seed: int, name: str, start: str, days: int, row_id: Column | str = "id") -> Column:
    """Timestamp within ``days`` days after ``start``."""
    seconds = F.floor(uniform(seed, name, row_id) * F.lit(days * 86400)).cast("int")
    return F.to_timestamp_ntz(F.lit(start)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


# Order status weights of the generated shop data, in percent.
ORDER_STATUS = [
    ("pending", 3), ("confirmed", 10), ("packed", 10), ("shipped", 10),
    ("delivered", 55), ("cancelled", 8), ("refunded", 4),
]


def shop_orders(spark: SparkSession, rows: int, customers: int, seed: int = 42, hot_share: float = 0.0) -> DataFrame:
    """Synthetic orders; ``hot_share`` of them belong to customer 0 (a skew fixture)."""
    base = spark.range(rows)
    customer = F.when(uniform(seed, "hot") < F.lit(hot_share), F.lit(0)).otherwise(
        F.floor(uniform(seed, "customer") * F.lit(customers))
    )
    return base.select(
        F.col("id").alias("order_id"),
        customer.cast("bigint").alias("customer_id"),
        weighted(seed, "status", ORDER_STATUS).alias("order_status"),
        moment(seed, "time", "2025-01-01 00:00:00", 365).alias("order_timestamp"),
        amount(seed, "total", 10, 500).alias("total_amount"),
    )


def shop_items(orders: DataFrame, products: int, seed: int = 42, max_lines: int = 5) -> DataFrame:
    """One to ``max_lines`` lines per order, derived from the order id."""
    count = F.floor(uniform(seed, "lines", "order_id") * F.lit(max_lines)).cast("int") + 1
    line = orders.select("order_id", F.explode(F.sequence(F.lit(1), count)).alias("line_number"))
    row = F.col("order_id") * F.lit(max_lines) + F.col("line_number")
    return line.select(
        "order_id",
        "line_number",
        F.floor(uniform(seed, "product", row) * F.lit(products)).cast("bigint").alias("product_id"),
        (F.floor(uniform(seed, "quantity", row) * F.lit(4)) + 1).cast("int").alias("quantity"),
        amount(seed, "price", 5, 200, row).alias("unit_price"),
    )
