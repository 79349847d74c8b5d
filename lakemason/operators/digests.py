"""Comparing two large tables that are nearly equal, by a tree of digests.

Both tables are cut into ranges of a position (their key, or a hash of it), and each range gets a digest of its rows that
does not depend on their order. Where the digests agree, the rows agree and are not looked at again. Where they
differ the range is cut into smaller ones, until few enough rows are left; only those are compared row by row.

A level is one scan of the ranges still in question: rows are summed where they are read, and at most ``FANOUT``
small rows a task and open range leave it. So equal ranges are never shuffled, whatever their size and however many rows
share a key, and with a key as the position the scans of later levels skip files and row groups by its bounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.operators.setops import reconcile, reconcile_counts

#: Ranges that a range is cut into (two at least).
FANOUT = 1024
#: With so many rows (both sides together) in the ranges that differ, they are not cut further.
LEAF_ROWS = 100_000
#: Ranges that differ may be so many before they are no longer named one by one in a filter.
NAMED = 64

_WHOLE = ("tinyint", "smallint", "int", "bigint")


@dataclass
class Differing:
    """What the digests say: ranges of positions (both bounds included), the position that rows without one have, and
    for each level the width of its ranges, how many of them differ, and the rows read and left."""

    ranges: list[tuple[int, int]]
    low: int
    levels: list[dict[str, int]] = field(default_factory=list)

    def bounds(self) -> list[tuple[int, int]]:
        """The ranges, neighbours joined; beyond ``NAMED`` also those with the smallest gaps between them."""
        joined: list[list[int]] = []
        for first, last in sorted(self.ranges):
            if joined and first <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], last)
            else:
                joined.append([first, last])
        gaps = sorted(range(1, len(joined)), key=lambda i: joined[i][0] - joined[i - 1][1])
        for i in sorted(gaps[: max(0, len(joined) - NAMED)], reverse=True):
            joined[i - 1][1] = joined[i][1]
            del joined[i]
        return [(a, b) for a, b in joined]


def _whole(df: DataFrame, key: str) -> bool:
    return dict(df.dtypes)[key] in _WHOLE


def position_of(df: DataFrame, key: str) -> Column:
    """Where a row lies: a whole number itself, anything else by a hash of it."""
    return F.col(f"`{key}`").cast("bigint") if _whole(df, key) else F.xxhash64(f"`{key}`")


def _part(position: Column, width: int) -> Column:
    """Number of the part of ``width`` positions, exact over all 64-bit numbers."""
    below = F.when((position < 0) & (position % width != 0), 1).otherwise(0)
    return F.call_function("div", position, F.lit(width).cast("bigint")) - below


def _bounded(df: DataFrame, key: str, found: Differing) -> DataFrame:
    """The rows within the bounds. On a whole key these are comparisons with the column itself, which a scan can use."""
    place = F.col(f"`{key}`") if _whole(df, key) else position_of(df, key)
    inside = reduce(Column.__or__, [place.between(a, b) for a, b in found.bounds()], F.lit(False))
    return df.filter(inside | place.isNull() if any(a <= found.low <= b for a, b in found.ranges) else inside)


def digests(df: DataFrame, key: str, found: Differing, width: int) -> DataFrame:
    """``part, n, a, b, x``: for each part of ``width`` positions the number of its rows and three sums of their hashes.

    A row's hash covers its values and which of them are NULL. Two different multisets of rows have the same digest
    with a probability of about 2**-64.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    position = F.coalesce(position_of(df, key), F.lit(found.low))
    hashed = _bounded(df, key, found).select(_part(position, width).alias("part"), F.xxhash64(*columns, nulls).alias("h"))
    return hashed.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("a"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("b"), F.bit_xor("h").alias("x"))


def differing(left: DataFrame, right: DataFrame, key: str, *, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> Differing:
    """The ranges of ``key`` whose rows differ between two tables of the same columns.

    A level narrows all open ranges at once by the same factor. It is the last one when few rows are left in them, when
    ranges are single positions, when cutting took nearly nothing away, or when more than half of ``fanout``
    ranges differ (then most of the table does). So at most ``fanout ** 2 / 2`` numbers reach the driver.
    """
    right = right.toDF(*left.columns)
    if _whole(left, key) != _whole(right, key):
        raise TypeError(f"{key} is a whole number on one side only")
    ends = [df.agg(F.min(position_of(df, key)).alias("low"), F.max(position_of(df, key)).alias("high")).first() for df in (left, right)]
    known = [x for e in ends for x in e if x is not None]
    low, high = (min(known), max(known)) if known else (0, 0)
    found, width, rows = Differing([(low, high)], low), 1, None
    while width * fanout < high - low + 1:  # powers, so that parts lie within parts
        width *= fanout
    while True:
        sides = [digests(df, key, found, width) for df in (left, right)]
        both = sides[0].alias("l").join(sides[1].alias("r"), "part", "full")
        same = reduce(Column.__and__, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("n", "a", "b", "x")])
        n = F.coalesce("l.n", F.lit(0)) + F.coalesce("r.n", F.lit(0))
        # one job for both: the parts that differ, and one row for all that agree
        told = both.groupBy(F.when(~same, F.col("part")).alias("part"), same.alias("same")).agg(F.sum(n).alias("n")).collect()
        parts = [r.part for r in told if not r.same]
        left_over = sum(r.n for r in told if not r.same)
        found.ranges = [(max(low, p * width), min(high, (p + 1) * width - 1)) for p in parts]
        found.levels.append({"width": width, "ranges": len(parts), "rows_read": sum(r.n for r in told), "rows_left": left_over})
        stuck = rows is not None and left_over > rows * 0.9
        if not parts or width == 1 or left_over <= leaf_rows or stuck or len(parts) > fanout // 2:
            return found
        rows, width = left_over, width // fanout


def suspects(df: DataFrame, key: str, found: Differing) -> DataFrame:
    """The rows that lie in the ranges that differ; beyond ``NAMED`` ranges are told apart after the scan, by the
    numbers of the parts (broadcast: no more than ``differing`` collects)."""
    if not found.ranges:
        return df.limit(0)
    rows = _bounded(df, key, found)
    if len(found.bounds()) < NAMED:
        return rows
    width = found.levels[-1]["width"]
    parts = df.sparkSession.createDataFrame([(a // width,) for a, _ in found.ranges], "__part bigint")
    own = _part(F.coalesce(position_of(df, key), F.lit(found.low)), width)
    return rows.withColumn("__part", own).join(F.broadcast(parts), "__part", "left_semi").select(*[f"`{c}`" for c in df.columns])


def reconcile_by_digest(
    left: DataFrame, right: DataFrame, key: str, left_tag: str = "ONLY_IN_STAGING", right_tag: str = "ONLY_IN_PROD",
    *, counts: bool = False, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``reconcile`` (with ``counts``: ``reconcile_counts``), but only rows in ranges that differ are compared."""
    found = differing(left, right, key, fanout=fanout, leaf_rows=leaf_rows)
    sides = [suspects(df, key, found) for df in (left, right.toDF(*left.columns))]
    return (reconcile_counts if counts else reconcile)(*sides, left_tag, right_tag)
