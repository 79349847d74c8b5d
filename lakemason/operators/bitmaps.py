"""Exact distinct counts that roll up: bitmaps of ids stored at a fine grain.

A bitmap says which of 32,768 neighbouring ids occur, in 4 kB. A day's bitmaps are made once, where its rows are read,
and a month's are the bitwise OR of its days', so coarser counts never look at the ids again, and counts at several
grains need no copy of the rows. Ids are whole numbers that lie close together, as surrogate keys do; NULL is
no id. With few ids spread over a wide range the bitmaps are larger than the ids: number such ids first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def id_bitmaps(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """``keys, bucket, bits, row_count``: the ids of each group, one row for each stretch of ids that it touches."""
    known = df.filter(F.col(member).isNotNull())
    grouped = known.groupBy(*keys, F.bitmap_bucket_number(member).alias("bucket"))
    return grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias("bits"), F.count(F.lit(1)).alias("row_count"))


def rolled_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same at a coarser grain: ``keys`` are columns of ``bitmaps``."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("row_count").alias("row_count"))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], out: str = "n_distinct", rows: str = "row_count") -> DataFrame:
    """Distinct ids and rows by ``keys``, from bitmaps of that grain or a finer one."""
    rolled = rolled_bitmaps(bitmaps, keys)
    return rolled.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out), F.sum("row_count").alias(rows))


def distinct_by_levels(bitmaps: DataFrame, levels: Sequence[Sequence[str]], out: str = "n_distinct") -> DataFrame:
    """Distinct ids and rows at several grains, finest first, each rolled up from the one before; columns that a grain
    lacks are NULL, ``level`` is its place from 1."""
    names = list(dict.fromkeys(k for level in levels for k in level))
    types = dict(bitmaps.dtypes)
    result, current = None, bitmaps
    for place, level in enumerate(levels, 1):
        current = rolled_bitmaps(current, level)
        counted = distinct_counts(current, level, out).select(
            F.lit(place).alias("level"), *[F.col(k) if k in level else F.lit(None).cast(types[k]).alias(k) for k in names], out, "row_count")
        result = counted if result is None else result.unionByName(counted)
    return result
