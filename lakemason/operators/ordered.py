"""Ordered analytics that survive hot groups.

A Spark window sends each PARTITION BY group to one task. That is the right plan while groups are
small, and a lost cause when one key holds a third of the table or when there is no key at all.
Every function here first asks how large the largest group is (one aggregated number) and then
either uses the plain window or splits groups:

* ``running``  - range slices over (keys, order), per-slice totals carried forward as the first row
  of each slice, and one window per slice: one shuffle of the rows after the range step. A slice never holds more than its share of the rows, whatever the key skew.
* ``framed``   - frames of a fixed number of rows, on blocks of consecutive row numbers; each block
  also receives the few rows around its edges that its frames can reach.
* ``value_ranks`` - ranks depend on values only, so rows are first counted per value.
* ``with_totals`` - whole-group aggregates, pre-aggregated before the shuffle and joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemason.functions.columns import all_equal, order_columns, order_names
from lakemason.session import cut

#: Rows a single window group may have before it is split.
MAX_GROUP_ROWS = 4_000_000
#: Rows per block in ``framed``.
BLOCK_ROWS = 1_000_000

_SLICE, _PLACE, _BLOCK, _OWN, _POS = "__slice", "__place", "__block", "__own", "__pos"
_RUNNING = {
    "sum": F.sum,
    "count": F.count,
    "max": F.max,
    "min": F.min,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the largest group: counted map-side first, one number comes back."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n").alias("n")).first()["n"] or 0


def must_split(df: DataFrame, keys: Sequence[str], max_group_rows: int | None, bounded: bool) -> bool:
    """Groups are split when there is no key, or when the largest group is over the limit.

    ``bounded=True`` states that the input is small by construction (months of a calendar, rows
    of an aggregate over a fixed domain); nothing is measured then.
    """
    if bounded:
        return False
    if not keys:
        return True
    return largest_group(df, keys) > (MAX_GROUP_ROWS if max_group_rows is None else max_group_rows)


def _join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on NULL-safe equality of ``keys`` and keep the left side's key columns."""
    kept = [c for c in right.columns if c not in keys]
    condition = all_equal(None, keys, "l", "r")
    return left.alias("l").join(right.alias("r"), condition, how).select("l.*", *[F.col(f"r.{c}") for c in kept])


def _sliced(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], slices: int | None) -> DataFrame:
    """Rows with the number of their range slice and their place in it. Without a fixed count, adaptive execution
    merges neighbouring slices of small inputs; ``spark.sql.shuffle.partitions`` is the upper bound."""
    ranges = [F.col(k).asc() for k in keys] + order_columns(order_by)
    ranged = df.repartitionByRange(slices, *ranges) if slices else df.repartitionByRange(*ranges)
    return cut(ranged.sortWithinPartitions(*ranges).withColumns({_SLICE: F.spark_partition_id(), _PLACE: F.monotonically_increasing_id()}))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    measures: dict[str, tuple[str, Column]],
    *,
    max_group_rows: int | None = None,
    slices: int | None = None,
    bounded: bool = False,
    inclusive: bool = True,
) -> DataFrame:
    """Running aggregates from the start of each group to the current row.

    ``order_by`` must be unique within ``keys`` (end it with a tie-break). ``measures`` maps an
    output name to ``(function, column)`` with function one of sum, count, max, min, last
    (the latest non-NULL value). ``inclusive=False`` stops at the row before.
    """
    frame = (Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    order = order_columns(order_by)
    if not must_split(df, keys, max_group_rows, bounded):
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.withColumns({out: _RUNNING[fn](col).over(window) for out, (fn, col) in measures.items()})

    plain = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
    types = df.withColumns({out: _RUNNING[fn](col).over(plain) for out, (fn, col) in measures.items()}).schema
    group = [_SLICE, *keys]
    values = {f"__v_{out}": col.isNotNull().cast("bigint") if fn == "count" else col for out, (fn, col) in measures.items()}
    kinds = {f"__v_{out}": "sum" if fn == "count" else fn for out, (fn, _) in measures.items()}
    rows = _sliced(df.withColumns(values), keys, order_by, slices)
    # One row per (slice, key): at most `slices` rows per key, so the window over them is bounded.
    totals = {v: F.max_by(v, F.when(F.col(v).isNotNull(), F.col(_PLACE))) if fn == "last" else _RUNNING[fn](F.col(v)) for v, fn in kinds.items()}
    totals = rows.groupBy(*group).agg(*[total.alias(v) for v, total in totals.items()])
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*group, F.lit(-1).cast("bigint").alias(_PLACE), *[_RUNNING[fn](F.col(v)).over(before).alias(v) for v, fn in kinds.items()])
    # What earlier slices add up to enters each slice as its first row, so nothing is joined, and no sum
    # is an addition of two decimals, which would round their digits.
    window = Window.partitionBy(*group).orderBy(_PLACE).rowsBetween(*frame)
    results = {}
    for out, (fn, _) in measures.items():
        result = _RUNNING[kinds[f"__v_{out}"]](F.col(f"__v_{out}")).over(window)
        results[out] = (F.coalesce(result, F.lit(0)) if fn == "count" else result).cast(types[out].dataType)
    whole = rows.unionByName(carried, allowMissingColumns=True).withColumns({f"__r_{out}": result for out, result in results.items()})
    kept = [F.col(f"`{column}`") for column in df.columns if column not in measures]
    return whole.filter(F.col(_PLACE) >= 0).select(*kept, *[F.col(f"__r_{out}").alias(out) for out in measures])


def number_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], out: str = "rn", **options) -> DataFrame:
    """ROW_NUMBER over any group size."""
    return running(df, keys, order_by, {out: ("count", F.lit(1))}, **options)


def attach(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row, as a scalar subquery instead of a join.

    More than one row fails the query.
    """
    value = row.select(F.struct("*").alias("v")).scalar()
    return df.select("*", value.alias("__row")).select(*[F.col(f"`{c}`") for c in df.columns], "__row.*")


def with_totals(df: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Add whole-group aggregates to every row: aggregate first, then join back."""
    sums = df.groupBy(*keys).agg(*[expr.alias(out) for out, expr in totals.items()])
    return _join_keys(df, sums, keys) if keys else attach(df, sums)


def framed(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: Callable[[Window], dict[str, Column]],
    *,
    before: int = 0,
    after: int = 0,
    max_group_rows: int | None = None,
    block_rows: int | None = None,
    slices: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Window columns whose frames reach at most ``before`` rows back and ``after`` rows ahead.

    ``columns(window)`` receives the ordered window and returns the new columns, for example
    ``lambda w: {"previous": F.lag("amount").over(w)}``.
    """
    if not must_split(df, keys, max_group_rows, bounded):
        return df.withColumns(columns(Window.partitionBy(*keys).orderBy(*order_columns(order_by))))
    size = block_rows or BLOCK_ROWS
    numbered = number_rows(df, keys, order_by, _POS, max_group_rows=0, slices=slices)
    position = F.col(_POS) - 1
    first = F.floor(F.greatest(position - after, F.lit(0)) / size)
    last = F.floor((position + before) / size)
    spread = numbered.withColumn(_OWN, F.floor(position / size)).withColumn(
        _BLOCK, F.explode(F.sequence(first, last))
    )
    window = Window.partitionBy(*keys, _BLOCK).orderBy(_POS)
    result = spread.withColumns(columns(window)).filter(F.col(_BLOCK) == F.col(_OWN))
    return result.drop(_POS, _OWN, _BLOCK)


def value_ranks(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    ranks: dict[str, str],
    *,
    max_group_rows: int | None = None,
    slices: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """rank, dense_rank (bigint), percent_rank and cume_dist (double): ``ranks`` maps output name to function name."""
    if not must_split(df, keys, max_group_rows, bounded):
        window = Window.partitionBy(*keys).orderBy(*order_columns(order_by))
        kinds = {"rank": "bigint", "dense_rank": "bigint"}
        return df.withColumns({out: getattr(F, fn)().over(window).cast(kinds.get(fn, "double")) for out, fn in ranks.items()})
    names = order_names(order_by)
    per_value = df.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("__n"))
    upto = running(
        per_value,
        keys,
        order_by,
        {"__upto": ("sum", F.col("__n")), "__dense": ("count", F.lit(1))},
        max_group_rows=0,
        slices=slices,
    )
    upto = with_totals(upto, keys, {"__all": F.sum("__n")})
    rank = F.col("__upto") - F.col("__n") + 1
    forms = {
        "rank": rank,
        "dense_rank": F.col("__dense"),
        "percent_rank": F.when(F.col("__all") > 1, (rank - 1) / (F.col("__all") - 1)).otherwise(F.lit(0.0)),
        "cume_dist": F.col("__upto") / F.col("__all"),
    }
    ranked = upto.select(*keys, *names, *[forms[fn].alias(out) for out, fn in ranks.items()])
    return _join_keys(df, ranked, [*keys, *names])


def buckets(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int, out: str = "bucket", **options) -> DataFrame:
    """NTILE: ``n`` balanced buckets, the first ones take the extra rows."""
    if not must_split(df, keys, options.get("max_group_rows"), options.get("bounded", False)):
        return df.withColumn(out, F.ntile(n).over(Window.partitionBy(*keys).orderBy(*order_columns(order_by))))
    options = {**options, "max_group_rows": 0}
    numbered = with_totals(number_rows(df, keys, order_by, _POS, **options), keys, {"__all": F.count(F.lit(1))})
    return numbered.withColumn(out, bucket_of(F.col(_POS), F.col("__all"), n)).drop(_POS, "__all")


def bucket_of(row: Column, rows: Column, n: int) -> Column:
    """Bucket of row number ``row`` among ``rows`` rows: sizes differ by at most one, larger first."""
    size, extra = F.floor(rows / n), rows % n
    in_large = row <= extra * (size + 1)
    return F.when(in_large, F.ceil(row / (size + 1))).otherwise(
        extra + F.ceil((row - extra * (size + 1)) / F.greatest(size, F.lit(1)))
    ).cast("int")


def peers_running(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], measure: Column, out: str, **options) -> DataFrame:
    """Running sum with RANGE semantics: rows that tie on the order share one value."""
    names = order_names(order_by)
    per_value = df.groupBy(*keys, *names).agg(F.sum(measure).alias("__v"))
    totals = running(per_value, keys, order_by, {out: ("sum", F.col("__v"))}, **options)
    return _join_keys(df, totals.select(*keys, *names, out), [*keys, *names])


def nth_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int = 1) -> DataFrame:
    """The ``n``-th row of every group (groups with fewer rows give none).

    The filter on the row number is applied before the shuffle as well (a group limit on each map
    task), so a hot group ships at most ``n`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_columns(order_by))
    return df.withColumn(_POS, F.row_number().over(window)).filter(F.col(_POS) == n).drop(_POS)
