"""Dimensional model toolkit: calendar, keys, unknown members, allocation, facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakemason.functions.columns import all_equal, date_key, days_between, order_columns
from lakemason.operators.ordered import _join_keys, attach, nth_rows, number_rows, running
from lakemason.session import cut
from lakemason.sources.tables import days

# The unknown member of the date dimension, in column order.
UNKNOWN_DATE = {
    "date_key": -1, "calendar_date": "1900-01-01", "year": 1900, "quarter": 0, "quarter_name": "Unknown",
    "month": 0, "month_name": "Unknown", "month_short": "Unk", "year_month": "1900-00", "day_of_month": 0,
    "day_of_week": 0, "day_name": "Unknown", "is_weekend": False, "iso_week": 0, "fiscal_year": 1900,
    "fiscal_quarter": "Unknown", "is_holiday": False, "holiday_name": "Not Applicable",
}
# Holidays as month * 100 + day.
HOLIDAYS = {101: "New Year's Day", 704: "Independence Day", 1225: "Christmas Day"}
#: Fixed value: first month of the fiscal year.
FISCAL_START = 7
#: The one day of a calendar over tables without any date.
NO_DATE = "1995-01-01"


def date_bounds(*sources: tuple[DataFrame, str]) -> tuple[str, str]:
    """First and last day of the calendar that covers every date of the ``(table, column)`` pairs, measured at once.

    Tables without any date give one day, ``NO_DATE``.
    """
    dates = reduce(DataFrame.unionAll, [df.agg(F.to_date(F.min(at)).alias("first"), F.to_date(F.max(at)).alias("last")) for df, at in sources])
    row = dates.agg(F.min("first").cast("string").alias("first"), F.max("last").cast("string").alias("last")).first()
    return row["first"] or NO_DATE, row["last"] or NO_DATE


def dim_date(spark: SparkSession, start: str, stop: str, *, label_year: str = "start") -> DataFrame:
    """Calendar dimension with an unknown member.

    ``fiscal_year`` is the year the fiscal year ends in. The ``fiscal_quarter`` label carries the
    year it starts in, or the ending year with ``label_year='end'``.
    """
    d, month = F.col("d"), F.month("d")
    fiscal_shift = F.add_months(d, 1 - FISCAL_START)  # first fiscal month becomes January
    starting_year = F.year(fiscal_shift)
    label = starting_year if label_year == "start" else starting_year + 1
    holiday = F.lit(None).cast("string")
    for code, name in HOLIDAYS.items():
        holiday = F.when(month * 100 + F.dayofmonth(d) == code, F.lit(name)).otherwise(holiday)
    calendar = days(spark, start, stop, "d").select(
        date_key(d).alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.weekofyear(d).alias("iso_week"),
        (starting_year + 1).alias("fiscal_year"),
        F.concat(F.lit("FY"), F.right(label.cast("string"), F.lit(2)), F.lit("-Q"), F.quarter(fiscal_shift)).alias("fiscal_quarter"),
        holiday.isNotNull().alias("is_holiday"),
        holiday.alias("holiday_name"),
    )
    return with_unknown(calendar, UNKNOWN_DATE)


def with_unknown(dim: DataFrame, member: dict[str, object]) -> DataFrame:
    """Append the fallback row that NULL and unmatched keys point to."""
    row = dim.sparkSession.range(1).select(
        *[F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema]
    )
    return dim.unionByName(row)


def assign_keys(naturals: DataFrame, natural: Sequence[str], key: str, existing: DataFrame | None = None, *, slices: int | None = None) -> DataFrame:
    """Stable integer keys: natural keys of ``existing`` keep theirs, new ones continue after the maximum.

    New keys are numbered in natural-key order over range slices, so the result does not depend on
    partitioning and is the same when the job runs again. Returns (natural..., key) for all.
    """
    fresh = naturals.select(*natural).distinct()
    if existing is None:
        return number_rows(fresh, [], list(natural), key, slices=slices)
    known = existing.filter(F.col(key) > 0).select(*natural, F.col(key).cast("bigint").alias(key))
    top = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("__top"))
    same = all_equal(None, natural, "f", "k")
    unseen = fresh.alias("f").join(known.alias("k"), same, "left_anti")
    numbered = number_rows(unseen, [], list(natural), "__rn", slices=slices)
    keyed = attach(numbered, top)
    return known.unionByName(keyed.select(*natural, (F.col("__top") + F.col("__rn")).cast("bigint").alias(key)))


#: Hash buckets that keys are numbered in; part of what a key is, so never changed for a table once loaded.
BUCKETS = 1024


def number_by_bucket(df: DataFrame, natural: Sequence[str], out: str, *, bucket: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Dense numbers from 1 for rows that are unique in ``natural``, without sorting the table.

    Two passes over hash buckets: count each one (one row a bucket), add the counts up to the bucket's first number, and
    number the rows of each bucket where they lie. Buckets are even, as ``natural`` is unique. Numbers depend on the
    rows alone, not on how they are partitioned.
    """
    place = F.pmod(F.xxhash64(*natural), F.lit(buckets)) if bucket is None else bucket
    placed = cut(df.withColumn("__bucket", place.cast("bigint")))
    counts = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    offsets = counts.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = Window.partitionBy("__bucket").orderBy(*order_columns(list(natural)))
    numbered = placed.withColumn("__place", F.row_number().over(local)).join(F.broadcast(offsets), "__bucket")
    return numbered.select(*df.columns, (F.col("__before") + F.col("__place")).cast("bigint").alias(out))


def assign_keys_by_bucket(
    naturals: DataFrame, natural: Sequence[str], key: str, existing: DataFrame | None = None, *, bucket: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """As ``assign_keys``, with new keys in the order of hash buckets: nothing is sampled or sorted over all rows.
    Keys stay dense, known ones stay as they are, and a rerun gives the same."""
    fresh = naturals.select(*natural).distinct()
    if existing is None:
        return number_by_bucket(fresh, natural, key, bucket=bucket, buckets=buckets)
    known = existing.filter(F.col(key) > 0).select(*natural, F.col(key).cast("bigint").alias(key))
    top = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("__top"))
    unseen = fresh.alias("f").join(known.alias("k"), all_equal(None, natural, "f", "k"), "left_anti")
    keyed = attach(number_by_bucket(unseen, natural, "__rn", bucket=bucket, buckets=buckets), top)
    return known.unionByName(keyed.select(*natural, (F.col("__top") + F.col("__rn")).cast("bigint").alias(key)))


def load_dimension(stored: DataFrame, rows: DataFrame, natural: Sequence[str], key: str, *, member: dict[str, object] | None = None) -> DataFrame:
    """The next state of a dimension: rows that are known keep their key and take the new attributes, new ones get keys
    behind the last, and stored ones that ``rows`` lacks stay as they are. ``member`` adds the unknown member to a
    first load; a stored one (key below 1) is kept."""
    keys = assign_keys(rows, natural, key, stored)
    fresh = _join_keys(rows, keys, natural).select(*stored.columns)
    same = all_equal(None, natural, "s", "r")
    kept = stored.alias("s").filter(F.col(f"s.{key}") > 0).join(rows.alias("r"), same, "left_anti").select(*stored.columns)
    loaded = fresh.unionByName(kept).unionByName(stored.filter(F.col(key) < 1))
    return loaded if member is None else with_unknown(loaded.filter(F.col(key) > 0), member)


def lookup_key(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], key: str, out: str, carry: dict[str, str] | None = None) -> DataFrame:
    """Replace natural keys by the dimension's surrogate key; no match gives -1.

    ``carry`` maps further dimension columns to output names (NULL without a match).
    """
    view = dim.select(
        *[F.col(d).alias(f"__d{i}") for i, (_, d) in enumerate(on)], F.col(key).alias("__sk"),
        *[F.col(c).alias(o) for c, o in (carry or {}).items()],
    )
    condition = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"__d{i}") for i, (f, _) in enumerate(on)])
    joined = fact.join(view, condition, "left").withColumn(out, F.coalesce(F.col("__sk"), F.lit(-1)).cast("bigint"))
    return joined.drop("__sk", *[f"__d{i}" for i in range(len(on))])


def find_keys(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], key: str, into: str, carry: dict[str, str] | None = None) -> DataFrame:
    """``lookup_key`` for rows that must stay single until later steps are done, as numbering them: what the dimension has
    for a row is one array column ``into``, however often a natural key occurs there. ``settle_keys`` ends it."""
    names = [f"__d{i}" for i in range(len(on))]
    found = F.struct(F.col(key).alias("sk"), *[F.col(c).alias(o) for c, o in (carry or {}).items()])
    view = dim.groupBy(*[F.col(d).alias(n) for n, (_, d) in zip(names, on)]).agg(F.collect_list(found).alias(into))
    condition = reduce(lambda a, b: a & b, [F.col(f) == F.col(n) for n, (f, _) in zip(names, on)])
    return fact.join(view, condition, "left").drop(*names)


def settle_keys(fact: DataFrame, into: str, out: str, carry: Sequence[str] = ()) -> DataFrame:
    """The rows of ``find_keys`` as ``lookup_key`` gives them: one for each match, or one with -1."""
    each = fact.withColumn("__found", F.explode_outer(into)).drop(into)
    key = F.coalesce(F.col("__found.sk"), F.lit(-1)).cast("bigint")
    return each.withColumns({out: key} | {c: F.col(f"__found.{c}") for c in carry}).drop("__found")


def best_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One preferred row per key (default address first, then newest)."""
    return nth_rows(df, keys, order_by)


def _rank_key(df: DataFrame, order_by: Sequence[str]) -> Column:
    """A struct whose smallest value belongs to the first row in ``order_by`` (NULL last ascending, first descending)."""
    parts, types = [], dict(df.dtypes)
    for i, name in enumerate(order_by):
        down, column = name.startswith("-"), name.lstrip("-")
        value, kind = F.col(column), types[column]
        if down:
            if kind == "boolean":
                value = ~value
            elif kind == "date":
                value = -F.unix_date(value)
            elif kind in ("timestamp", "timestamp_ntz"):
                value = -F.unix_micros(value.cast("timestamp"))
            elif kind == "string" or kind.startswith(("array", "struct", "map", "binary")):
                raise TypeError(f"{column} of type {kind} cannot be ordered downwards in an aggregate")
            else:
                value = -value
        parts += [(F.col(column).isNotNull() if down else F.col(column).isNull()).alias(f"n{i}"), value.alias(f"v{i}")]
    return F.struct(*parts)


def best_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """As ``best_row``, by one aggregate: each task keeps its best row a key, so a key with many rows costs nothing, and no
    row is sorted. ``order_by`` ends in a unique column."""
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), _rank_key(df, order_by)).alias("__best"))
    return picked.select(*keys, "__best.*")


def with_best(
    rows: DataFrame, details: DataFrame, on: Sequence[tuple[str, str]], default: Column, newest: Sequence[str], columns: dict[str, object], chosen: str
) -> DataFrame:
    """Attach the best detail row of each row: the default one, else the newest, else none.

    ``on`` pairs columns of both sides; ``columns`` maps detail columns to what stands in for them without a detail;
    ``chosen`` says which it was: ``default``, ``newest`` or ``none``. Details without a key belong to no row.
    """
    keys = [d for _, d in on]
    ranked = details.na.drop(subset=keys).withColumn("__default", F.coalesce(default, F.lit(False)))
    best = best_per_key(ranked, keys, ["-__default", *newest], ["__default", *columns])
    best = best.select(*[F.col(d).alias(f"__k{i}") for i, d in enumerate(keys)], "__default", *[F.col(x).alias(f"__x{i}") for i, x in enumerate(columns)])
    joined = rows.join(best, reduce(lambda a, b: a & b, [F.col(r) == F.col(f"__k{i}") for i, (r, _) in enumerate(on)]), "left")
    how = F.when(F.col("__default").isNull(), "none").when(F.col("__default"), "default").otherwise("newest")
    values = [F.coalesce(F.col(f"__x{i}"), F.lit(stand_in)).alias(x) for i, (x, stand_in) in enumerate(columns.items())]
    return joined.select(*rows.columns, *values, how.alias(chosen))


def role_view(dim: DataFrame, role: str) -> DataFrame:
    """The calendar under a role name: ``order`` gives order_date_key, order_date, order_year, ..."""
    names = {
        "date_key": f"{role}_date_key", "calendar_date": f"{role}_date", "year": f"{role}_year",
        "quarter_name": f"{role}_quarter", "month_name": f"{role}_month", "year_month": f"{role}_year_month",
        "is_weekend": f"{role}_is_weekend", "is_holiday": f"{role}_is_holiday",
    }
    return dim.select(*[F.col(c).alias(o) for c, o in names.items()])


def snowflaked(dim: DataFrame, column: str, sub_key: str, **options) -> tuple[DataFrame, DataFrame]:
    """Split a repeated attribute off into a keyed sub-dimension: (sub_dim, dim with its key)."""
    sub = assign_keys(dim.filter(F.col(column).isNotNull()), [column], sub_key, **options)
    return sub, dim.join(sub, column, "left").drop(column)


def allocate(
    lines: DataFrame,
    header: Sequence[str],
    weight: str,
    amounts: dict[str, str],
    *,
    residual: str = "none",
    tie_break: Sequence[str] = (),
    bounded: bool = False,
) -> DataFrame:
    """Prorate header amounts (repeated on every line) to the lines by ``weight``.

    ``amounts`` maps a header amount column to its output. Shares are rounded to cents per line;
    with ``residual='largest'`` the cents lost or gained go to the line with the largest weight
    (first in ``tie_break``), so lines add up to the header. Headers without positive weight
    allocate 0. ``bounded=True`` states that a header has few lines: they are then summed where they lie, and the
    lines neither read twice nor shuffled again if they were joined by ``header``.
    """
    total = F.sum(weight)
    if bounded:
        joined = lines.withColumn("__sum", total.over(Window.partitionBy(*header)).cast("decimal(24,4)"))
    else:
        joined = _join_keys(lines, lines.groupBy(*header).agg(total.cast("decimal(24,4)").alias("__sum")), list(header))
    # Twenty digits of share times the amount fit one decimal, so only the result is rounded.
    share = (F.col(weight).cast("decimal(24,10)") / F.nullif(F.col("__sum"), F.lit(0).cast("decimal(24,4)"))).cast("decimal(23,20)")
    zero = F.lit(0).cast("decimal(14,2)")
    columns = {
        out: F.when(F.col("__sum") > 0, F.round(share * F.col(amount).cast("decimal(14,2)"), 2)).otherwise(zero).cast("decimal(14,2)")
        for amount, out in amounts.items()
    }
    allocated = joined.withColumns(columns)
    if residual == "none":
        return allocated.select(*lines.columns, *amounts.values())
    if not tie_break:
        raise ValueError("residual='largest' needs a tie_break that is unique within a header")
    gaps = allocated.filter("__sum > 0").groupBy(*header).agg(
        *[(F.max(F.col(a).cast("decimal(14,2)")) - F.sum(o)).alias(f"__gap_{o}") for a, o in amounts.items()]
    )
    picked = nth_rows(allocated.select(*header, weight, *tie_break), header, [f"-{weight}", *tie_break])
    names = [*header, weight, *tie_break]
    largest = picked.join(gaps, list(header)).select(*names, *[f"__gap_{o}" for o in amounts.values()])
    same_row = all_equal(None, names, "a", "b")
    fixed = allocated.alias("a").join(largest.alias("b"), same_row, "left")
    return fixed.select(
        *[F.col(f"a.{c}") for c in lines.columns],
        *[(F.col(f"a.{o}") + F.coalesce(F.col(f"b.__gap_{o}"), zero)).cast("decimal(14,2)").alias(o) for o in amounts.values()],
    )


def accumulating(orders: DataFrame, milestones: DataFrame, key: str, ordered_at: str, shipped_at: str, delivered_at: str, due_at: str) -> DataFrame:
    """One row per order with milestone date keys, lags in days and flags.

    ``milestones`` has at most one row per ``key``; a milestone not reached has key -1 and NULL lag.
    """
    joined = orders.join(milestones, key, "left")
    placed, shipped, delivered = (F.col(c) for c in (ordered_at, shipped_at, delivered_at))
    return joined.withColumns(
        {
            "order_date_fk": date_key(placed),
            "shipped_date_fk": date_key(shipped),
            "delivered_date_fk": date_key(delivered),
            "days_to_ship": days_between(shipped, placed),
            "days_in_transit": days_between(delivered, shipped),
            "total_delivery_days": days_between(delivered, placed),
            "is_delivered": delivered.isNotNull(),
            "is_delayed": F.coalesce(delivered > F.col(due_at), F.lit(False)),
        }
    )


def periodic_snapshot(
    daily: DataFrame, entity: str, day: str, value: str, last_day: str | None = None, out: str = "balance", **options
) -> DataFrame:
    """One row per entity and calendar day up to ``last_day`` (default: the last day there is), carrying the last
    known value forward.

    Days before an entity's first value have no row. ``daily`` has at most one row per entity and day.
    """
    spans = daily.groupBy(entity).agg(F.min(day).alias("__first"))
    if last_day is None:
        spans = attach(spans, daily.agg(F.max(day).alias("__last")))
    else:
        spans = spans.withColumn("__last", F.lit(last_day).cast("date")).filter("__first <= __last")
    grid = spans.select(entity, F.explode(F.sequence("__first", "__last")).alias(day))
    filled = grid.join(daily, [entity, day], "left")
    return running(filled, [entity], [day], {out: ("last", F.col(value))}, **options).select(entity, day, out)


def drill_across(facts: dict[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """Combine facts already aggregated to the same conformed keys; a key missing in one gives 0."""
    joined = reduce(lambda a, b: a.join(b, list(on), "full"), facts.values())
    return joined.fillna(0, [c for c in joined.columns if c not in on])
