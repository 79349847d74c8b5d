"""Order keys, exact money, safe ratios and NULL-aware comparison as plain Column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce
from json import dumps

from pyspark.sql import Column, functions as F


def order_names(order_by: Sequence[str]) -> list[str]:
    """Column names of an order list; a leading ``-`` marks descending keys."""
    return [name.lstrip("-") for name in order_by]


def order_columns(order_by: Sequence[str]) -> list[Column]:
    """Sort expressions with NULL placed last on ascending and first on descending keys."""
    return [
        F.col(name[1:]).desc_nulls_first() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order_by
    ]


def literal(value: object) -> Column:
    """A literal; a naive datetime becomes TIMESTAMP_NTZ, so no session time zone moves it and a
    comparison with an NTZ column needs no cast."""
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(" ")).cast("timestamp_ntz")
    return F.lit(value)


def utc_instant(column: str) -> Column:
    """Instant of a zoneless timestamp read as UTC (watermarks need instants)."""
    c = F.col(column)
    seconds = F.extract(F.lit("SECOND"), c)
    return F.make_timestamp_ltz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), seconds, F.lit("UTC"))


def money(column: str | Column, scale: int = 2) -> Column:
    """Exact decimal view of a floating amount, so that sums do not depend on row order."""
    value = F.col(column) if isinstance(column, str) else column
    return value.cast(f"decimal(18,{scale})")


def ratio(numerator: Column, denominator: Column, digits: int = 2, factor: int = 1) -> Column:
    """``numerator / denominator * factor`` rounded half up; NULL where the denominator is zero."""
    safe = F.nullif(denominator.cast("decimal(28,4)"), F.lit(0).cast("decimal(28,4)"))
    return F.round(numerator.cast("decimal(24,4)") * F.lit(factor) / safe, digits)


def differs(left: Column, right: Column, null_safe: bool) -> Column:
    """Has the value changed? Plain ``<>`` never fires on NULL; the null-safe form does."""
    return ~left.eqNullSafe(right) if null_safe else F.coalesce(left != right, F.lit(False))


def any_differs(pairs: Iterable[tuple[Column, Column]], null_safe: bool) -> Column:
    return reduce(lambda a, b: a | b, [differs(l, r, null_safe) for l, r in pairs], F.lit(False))


def all_equal(left: Column | None, names: Sequence[str], left_alias: str, right_alias: str) -> Column:
    """NULL-safe equality over ``names`` between two aliased sides."""
    tests = [F.col(f"{left_alias}.{n}").eqNullSafe(F.col(f"{right_alias}.{n}")) for n in names]
    return reduce(lambda a, b: a & b, tests, F.lit(True) if left is None else left)


def after_row(order_by: Sequence[str], values: Sequence[object]) -> Column:
    """Row comparison "comes after ``values`` in this order", written as OR-of-ANDs.

    A struct comparison is never pushed to the scan; this form is.
    """
    result: Column | None = None
    for name, value in reversed(list(zip(order_by, values))):
        column = F.col(name.lstrip("-"))
        past = column < literal(value) if name.startswith("-") else column > literal(value)
        result = past if result is None else past | ((column == literal(value)) & result)
    return result


def day_range(column: str, start: object, end: object) -> Column:
    """Half-open ``[start, end)`` test on an unwrapped column, so the scan can use it."""
    return (F.col(column) >= literal(start)) & (F.col(column) < literal(end))


def typed_equals(df, column: str, value: object) -> Column:
    """Equality with the literal cast to the column's type, never the column to the literal's.

    ``string_col = 5`` would cast every row and lose the scan filter.
    """
    return F.col(column) == F.lit(value).cast(df.schema[column].dataType)


def date_key(column: str | Column) -> Column:
    """``yyyymmdd`` integer key of a date or timestamp; NULL maps to the unknown member -1."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(
        F.year(value) * F.lit(10000) + F.month(value) * F.lit(100) + F.dayofmonth(value), F.lit(-1)
    ).cast("int")


def months(column: str | Column) -> Column:
    """``yyyy-MM`` label."""
    value = F.col(column) if isinstance(column, str) else column
    return F.date_format(value, "yyyy-MM")


def days_between(later: Column, earlier: Column) -> Column:
    """Elapsed days with two digits, NULL when either end is missing."""
    seconds = F.timestamp_diff("SECOND", earlier, later)
    return F.round(seconds.cast("decimal(18,0)") / F.lit(86400), 2)


def json_field(json: str | Column, key: str, type_name: str = "string") -> Column:
    """A top-level field of a JSON text as ``type_name``; NULL if the text is no JSON, the field is missing or does not convert."""
    value = F.col(json) if isinstance(json, str) else json
    return F.try_variant_get(F.try_parse_json(value), f"$['{key}']", type_name)


def json_contains(json: str | Column, fields: dict[str, str | int | bool]) -> Column:
    """Whether a JSON object holds all these fields with these values; 5 and "5" differ. NULL or broken JSON: false."""
    tests = [F.to_json(json_field(json, k, "variant")) == F.lit(dumps(v, ensure_ascii=False)) for k, v in fields.items()]
    tests = [F.coalesce(t, F.lit(False)) for t in tests]
    return reduce(Column.__and__, tests, F.lit(True))


def name_id(name: Column) -> Column:
    """A UUID (version 3 layout) that follows from a name: the same on each run, and on any engine that has MD5."""
    h = F.md5(name)
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-3"), F.substring(h, 14, 3), F.lit("-"), variant,
        F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))
