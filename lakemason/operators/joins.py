"""Joins. Physical choice is left to Spark: it broadcasts by measured size and splits skewed
partitions at run time. What is done here is what the optimizer cannot do: shrink a side before
it is shuffled, and avoid plans that multiply rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.operators.ordered import attach, running, value_ranks


def _pairs(on: Sequence[str | tuple[str, str]]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in on]


def _matching_keys(right: DataFrame, pairs: list[tuple[str, str]]) -> tuple[DataFrame, Column]:
    """Distinct right keys under private names: copies vanish map-side, before the shuffle."""
    keys = right.select(*[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(pairs)]).distinct()
    condition = reduce(lambda a, b: a & b, [F.col(l) == F.col(f"__k{i}") for i, (l, _) in enumerate(pairs)])
    return keys, condition


def exists_in(left: DataFrame, right: DataFrame, on: Sequence[str | tuple[str, str]]) -> DataFrame:
    """EXISTS: left rows with at least one match, never duplicated."""
    keys, condition = _matching_keys(right, _pairs(on))
    return left.join(keys, condition, "left_semi")


def not_exists_in(left: DataFrame, right: DataFrame, on: Sequence[str | tuple[str, str]]) -> DataFrame:
    """NOT EXISTS: left rows without a match; a NULL key never matches, so it stays."""
    keys, condition = _matching_keys(right, _pairs(on))
    return left.join(keys, condition, "left_anti")


def left_join_is_null(left: DataFrame, right: DataFrame, on: Sequence[str | tuple[str, str]]) -> DataFrame:
    """The LEFT JOIN ... IS NULL spelling of :func:`not_exists_in`."""
    keys, condition = _matching_keys(right, _pairs(on))
    return left.join(keys.withColumn("__hit", F.lit(True)), condition, "left").filter(
        F.col("__hit").isNull()
    ).select(*left.columns)


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """SQL NOT IN with its NULL trap, without the forced broadcast of the right side.

    Any NULL on the right gives no rows; an empty right side keeps everything; otherwise a NULL
    left key is dropped. The trap is decided by one aggregated row.
    """
    facts = right.agg(
        F.count(F.lit(1)).alias("__rows"), F.count(F.when(F.col(right_key).isNull(), 1)).alias("__nulls")
    )
    kept = not_exists_in(left, right.filter(F.col(right_key).isNotNull()), [(left_key, right_key)])
    return (
        attach(kept, facts)
        .filter((F.col("__rows") == 0) | ((F.col("__nulls") == 0) & F.col(left_key).isNotNull()))
        .select(*left.columns)
    )


def check_not_in(right: DataFrame, right_key: str) -> DataFrame:
    """Can NOT IN over this column be rewritten as NOT EXISTS? One row with the NULL count."""
    nulls = F.count(F.when(F.col(right_key).isNull(), 1))
    return right.agg(nulls.alias("null_keys"), (nulls == 0).alias("rewrite_is_safe"))


def left_join_default(left: DataFrame, right: DataFrame, on: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """Left join; unmatched rows take ``defaults`` instead of NULL."""
    joined = left.join(right, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def preaggregated(parent: DataFrame, key: str, branches: Sequence[DataFrame], defaults: dict[str, object]) -> DataFrame:
    """Join several one-to-many branches to their parent without multiplying rows.

    Each branch is already aggregated to one row per ``key``; measures missing for a parent
    become their default.
    """
    joined = reduce(lambda df, branch: df.join(branch, key, "left"), branches, parent)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def fanout_report(before: DataFrame, after: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Did a join multiply the grain? Row and key counts before and after, in one row."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    per_key = after.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
    a = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_after"),
        F.count(F.lit(1)).alias("keys_after"),
        F.count(F.when(F.col("n") > 1, 1)).alias("multiplied_keys"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_copies"),
    )
    return attach(b, a).withColumn("fans_out", F.col("rows_after") > F.col("keys_after"))


def count_below(df: DataFrame, keys: Sequence[str], order_by: str, out: str = "below", **options) -> DataFrame:
    """Per row, how many rows of its group come strictly before it in ``order_by``.

    The answer of a theta self-join that counts pairs, computed from ranks: no pair is built.
    """
    ranked = value_ranks(df, keys, [order_by], {"__rank": "rank"}, **options)
    return ranked.withColumn(out, (F.col("__rank") - 1).cast("bigint")).drop("__rank")


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str,
    valid_to: str | None = None,
    *,
    prefix: str = "",
    inner: bool = False,
    **options,
) -> DataFrame:
    """Attach the version valid at ``at``: ``valid_from <= at < valid_to``.

    Rows and versions share one timeline per key and the latest version is carried forward, so a
    hot key costs a sort, not rows x versions pairs. Versions of a key must not overlap. As in SQL, a
    NULL time or key has no version.
    """
    carried_names = [c for c in versions.columns if c not in keys]
    version_row = F.struct(*[F.col(c) for c in carried_names])
    version_type = versions.select(version_row.alias("v")).schema["v"].dataType
    payload = F.struct(*[F.col(c) for c in rows.columns if c not in keys])
    payload_type = rows.select(payload.alias("p")).schema["p"].dataType
    timeline = rows.select(
        *keys, F.col(at).alias("__t"), F.lit(1).alias("__side"),
        payload.alias("__row"), F.lit(None).cast(version_type).alias("__version"),
    ).unionByName(
        versions.select(
            *keys, F.col(valid_from).alias("__t"), F.lit(0).alias("__side"),
            F.lit(None).cast(payload_type).alias("__row"), version_row.alias("__version"),
        )
    )
    carried = running(timeline, keys, ["__t", "__side"], {"__hit": ("last", F.col("__version"))}, **options)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.col("__t").isNotNull())
    if valid_to:
        known = known & (F.col("__t") < F.col(f"__hit.{valid_to}"))
    hit = F.when(known, F.col("__hit"))
    result = carried.filter((F.col("__side") == 1)).withColumn("__hit", hit)
    if inner:
        result = result.filter(F.col("__hit").isNotNull())
    return result.select(
        *keys, "__row.*", *[F.col(f"__hit.{c}").alias(prefix + c) for c in carried_names]
    )


def play_role(df: DataFrame, dim: DataFrame, dim_key: str, role_key: str, columns: dict[str, str]) -> DataFrame:
    """Join a shared dimension under one role: ``columns`` maps dimension column to output name.

    A NULL role key, and one the dimension does not have, is looked up as the unknown member -1.
    """
    view = dim.select(F.col(dim_key).alias("__role"), *[F.col(c).alias(out) for c, out in columns.items()])
    unknown = view.filter("__role = -1").agg(*[F.first(out).alias(f"__u_{out}") for out in columns.values()])
    joined = attach(df.join(view, F.col(role_key) == F.col("__role"), "left"), unknown)
    missing = F.col("__role").isNull()
    filled = [F.when(missing, F.col(f"__u_{out}")).otherwise(F.col(out)).alias(out) for out in columns.values()]
    return joined.select(*df.columns, *filled)
