"""Slowly changing dimensions, types 0 to 3."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.functions.columns import any_differs, differs
from lakemason.operators.merge import Matched, NotMatched, latest_per_key, merge, upsert_ignore, upsert_replace
from lakemason.operators.ordered import framed, must_split

#: Fixed value: the open end of a version.
OPEN_END = "9999-12-31 23:59:59"


def scd0(dim: DataFrame, incoming: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep the original: known keys never change."""
    return upsert_ignore(dim, incoming, [key], order_by)


def scd1(dim: DataFrame, incoming: DataFrame, key: str, update: Sequence[str]) -> DataFrame:
    """Overwrite the listed attributes."""
    return upsert_replace(dim, incoming, [key], update)


def scd2(
    dim: DataFrame,
    changes: DataFrame,
    key: str,
    tracked: Sequence[str],
    changed_at: str,
    tie_break: Sequence[str] = (),
    *,
    null_safe: bool = False,
    insert_new: bool = True,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Add a version per change; ``dim`` carries ``valid_from``, ``valid_to`` and ``is_current``.

    Existing versions of the touched keys and the batch form one timeline per key. A change equal
    to the row before it is a no-op and leaves no version, so a replayed batch changes nothing; a
    key may change several times in one batch; a late change is placed where it belongs. Versions
    of other keys pass through untouched. Two changes of a key at one instant need ``tie_break``;
    the last of them wins.
    """
    attributes = [c for c in dim.columns if c not in (key, "valid_from", "valid_to", "is_current")]
    types = {f.name: f.dataType for f in dim.schema}
    open_end = F.lit(OPEN_END).cast(types["valid_to"])
    batch_keys = changes.select(F.col(key)).distinct()
    untouched = dim.join(batch_keys, key, "left_anti")
    touched = dim.join(batch_keys, key, "left_semi")
    ties = [c for c in tie_break if c not in dim.columns]

    stored = touched.select(
        key, *attributes, "valid_from", "valid_to", F.lit(0).alias("__new"),
        *[F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in ties],
    )
    batch = changes if insert_new else changes.join(dim.select(key).distinct(), key, "left_semi")
    fresh = batch.select(
        key, *[(F.col(c) if c in changes.columns else F.lit(None)).cast(types[c]).alias(c) for c in attributes],
        F.col(changed_at).cast(types["valid_from"]).alias("valid_from"), open_end.alias("valid_to"),
        F.lit(1).alias("__new"), *[F.col(c) for c in ties],
    )
    timeline = stored.unionByName(_last_per_instant(fresh, key, tie_break))
    versions = _versions(timeline, key, tracked, open_end, null_safe, max_group_rows)
    result = versions.select(
        *[F.col(c) if c != "is_current" else (F.col("valid_to") == open_end).alias("is_current") for c in dim.columns]
    )
    return untouched.unionByName(result)


def _last_per_instant(changes: DataFrame, key: str, tie_break: Sequence[str]) -> DataFrame:
    """Of several changes of a key at one instant, the last one counts."""
    if not tie_break:
        return changes
    return latest_per_key(changes, [key, "valid_from"], list(tie_break))


def _versions(
    timeline: DataFrame, key: str, tracked: Sequence[str], open_end: Column, null_safe: bool, max_group_rows: int | None
) -> DataFrame:
    """Drop the no-ops of a timeline and close each version where the next one starts.

    ``timeline`` has ``valid_from``, ``valid_to`` and ``__new`` (0 stored version, 1 change), and at
    most one row of each kind per key and instant. All steps share one shuffle and one sort.
    """
    order = ["valid_from", "__new"]
    # Measured once; dropping rows only makes groups smaller.
    split = must_split(timeline, [key], max_group_rows, False)
    options = {"max_group_rows": 0} if split else {"bounded": True}
    previous = [f"__p_{c}" for c in tracked]

    def without_no_ops(df: DataFrame) -> DataFrame:
        compared = framed(
            df, [key], order, before=1, **options,
            columns=lambda w: {p: F.lag(c).over(w) for p, c in zip(previous, tracked)} | {"__known": F.lag(F.lit(1)).over(w)},
        )
        changed = any_differs([(F.col(c), F.col(p)) for c, p in zip(tracked, previous)], null_safe)
        return compared.filter((F.col("__new") == 0) | F.col("__known").isNull() | changed).drop("__known", *previous)

    def with_next(df: DataFrame) -> DataFrame:
        return framed(df, [key], order, lambda w: {"__next": F.lead("valid_from").over(w)}, after=1, **options)

    kept = with_next(without_no_ops(timeline))
    # A stored version changed at its own start is overridden; its successor may now be a no-op.
    standing = kept.filter(F.col("__next").isNull() | (F.col("valid_from") < F.col("__next"))).drop("__next")
    closed = with_next(without_no_ops(standing))
    return closed.withColumn("valid_to", F.least(F.col("valid_to"), F.coalesce(F.col("__next"), open_end)))


def history(
    events: DataFrame, key: str, tracked: Sequence[str], at: str, tie_break: Sequence[str], *,
    null_safe: bool = True, max_group_rows: int | None = None,
) -> DataFrame:
    """Type-2 versions of a whole change log: the initial load of :func:`scd2`."""
    open_end = F.lit(OPEN_END).cast(events.schema[at].dataType)
    changes = events.select(
        key, *tracked, *tie_break, F.col(at).alias("valid_from"), open_end.alias("valid_to"), F.lit(1).alias("__new")
    )
    versions = _versions(_last_per_instant(changes, key, tie_break), key, tracked, open_end, null_safe, max_group_rows)
    return versions.select(key, *tracked, "valid_from", "valid_to", (F.col("valid_to") == open_end).alias("is_current"))


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def as_of_time(dim: DataFrame, moment: Column) -> DataFrame:
    """Versions valid at ``moment``: ``valid_from <= moment < valid_to``."""
    return dim.filter((F.col("valid_from") <= moment) & (moment < F.col("valid_to")))


def scd3(dim: DataFrame, incoming: DataFrame, key: str, column: str, previous: str, stamp: str | None = None, *, null_safe: bool = False) -> DataFrame:
    """On change, shift the current value to ``previous``; new keys start without one."""
    changed = differs(F.col(f"target.{column}"), F.col(f"source.{column}"), null_safe)
    updates = {previous: F.col(f"target.{column}"), column: F.col(f"source.{column}")}
    if stamp:
        updates[stamp] = F.col(f"source.{stamp}")
    inserted = {c: F.col(f"source.{c}") for c in dim.columns if c in incoming.columns}
    return merge(dim, incoming, [key], [Matched(updates, changed)], [NotMatched(inserted)])
