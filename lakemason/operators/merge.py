"""MERGE and upserts on immutable files: each returns the full new state of the target.

Keys are unique on both sides, so the full outer join behind every change has no hot key. A source
that repeats a key is an error (as it is in SQL) unless it is deduplicated first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.functions.columns import any_differs
from lakemason.operators.ordered import nth_rows


@dataclass(frozen=True)
class Matched:
    """Clause for rows on both sides. ``set=None`` deletes the target row.

    Expressions may use ``target.x`` and ``source.x``. ``when=None`` matches always.
    """

    set: dict[str, Column] | None
    when: Column | None = None


@dataclass(frozen=True)
class NotMatched:
    """Clause for source rows without a target: the values to insert."""

    values: dict[str, Column]
    when: Column | None = None


@dataclass(frozen=True)
class _Action:
    code: int
    clause: Matched | NotMatched
    test: Column = field(compare=False)


def unique_source(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Same rows, but the query fails as soon as a key occurs twice. The check is a filter, so no reader can leave it out."""
    rest = [c for c in source.columns if c not in on]
    message = F.concat(F.lit("duplicate key in source: "), F.to_json(F.struct(*on)))
    grouped = source.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(F.lit(1).alias("__one"), *rest)).alias("__row"))
    checked = grouped.filter(F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(*on, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*source.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last row per key in ``order_by``: the cure for at-least-once delivery."""
    return nth_rows(df, keys, [n[1:] if n.startswith("-") else f"-{n}" for n in order_by])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return nth_rows(df, keys, order_by)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[Matched] = (),
    not_matched: Sequence[NotMatched] = (),
    *,
    check_source: bool = True,
    grouped_by: Sequence[str] = (),
) -> DataFrame:
    """SQL MERGE: the first clause whose condition holds decides what happens to a row.

    Keys are compared with ``=``, as in SQL: a row whose key is NULL matches none, so it is inserted again by each replay.
    ``grouped_by`` names those of the keys by which both sides were joined or windowed before, with few rows a group:
    the other keys are then compared within the group, and neither side is shuffled or sorted for the merge.
    """
    if check_source:
        source = unique_source(source, on)
    t = target.withColumn("__t", F.lit(True)).alias("target")
    s = source.withColumn("__s", F.lit(True)).alias("source")
    pairs = {k: (F.col(f"target.{k}"), F.col(f"source.{k}")) for k in on}
    # Spark joins, and so shuffles, by every column that is tested with =; it does not by those tested with BETWEEN.
    condition = reduce(lambda a, b: a & b, [a == b if not grouped_by or k in grouped_by else a.between(b, b) for k, (a, b) in pairs.items()])
    in_target, in_source = F.col("target.__t").isNotNull(), F.col("source.__s").isNotNull()

    actions = [_Action(i + 1, c, in_target & in_source) for i, c in enumerate([*matched])]
    actions += [_Action(len(actions) + i + 1, c, ~in_target & in_source) for i, c in enumerate([*not_matched])]
    chosen = F.lit(0)
    for action in reversed(actions):
        test = action.test if action.clause.when is None else action.test & F.coalesce(action.clause.when, F.lit(False))
        chosen = F.when(test, F.lit(action.code)).otherwise(chosen)

    deletes = [a.code for a in actions if isinstance(a.clause, Matched) and a.clause.set is None]
    joined = t.join(s, condition, "full").withColumn("__do", chosen)
    kept = joined.filter(F.when(in_target, ~F.col("__do").isin(deletes) if deletes else F.lit(True)).otherwise(F.col("__do") > 0))

    def output(name: str) -> Column:
        value = F.col(f"target.{name}")
        data_type = target.schema[name].dataType
        for action in actions:
            if isinstance(action.clause, NotMatched):
                new = action.clause.values.get(name, F.lit(None))
            elif action.clause.set is not None and name in action.clause.set:
                new = action.clause.set[name]
            else:
                continue
            value = F.when(F.col("__do") == action.code, new.cast(data_type)).otherwise(value)
        return value.alias(name)

    return kept.select(*[output(c) for c in target.columns])


def _source(name: str) -> Column:
    return F.col(f"source.{name}")


def _insert(target: DataFrame, source: DataFrame, defaults: dict[str, Column]) -> NotMatched:
    values = {c: _source(c) for c in target.columns if c in source.columns}
    return NotMatched({**defaults, **values})


def upsert_ignore(
    target: DataFrame, source: DataFrame, on: Sequence[str], order_by: Sequence[str] | None = None,
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys, leave existing ones alone. A key repeated in the batch keeps its first row
    in ``order_by``. The target is not rewritten row by row: new rows are appended to it."""
    fresh = source.join(target.select(*on), list(on), "left_anti")
    fresh = first_per_key(fresh, on, order_by) if order_by else unique_source(fresh, on)
    types = {f.name: f.dataType for f in target.schema}
    added = fresh.withColumns({c: v for c, v in (defaults or {}).items() if c not in fresh.columns})
    added = added.withColumns({c: F.lit(None).cast(types[c]) for c in target.columns if c not in added.columns})
    return target.unionByName(added.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns]))


def upsert_replace(
    target: DataFrame, source: DataFrame, on: Sequence[str], update: Sequence[str], *,
    defaults: dict[str, Column] | None = None, check_source: bool = True, grouped_by: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys, overwrite the listed columns of existing ones."""
    return merge(
        target, source, on, [Matched({c: _source(c) for c in update})],
        [_insert(target, source, defaults or {})], check_source=check_source, grouped_by=grouped_by,
    )


def upsert_changed(
    target: DataFrame, source: DataFrame, on: Sequence[str], update: Sequence[str], tracked: Sequence[str], *,
    null_safe: bool = False, defaults: dict[str, Column] | None = None, check_source: bool = True,
) -> DataFrame:
    """As :func:`upsert_replace`, but a row whose tracked columns are equal is not written.

    With ``null_safe=False`` a comparison with NULL never counts as a change (SQL ``<>``).
    """
    changed = any_differs([(F.col(f"target.{c}"), _source(c)) for c in tracked], null_safe)
    return merge(
        target, source, on, [Matched({c: _source(c) for c in update}, changed)],
        [_insert(target, source, defaults or {})], check_source=check_source,
    )


def upsert_add(
    target: DataFrame, source: DataFrame, on: Sequence[str], add: Sequence[str], replace: Sequence[str] = (), *,
    latest: Sequence[str] = (), check_source: bool = True,
) -> DataFrame:
    """Accumulate measures on existing keys; ``latest`` columns keep the larger value, ``replace``
    columns the source's. Not idempotent: guard it with a batch ledger (``SnapshotTable.apply_once``)."""
    changes = {c: F.col(f"target.{c}") + _source(c) for c in add} | {c: _source(c) for c in replace}
    changes |= {c: F.greatest(F.col(f"target.{c}"), _source(c)) for c in latest}
    return merge(target, source, on, [Matched(changes)], [_insert(target, source, {})], check_source=check_source)


def batch_totals(batch: DataFrame, on: Sequence[str], measures: dict[str, Column], latest: Column, latest_out: str) -> DataFrame:
    """Sum a batch per key and keep its latest event time."""
    return batch.groupBy(*on).agg(*[F.sum(c).alias(o) for o, c in measures.items()], F.max(latest).alias(latest_out))


def delete_cascade(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, doomed: Column) -> tuple[DataFrame, DataFrame]:
    """Remaining parents and children after deleting ``doomed`` parents with ON DELETE CASCADE."""
    gone = parents.filter(doomed).select(F.col(parent_key).alias("__gone"))
    left = parents.filter(~F.coalesce(doomed, F.lit(False)))
    return left, children.join(gone, F.col(child_key) == F.col("__gone"), "left_anti")
