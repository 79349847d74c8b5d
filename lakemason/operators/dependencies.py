"""Which columns determine which: all minimal functional dependencies of a table, with their errors.

A set of columns splits the rows into groups of equal values. It determines another column if no group holds two
values of it; the error is the least share of rows whose removal makes that true (in each group all but those with
its most frequent value). Sets are tried by size, smallest first. What a set determines is not tried again for
larger ones, and rows alone in their group are alone in every finer one, so they are left out of all later levels:
each level works on what the one before could not tell apart. Rows equal in all columns are counted once, first.

NULL is a value like others. The driver holds one number for each candidate (a set and a column), never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemason.session import cut


def _cells(columns: Sequence[str]) -> Column:
    """The values as text, NULL told apart from every text."""
    return F.array(*[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in columns])


def counted_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``cells, n``: the distinct rows and how often each occurs."""
    return df.select(_cells(columns).alias("cells")).groupBy("cells").agg(F.count(F.lit(1)).alias("n"))


def _pick(cells: Column, places: Column) -> Column:
    return F.transform(places, lambda i: F.element_at(cells, i))


def dependencies(df: DataFrame, columns: Sequence[str], *, max_error: float = 0.0, max_size: int | None = None) -> DataFrame:
    """``determinant, dependent, error``: every minimal dependency whose error is at most ``max_error``.

    ``determinant`` is an array of column names in the order of ``columns``; it is empty for constant columns. Minimal
    means that no part of it determines the column within ``max_error``. ``max_size`` bounds the determinants.
    """
    spark, m = df.sparkSession, len(columns)
    rows = cut(counted_rows(df, columns))
    total = rows.agg(F.sum("n")).first()[0] or 0
    found: list[tuple[list[str], str, float]] = []
    determined: dict[int, list[frozenset[int]]] = {a: [] for a in range(m)}
    # rows still in question for each set of the last level: (set number, cells, n)
    level: list[tuple[int, ...]] = [()]
    open_rows = rows.select(F.lit(0).alias("set"), "cells", "n")
    for size in range((m - 1 if max_size is None else min(max_size, m - 1)) + 1):
        targets = {i: [a for a in range(m) if a not in s and not any(d <= set(s) for d in determined[a])] for i, s in enumerate(level)}
        asked = [(i, [c + 1 for c in s], [a + 1 for a in targets[i]]) for i, s in enumerate(level) if targets[i]]
        if not asked:
            break
        wanted = F.broadcast(spark.createDataFrame(asked, "set int, places array<int>, targets array<int>"))  # one row a set
        spread = open_rows.join(wanted, "set").select("set", _pick(F.col("cells"), F.col("places")).alias("key"), "cells", "n", F.explode("targets").alias("target"))
        values = spread.groupBy("set", "target", "key", F.element_at("cells", F.col("target")).alias("value")).agg(F.sum("n").alias("n"))
        groups = values.groupBy("set", "target", "key").agg((F.sum("n") - F.max("n")).alias("wrong"))
        wrong = {(r["set"], r.target - 1): r.wrong for r in groups.groupBy("set", "target").agg(F.sum("wrong").alias("wrong")).collect()}
        for i, s in enumerate(level):
            for a in targets[i]:
                error = wrong.get((i, a), 0) / total if total else 0.0
                if error <= max_error:
                    determined[a].append(frozenset(s))
                    found.append(([columns[c] for c in s], columns[a], error))
        # larger sets, each refined from one part of it
        bigger = [s for s in combinations(range(m), size + 1) if any(not any(d <= set(s) for d in determined[a]) for a in range(m) if a not in s)]
        number = {s: i for i, s in enumerate(level)}
        children = [(number[s[:-1]], i, [c + 1 for c in s]) for i, s in enumerate(bigger) if s[:-1] in number]
        # a set whose first part was given up starts from all rows
        fresh = [(i, [c + 1 for c in s]) for i, s in enumerate(bigger) if s[:-1] not in number]
        if not bigger or size == (m - 1 if max_size is None else max_size):
            break
        kind = "set int, child int, places array<int>"
        refined = open_rows.join(F.broadcast(spark.createDataFrame(children, kind)), "set").drop("set") if children else None
        if fresh:
            sets = F.array(*[F.struct(F.lit(i).alias("child"), F.array(*map(F.lit, p)).alias("places")) for i, p in fresh])
            whole = rows.select("cells", "n", F.explode(sets).alias("c")).select("cells", "n", "c.*")
            refined = whole if refined is None else refined.unionByName(whole)
        keyed = refined.select(F.col("child").alias("set"), "cells", "n", _pick(F.col("cells"), F.col("places")).alias("key"))
        # stripped: groups of one distinct row can never disagree
        shared = keyed.groupBy("set", "key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
        open_rows = cut(keyed.join(shared, ["set", "key"], "left_semi").select("set", "cells", "n"))
        level = bigger
    return spark.createDataFrame(found, "determinant array<string>, dependent string, error double")


def joint_common_values(df: DataFrame, columns: Sequence[str], k: int, size: int = 2) -> DataFrame:
    """The ``k`` most frequent value combinations of every ``size`` of the columns, with the share of rows they have and the
    share they would have if the columns were independent: ``column_names, value_rank, items, row_count, frequency,
    independent_frequency``. ``items`` holds the values as text, NULL as NULL."""
    rows = cut(counted_rows(df, columns))
    total = rows.agg(F.sum("n").alias("all"))
    groups = F.array(*[F.struct(F.lit(",".join(columns[i] for i in s)).alias("column_names"), F.array(*[F.lit(i + 1) for i in s]).alias("places")) for s in combinations(range(len(columns)), size)])
    spread = rows.select(F.explode(groups).alias("g"), "cells", "n")
    joint = spread.groupBy("g.column_names", "g.places", _pick(F.col("cells"), F.col("g.places")).alias("items")).agg(F.sum("n").alias("row_count"))
    order = Window.partitionBy("column_names").orderBy(F.col("row_count").desc(), "items")
    top = joint.withColumn("value_rank", F.row_number().over(order)).filter(F.col("value_rank") <= k)
    single = rows.select(F.posexplode("cells").alias("place", "cell"), "n").groupBy("place", "cell").agg(F.sum("n").alias("m"))
    parts = top.select("*", F.explode(F.arrays_zip("places", F.col("items").alias("cell"))).alias("p"))
    parts = parts.join(single, (F.col("p.places") == F.col("place") + 1) & (F.col("p.cell") == F.col("cell")))
    every = parts.select("column_names", "value_rank", "items", "row_count", (F.col("m") / total.scalar()).alias("share"))
    out = every.groupBy("column_names", "value_rank", "items", "row_count").agg(F.product("share").alias("independent_frequency"))
    text = F.transform("items", lambda x: F.when(x != "", F.substring(x, 2, 1 << 30)))
    return out.select(
        "column_names", "value_rank", text.alias("items"), "row_count", F.round(F.col("row_count") / total.scalar(), 6).alias("frequency"),
        F.round("independent_frequency", 6).alias("independent_frequency"))
