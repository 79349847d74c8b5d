"""Constraint checks and column profiles, each one aggregate pass with map-side pre-counting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemason.functions.columns import order_columns, ratio
from lakemason.operators.ordered import attach, running, value_ranks, with_totals


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionAll, parts)


_KINDS = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "bigint": "bigint", "float": "double", "double": "double",
          "string": "string", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp_ntz", "boolean": "boolean"}


def _key_type(child: str, parent: str) -> str:
    """The type that a foreign key and what it refers to are compared in; whole numbers and decimals up to 20 digits
    compare exactly with one another, with floating numbers as doubles."""
    a, b = (t if t.startswith("decimal") else _KINDS.get(t) for t in (child, parent))
    numbers = ("bigint", "double")
    if a == b and a is not None and not a.startswith("decimal"):
        return a
    if a and b and all(t in numbers or t.startswith("decimal") for t in (a, b)):
        return "double" if "double" in (a, b) else "decimal(38,18)"
    raise TypeError(f"a key of type {child} cannot refer to one of type {parent}")


def orphans(child: DataFrame, checks: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Foreign-key checks ``name -> (fk, parent, pk)`` of one table; orphan rows and PASS/FAIL per check.

    The child is read once for all checks whose keys have the same type. Keys are counted in their own type where they
    are read, so a key is shuffled at most once a task, and what is left is anti-joined to the parents. A NULL key refers
    to nothing and is no orphan. Keys of different types are compared in their common one; without one it is an error.
    """
    groups: dict[str, list[str]] = {}
    for name, (fk, parent, pk) in checks.items():
        groups.setdefault(_key_type(dict(child.dtypes)[fk], dict(parent.dtypes)[pk]), []).append(name)
    numbers = {name: i for i, name in enumerate(checks)}
    lost = []
    for kind, names in groups.items():
        cells = F.array(*[F.struct(F.lit(numbers[n]).alias("check"), F.col(checks[n][0]).cast(kind).alias("key")) for n in names])
        used = child.select(F.explode(cells).alias("cell")).select("cell.*").filter("key IS NOT NULL").groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))
        known = reduce(DataFrame.unionAll, [checks[n][1].select(F.lit(numbers[n]).alias("check"), F.col(checks[n][2]).cast(kind).alias("key")) for n in names])
        lost.append(used.join(known, ["check", "key"], "left_anti").select("check", "n"))
    sums = reduce(DataFrame.unionAll, lost).agg(*[F.coalesce(F.sum(F.when(F.col("check") == i, F.col("n"))), F.lit(0)).alias(n) for n, i in numbers.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("orphans")) for n in checks]))
    return sums.select(pairs.alias("p")).select(
        "p.*", F.when(F.col("p.orphans") == 0, "PASS").otherwise("FAIL").alias("status")
    )


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows (PRIMARY KEY / UNIQUE / grain)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """CHECK rules in one pass: failing rows per rule; a NULL outcome passes, as in SQL."""
    failed = df.agg(*[F.count(F.when(~rule, 1)).alias(name) for name, rule in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule_name"), F.col(n).alias("violations")) for n in rules]))
    return failed.select(pairs.alias("p")).select(
        "p.*", F.when(F.col("p.violations") == 0, "PASS").otherwise("FAIL").alias("status")
    )


def overlaps(df: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str, tie_break: Sequence[str], **options) -> DataFrame:
    """Rows whose period starts before an earlier period of the same key has ended."""
    order = [valid_from, *tie_break]
    earlier = running(df, keys, order, {"__earlier": ("max", F.col(valid_to))}, inclusive=False, **options)
    return earlier.filter(F.col(valid_from) < F.col("__earlier")).select(*df.columns)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for several columns in one scan and one shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("cell")).groupBy("cell.column_name", "cell.value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL share, distinct values and average text width per column, exactly."""
    n = F.col("n")
    known = F.col("value").isNotNull()
    return value_counts(df, columns).groupBy("column_name").agg(
        F.sum(n).alias("row_count"),
        ratio(F.sum(F.when(known, 0).otherwise(n)), F.sum(n), 4).alias("null_frac"),
        F.count(F.when(known, 1)).alias("n_distinct"),
        ratio(F.sum(F.length("value") * n), F.sum(F.when(known, n)), 2).alias("avg_width"),
    )


def profile_approx(df: DataFrame, columns: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """As :func:`profile` with sketched distinct counts: one pass and no shuffle of values."""
    rows = F.count(F.lit(1))
    facts = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"), rows.alias("row_count"),
                ratio(F.count(F.when(F.col(c).isNull(), 1)), rows, 4).alias("null_frac"),
                F.approx_count_distinct(c, rsd).alias("n_distinct"),
                F.round(F.avg(F.length(F.col(c).cast("string"))), 2).alias("avg_width"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )
    return facts.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(columns))])).alias("c")).select("c.*")


def common_values(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent values per column with their share of the rows."""
    counts = value_counts(df, columns).filter(F.col("value").isNotNull())
    totals = df.agg(F.count(F.lit(1)).alias("__all"))
    order = Window.partitionBy("column_name").orderBy(*order_columns(["-n", "value"]))
    top = counts.withColumn("value_rank", F.row_number().over(order)).filter(F.col("value_rank") <= k)
    return attach(top, totals).select(
        "column_name", "value_rank", "value", F.col("n").alias("row_count"), ratio(F.col("n"), F.col("__all"), 4).alias("frequency")
    )


def order_correlation(df: DataFrame, position: str, value: str, **options) -> DataFrame:
    """Correlation between stored order and value order: +-1 means range scans touch few files."""
    ranked = value_ranks(df, [], [position], {"__x": "rank"}, **options)
    ranked = value_ranks(ranked, [], [value], {"__y": "rank"}, **options)
    x, y = F.col("__x").cast("decimal(38,0)"), F.col("__y").cast("decimal(38,0)")
    s = ranked.agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"),
    )
    d = {c: F.col(c).cast("double") for c in s.columns}
    top = d["n"] * d["sxy"] - d["sx"] * d["sy"]
    bottom = F.sqrt(d["n"] * d["sxx"] - d["sx"] * d["sx"]) * F.sqrt(d["n"] * d["syy"] - d["sy"] * d["sy"])
    return s.select(F.col("n").alias("row_count"), F.round(F.try_divide(top, bottom), 6).alias("correlation"))


def selectivity(df: DataFrame, first: str, second: str) -> DataFrame:
    """Per value pair: actual rows, and rows expected if the two columns were independent."""
    joint = df.groupBy(first, second).agg(F.count(F.lit(1)).alias("actual_rows"))
    both = with_totals(joint, [first], {"__a": F.sum("actual_rows")})
    both = with_totals(both, [second], {"__b": F.sum("actual_rows")})
    both = with_totals(both, [], {"__n": F.sum("actual_rows")})
    expected = F.col("__a").cast("decimal(18,0)") * F.col("__b").cast("decimal(18,0)") / F.col("__n").cast("decimal(18,0)")
    return both.select(
        first, second, "actual_rows", F.round(expected, 2).alias("independent_rows"),
        ratio(F.col("actual_rows"), F.col("__n"), 6).alias("joint_selectivity"),
    )


def dependency(df: DataFrame, first: str, second: str) -> DataFrame:
    """Distinct counts of two columns and of the pair, and the share of rows in which one column
    determines the other (1 means a functional dependency)."""
    joint = df.groupBy(first, second).agg(F.count(F.lit(1)).alias("n"))
    sides = with_totals(joint, [first], {"__per_a": F.count(F.lit(1))})
    sides = with_totals(sides, [second], {"__per_b": F.count(F.lit(1))})
    return sides.agg(
        F.count_distinct(first).alias("n_distinct_first"),
        F.count_distinct(second).alias("n_distinct_second"),
        F.count(F.lit(1)).alias("n_distinct_pair"),
        ratio(F.sum(F.when(F.col("__per_a") == 1, F.col("n")).otherwise(0)), F.sum("n"), 4).alias("first_determines_second"),
        ratio(F.sum(F.when(F.col("__per_b") == 1, F.col("n")).otherwise(0)), F.sum("n"), 4).alias("second_determines_first"),
    )


def histogram(df: DataFrame, column: str, bins: int, **options) -> DataFrame:
    """Equi-height bounds, exact: bound ``i`` is the smallest value with at least i/bins of the rows
    at or below it. Values are counted first, then summed over range slices."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    upto = running(counts, [], [column], {"__upto": ("sum", F.col("n"))}, **options)
    sized = with_totals(upto, [], {"__all": F.sum("n")})
    # Bounds covered by this value: those i with before < i * all / bins <= upto.
    covered = lambda rows: F.floor(rows * bins / F.col("__all")).cast("int")
    before = F.col("__upto") - F.col("n")
    first = F.when(before == 0, F.lit(0)).otherwise(covered(before) + 1)
    bounds = sized.withColumn("__from", first).withColumn("__to", covered(F.col("__upto")))
    return bounds.filter(F.col("__from") <= F.col("__to")).select(
        F.explode(F.sequence("__from", "__to")).alias("bound"), F.col(column).alias("value")
    )


def histogram_approx(df: DataFrame, column: str, bins: int, accuracy: int = 10_000) -> DataFrame:
    """Equi-height bounds from a mergeable quantile sketch: one pass, no shuffle of rows."""
    points = [i / bins for i in range(bins + 1)]
    bounds = df.agg(F.percentile_approx(column, points, accuracy).alias("b"))
    return bounds.select(F.posexplode("b").alias("bound", "value"))
