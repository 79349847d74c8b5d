"""Level-wise search for dependencies against trying every set of columns."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lakemason.operators import dependencies as L


def brute(rows, columns, max_error):
    errors = {}
    for size in range(len(columns)):
        for left in combinations(range(len(columns)), size):
            for right in set(range(len(columns))) - set(left):
                groups = defaultdict(Counter)
                for row in rows:
                    groups[tuple(row[i] for i in left)][row[right]] += 1
                errors[left, right] = sum(sum(g.values()) - max(g.values()) for g in groups.values()) / len(rows)
    small = {k: e for k, e in errors.items() if e <= max_error}
    return sorted(
        (tuple(columns[i] for i in left), columns[right], e) for (left, right), e in small.items()
        if not any(r == right and set(s) < set(left) for s, r in small))


@pytest.mark.parametrize("max_error", [0.0, 0.05, 0.2])
@pytest.mark.parametrize("seed", [1, 2])
def test_all_minimal_dependencies_of_six_columns(spark, seed, max_error):
    rnd = random.Random(seed)
    rows = []
    for i in range(150):
        a, b = rnd.randint(0, 5), rnd.choice(["x", "y", None, ""])
        c = a % 3 if rnd.random() > 0.03 else 9  # nearly determined by a
        rows.append((a, b, c, (a * 7 + len(b or "__")) % 5, i // 2 if seed == 1 else rnd.randint(0, 40), "constant"))
    columns = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, "a int, b string, c int, d int, e int, f string")
    got = L.dependencies(df, columns, max_error=max_error).collect()
    assert sorted((tuple(r.determinant), r.dependent, r.error) for r in got) == brute(rows, columns, max_error)


def test_bounds_and_empty_tables(spark):
    df = spark.range(50).select("id", (F.col("id") % 5).alias("m"), (F.col("id") % 10).alias("t"))
    small = {(tuple(r.determinant), r.dependent) for r in L.dependencies(df, ["m", "t", "id"], max_size=1).collect()}
    assert small == {(("t",), "m"), (("id",), "m"), (("id",), "t")}
    assert {tuple(r.determinant) for r in L.dependencies(df.limit(0), ["m", "t"]).collect()} == {()}


def test_joint_values(spark):
    rows = [("a", 1)] * 5 + [("a", 2)] * 3 + [("b", None)] * 2
    got = L.joint_common_values(spark.createDataFrame(rows, "x string, y int"), ["x", "y"], 2).orderBy("value_rank").collect()
    assert [(r.column_names, r["items"], r.row_count, r.frequency, r.independent_frequency) for r in got] == [("x,y", ["a", "1"], 5, 0.5, 0.4), ("x,y", ["a", "2"], 3, 0.3, 0.24)]
