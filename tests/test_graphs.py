"""Doubling walks and strong components against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakemason.operators import components as C, hierarchy as H, hierarchy

NODES = "id bigint, parent bigint, name string"


@pytest.fixture
def rounds(monkeypatch):
    """Counts what is written."""
    seen = []
    plain = hierarchy.cut

    def counted(df):
        seen.append(1)
        return plain(df)

    monkeypatch.setattr(hierarchy, "cut", counted)
    return seen


def plain_tree(rows):
    out, level = [], [(i, n, 1, n) for i, p, n in rows if p is None]
    while level:
        out += level
        level = [(i, n, d + 1, f"{path} > {n}") for at, _, d, path in level for i, p, n in rows if p == at]
    return Counter(out)


def random_forest(seed, size=40):
    rnd = random.Random(seed)
    rows = [(i, None if i < 3 or rnd.random() < 0.1 else rnd.randrange(max(0, i - 6), i), f"n{i}") for i in range(size)]
    return rows + [(900, 901, "cycle"), (901, 900, "cycle"), (902, 901, "below it"), (903, 904, "no parent row")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_of_any_shape(spark, seed):
    rows = random_forest(seed)
    if seed == 2:  # a node below two parents, and a repeated row
        rows += [(20, 4, "n20"), (21, rows[21][1], "n21")]
    got = H.tree(spark.createDataFrame(rows, NODES), "id", "parent", "name").collect()
    assert Counter((r.id, r.name, r.level_depth, r.path_breadcrumbs) for r in got) == plain_tree(rows)
    children = Counter(p for _, p, _ in rows)
    assert all(r.child_count == children[r.id] and r.visual_tree == "  " * (r.level_depth - 1) + r.name for r in got)


def test_ancestors_of_any_shape(spark):
    rows = [r for r in random_forest(3) if r[0] < 900] + [(20, 4, "n20"), (21, 5, "other name"), (21, 5, "other name")]
    out, level = [], [(i, 1, i, n, p) for i, p, n in rows if i % 5 == 0 or i == 21]
    while level:
        out += level
        level = [(s, d + 1, i, n, p) for s, d, _, _, up in level for i, p, n in rows if i == up]
    got = H.ancestors(spark.createDataFrame(rows, NODES), "id", "parent", "name", (F.col("id") % 5 == 0) | (F.col("id") == 21))
    assert Counter(map(tuple, got.select("start_id", "step_back", "id", "name", "parent").collect())) == Counter(out)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_closure_has_the_shortest_distances(spark, seed):
    rnd = random.Random(seed)
    n = 24
    rows = [(rnd.randrange(n), rnd.choice([None, 99, *range(n)]), "x") for _ in range(n + 10 * seed)]
    ids = {i for i, _, _ in rows}
    below = defaultdict(set)
    for i, p, _ in rows:
        if p in ids:
            below[p].add(i)
    want = set()
    for a in ids:
        seen, level, d = {a}, {a}, 0
        while level:
            want |= {(a, b, d) for b in level}
            level = {c for b in level for c in below[b]} - seen
            seen |= level
            d += 1
    got = H.closure(spark.createDataFrame(rows, NODES), "id", "parent").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_chain_of_a_thousand_takes_ten_rounds(spark, rounds):
    chain = spark.range(1000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit("x").alias("name"))
    pairs = H.closure(chain, "id", "parent", is_tree=True)
    assert len(rounds) <= 12
    assert tuple(pairs.agg(F.count("*"), F.sum("depth"), F.max("depth")).first()) == (500_500, sum(d * (1000 - d) for d in range(1000)), 999)
    rounds.clear()
    deepest = H.tree(chain, "id", "parent", "name").filter("level_depth = 1000").collect()
    assert len(rounds) <= 12 and len(deepest) == 1 and deepest[0].path_breadcrumbs == " > ".join("x" * 1000)
    rounds.clear()
    up = H.ancestors(chain, "id", "parent", "name", F.col("id") == 999)
    assert len(rounds) <= 24 and up.count() == 1000  # two tables a round


def plain_components(edges):
    """Mutual reach, by walking."""
    out = defaultdict(set)
    for a, b in edges:
        out[a].add(b)
    reach = {}
    for a in list(out):
        seen, level = set(), {a}
        while level:
            level = {c for b in level for c in out.get(b, ())} - seen
            seen |= level
        reach[a] = seen
    found = {}
    for a in reach:
        own = {b for b in reach[a] if a in reach.get(b, ())}
        if own:
            found[a] = (min(own), len(own))
    return sorted((a, *x) for a, x in found.items())


def components(spark, edges):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    return sorted(map(tuple, C.strong_components(df, "a", "b").collect()))


@pytest.mark.parametrize("seed,n,m", [(1, 30, 30), (2, 30, 60), (3, 12, 20)])
def test_components_of_random_graphs(spark, seed, n, m):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
    edges += edges[:5]
    assert components(spark, edges + [(None, 1), (2, None)]) == plain_components(edges)


def test_components_of_special_graphs(spark):
    assert components(spark, []) == []
    assert components(spark, [(1, 2), (2, 3)]) == []
    assert components(spark, [(1, 1), (1, 2)]) == [(1, 1, 1)]
    # cycles that hang together like beads: each is one component
    beads = [e for k in range(8) for e in ((3 * k, 3 * k + 1), (3 * k + 1, 3 * k + 2), (3 * k + 2, 3 * k), (3 * k, 3 * k + 3))]
    assert components(spark, beads) == plain_components(beads)


def test_a_dense_graph_ends(spark):
    """10,000 edges between 100 nodes: a walk that lists paths would never end."""
    edges = spark.range(10_000).select((F.col("id") % 100).alias("a"), F.floor(F.col("id") / 100).alias("b"))
    rows = C.strong_components(edges, "a", "b").collect()
    assert len(rows) == 100 and {(r.component_id, r["size"]) for r in rows} == {(0, 100)}


def test_a_long_cycle_takes_few_rounds(spark, monkeypatch):
    seen, plain = [], C.cut
    monkeypatch.setattr(C, "cut", lambda df: seen.append(1) or plain(df))
    ring = spark.range(500).select(F.col("id").alias("a"), ((F.col("id") + 1) % 500).alias("b"))
    rows = C.strong_components(ring, "a", "b").collect()
    assert {(r.component_id, r["size"]) for r in rows} == {(0, 500)} and len(rows) == 500
    assert len(seen) < 60


def test_marks_equal_the_walk_that_lists_paths(spark):
    rnd = random.Random(11)
    edges = [(i, rnd.randrange(8)) for i in range(8) for _ in range(2)]
    rows = [(a, b, "x") for a, b in edges] + [(100, None, "root")] + [(i, 100, "x") for i in range(8)]
    nodes = spark.createDataFrame(sorted(set(rows), key=str), NODES)
    walked = H.marked_tree(nodes, "id", "parent").filter("is_cycle").select("id").distinct().collect()
    marked = C.strong_components(nodes, "parent", "id").select("id").collect()
    assert {r.id for r in walked} == {r.id for r in marked}
    inside = C.closing_edges(nodes, "parent", "id")
    assert inside.columns == nodes.columns
    assert C.strong_components(inside, "parent", "id").count() == len(marked)


def test_distinct_rollup_deals_its_pairs_to_tasks_of_a_bounded_size(spark):
    parents = {0: None, 1: 0, 2: 0, 3: 1, 4: 1, 5: 2}
    nodes = spark.createDataFrame([(str(n), None if p is None else str(p)) for n, p in parents.items()], "n string, p string")
    # members that several leaves share, repeated rows, NULL members, a node without rows and rows without a node
    rows = [(str(3 + i % 2), i % 150) for i in range(400)] * 2 + [("2", None), ("9", 1), (None, 2)]
    table = spark.createDataFrame(rows, "n string, m int")
    got = H.rolled_up_distinct(H.closure(nodes, "n", "p", is_tree=True), table, "n", "m", "found", pairs_per_task=100)

    def above(n):
        return [] if n is None else [n, *above(parents[n])]

    want = {}
    for n, member in rows:
        for up in above(int(n)) if n and int(n) in parents else []:
            want.setdefault(str(up), set()).update([] if member is None else [member])
    assert {r.n: r.found for r in got.collect()} == {n: len(members) for n, members in want.items()}
    # 3 levels above each of 800 rows, 2 above another; two rows without a node: 2,404 in tasks of 100
    assert re.search(r"hashpartitioning\(n#\d+, m#\d+, 25\), REPARTITION_BY_NUM", got._jdf.queryExecution().executedPlan().toString())
