"""Trees and graphs given as edge rows.

Trees, chains and closures are found by doubling: after k rounds every row knows what lies up to ``2**k`` levels away,
and a round joins these rows to themselves, so a chain of a thousand levels takes ten rounds. Walks that list every path
(``safe_tree``, ``marked_tree``) go level by level. Each round or level is one distributed join whose result is written
to the checkpoint folder, so neither the plan nor the recomputation cost grows with depth. There is no row or
level cap unless asked for.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.session import cut

#: Pairs of a node and a member that one task of ``rolled_up_distinct`` takes.
PAIRS_PER_TASK = 1 << 20


def _levels(start: DataFrame, step: Callable[[DataFrame], DataFrame], max_depth: int | None = None) -> DataFrame:
    """Union of ``start``, ``step(start)``, ``step(step(start))``, ... until a level is empty."""
    levels = [cut(start)]
    while (max_depth is None or len(levels) < max_depth) and not levels[-1].isEmpty():
        levels.append(cut(step(levels[-1])))
    return reduce(DataFrame.unionByName, levels)


def tree(nodes: DataFrame, node: str, parent: str, label: str, *, separator: str = " > ", indent: str = "  ") -> DataFrame:
    """Top-down tree from the roots: depth, breadcrumb path, indented label, direct child count.

    Every row holds the path to its ``2**k``-th ancestor and that ancestor's id; a round prepends the ancestor's own
    row. Rows that reach a root are done. A round that finishes no row proves that no unfinished one has a root
    (a finished depth is missing), so cycles and rows below a missing parent end the loop and are left out.
    """
    own = [F.col(node).alias("__n"), F.col(label).alias("__l"), F.col(parent).alias("__p")]
    open_rows = cut(nodes.select(*own, F.col(parent).alias("__up"), F.lit(1).alias("__d"), F.col(label).alias("__path")))
    done = []
    while True:
        finished = open_rows.filter(F.col("__up").isNull())
        if finished.isEmpty():
            break
        done.append(finished)
        above = open_rows.select(F.col("__n").alias("__m"), F.col("__up").alias("__up2"), F.col("__d").alias("__d2"), F.col("__path").alias("__path2"))
        for rows in done[:-1]:
            above = above.unionAll(rows.select("__n", "__up", "__d", "__path"))
        joined = open_rows.filter(F.col("__up").isNotNull()).join(above, F.col("__up") == F.col("__m"))
        open_rows = cut(joined.select(
            "__n", "__l", "__p", F.col("__up2").alias("__up"), (F.col("__d") + F.col("__d2")).alias("__d"),
            F.concat("__path2", F.lit(separator), "__path").alias("__path")))
    walked = reduce(DataFrame.unionAll, done) if done else open_rows.limit(0)
    children = nodes.groupBy(F.col(parent).alias("__q")).agg(F.count(F.lit(1)).alias("child_count"))
    return walked.join(children, F.col("__n") == F.col("__q"), "left").select(
        F.col("__n").alias(node), F.col("__l").alias(label), F.col("__p").alias(parent), F.col("__d").alias("level_depth"),
        F.col("__path").alias("path_breadcrumbs"), F.concat(F.repeat(F.lit(indent), F.col("__d") - 1), F.col("__l")).alias("visual_tree"),
        F.coalesce("child_count", F.lit(0)).alias("child_count"))


def ancestors(nodes: DataFrame, node: str, parent: str, label: str, target: Column) -> DataFrame:
    """Bottom-up chains from the nodes that satisfy ``target`` to their roots, one row a step.

    ``jumps`` leads from each node to its ``2**k``-th ancestors; a round adds to all rows found so far their
    ancestors that many steps further on. Like any list of all chains, it does not end on a cycle that a target reaches.
    """
    up = nodes.select(F.col(node).alias("__n"), F.col(parent).alias("__p"), F.col(label).alias("__l"))
    found = cut(nodes.filter(target).select(
        F.col(node).alias("start_id"), F.lit(1).alias("step_back"), F.col(node).alias("__at"), F.col(label).alias("__l"), F.col(parent).alias("__p")))
    # one step: to the rows of the parent
    jumps = cut(up.select("__n", "__p").distinct().alias("a").join(up.alias("b"), F.col("a.__p") == F.col("b.__n")).select(
        F.col("a.__n").alias("__from"), F.col("a.__p").alias("__via"), F.col("b.__n").alias("__to"), F.col("b.__p").alias("__top"), F.col("b.__l").alias("__tol")))
    parts, step = [found], 1
    while True:
        # rows are followed by id and parent, as a node may have several parents
        steps = (F.col("__at") == F.col("__from")) & (F.col("__p") == F.col("__via"))
        added = cut(reduce(DataFrame.unionAll, parts).join(jumps, steps).select(
            "start_id", (F.col("step_back") + step).alias("step_back"), F.col("__to").alias("__at"), F.col("__tol").alias("__l"), F.col("__top").alias("__p")))
        if added.isEmpty():
            break
        parts.append(added)
        nxt = jumps.select(F.col("__from").alias("__from2"), F.col("__via").alias("__via2"), F.col("__to").alias("__to2"), F.col("__top").alias("__top2"), F.col("__tol").alias("__tol2"))
        further = (F.col("__to") == F.col("__from2")) & (F.col("__top") == F.col("__via2"))
        jumps = cut(jumps.join(nxt, further).select("__from", "__via", F.col("__to2").alias("__to"), F.col("__top2").alias("__top"), F.col("__tol2").alias("__tol")))
        step *= 2
    return reduce(DataFrame.unionAll, parts).select("start_id", "step_back", F.col("__at").alias(node), F.col("__l").alias(label), F.col("__p").alias(parent))


def closure(nodes: DataFrame, node: str, parent: str, *, is_tree: bool = False) -> DataFrame:
    """Every (ancestor, descendant) pair with its shortest distance; a node is its own ancestor at 0.

    Round k joins the pairs exactly ``2**k`` apart to all pairs up to ``2**k`` apart, which gives the pairs up to
    ``2**(k + 1)`` apart: in a tree each of them once. A pair already found is not kept again, so cyclic input ends as
    well. ``is_tree=True`` states that every node has one parent and there is no cycle; that check is then skipped.
    """
    ids = nodes.select(F.col(node).alias("ancestor_id"))
    if not is_tree:
        ids = ids.distinct()
    pair = ["ancestor_id", "descendant_id"]
    itself = ids.select("ancestor_id", F.col("ancestor_id").alias("descendant_id"), F.lit(0).alias("depth"))
    edges = nodes.select(F.col(parent).alias("ancestor_id"), F.col(node).alias("descendant_id"), F.lit(1).alias("depth")).join(ids, "ancestor_id", "left_semi")
    if not is_tree:
        edges = edges.filter("ancestor_id <> descendant_id").distinct()
    found, reach = cut(edges), 1
    last = found
    while True:
        far = last.filter(F.col("depth") == reach)
        if far.isEmpty():
            break
        near = found.select(F.col("ancestor_id").alias("__m"), F.col("descendant_id").alias("__d"), F.col("depth").alias("__n"))
        reached = far.join(near, F.col("descendant_id") == F.col("__m")).select("ancestor_id", F.col("__d").alias("descendant_id"), (F.col("depth") + F.col("__n")).alias("depth"))
        if not is_tree:
            reached = reached.filter("ancestor_id <> descendant_id").groupBy(*pair).agg(F.min("depth").alias("depth")).join(found, pair, "left_anti")
        last = cut(reached)
        found, reach = found.unionByName(last), reach * 2
    return itself.unionByName(found)


def safe_tree(nodes: DataFrame, node: str, parent: str, label: str, *, max_depth: int | None = None, roots: Column | None = None) -> DataFrame:
    """Top-down walk that never revisits an id of its own path, which alone ends it. ``max_depth`` cuts it short."""
    edges = nodes.select(F.col(node).alias("__n"), F.col(parent).alias("__p"), F.col(label).alias("__l"))
    start = nodes.filter(F.col(parent).isNull() if roots is None else roots).select(
        F.col(node), F.col(label), F.col(parent), F.lit(1).alias("depth"), F.array(node).alias("visited_ids")
    )

    def down(level: DataFrame) -> DataFrame:
        fresh = ~F.array_contains(F.col("visited_ids"), F.col("__n"))
        return level.join(edges, F.col("__p") == F.col(node)).filter(fresh).select(
            F.col("__n").alias(node), F.col("__l").alias(label), F.col("__p").alias(parent),
            (F.col("depth") + 1).alias("depth"), F.array_append("visited_ids", F.col("__n")).alias("visited_ids"),
        )

    return _levels(start, down, max_depth)


def marked_tree(nodes: DataFrame, node: str, parent: str, *, roots: Column | None = None) -> DataFrame:
    """Top-down walk that also returns the row closing a cycle, flagged, and does not go past it."""
    edges = nodes.select(F.col(node).alias("__n"), F.col(parent).alias("__p"))
    start = nodes.filter(F.col(parent).isNull() if roots is None else roots).select(
        F.col(node), F.lit(1).alias("depth"), F.array(node).alias("path"), F.lit(False).alias("is_cycle")
    )

    def down(level: DataFrame) -> DataFrame:
        return level.filter(~F.col("is_cycle")).join(edges, F.col("__p") == F.col(node)).select(
            F.col("__n").alias(node), (F.col("depth") + 1).alias("depth"),
            F.array_append("path", F.col("__n")).alias("path"),
            F.array_contains(F.col("path"), F.col("__n")).alias("is_cycle"),
        )

    return _levels(start, down)


def rolled_up(pairs: DataFrame, direct: DataFrame, key: str, measures: dict[str, str]) -> DataFrame:
    """Sum per-node measures over all descendants: ``measures`` maps measure to output column."""
    joined = pairs.join(direct, F.col("descendant_id") == F.col(key)).groupBy(F.col("ancestor_id").alias(key))
    return joined.agg(*[F.sum(m).alias(out) for m, out in measures.items()])


def rolled_up_distinct(pairs: DataFrame, rows: DataFrame, key: str, member: str, out: str, *, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Distinct ``member`` values over all descendants, counted once per ancestor.

    The rows of each node, counted beforehand, tell how many pairs of ancestor and member there are at most. They are dealt to
    so many tasks that each takes about ``pairs_per_task``, and only then made distinct: what a task holds
    does not grow with the rows, the nodes or the depth.
    """
    rows = rows.select(F.col(key).alias("__k"), member)
    below = F.col("descendant_id") == F.col("__k")
    sizes = rows.groupBy("__k").agg(F.count(F.lit(1)).alias("__n"))
    most = sizes.join(pairs, below, "left").agg(F.sum("__n").alias("n")).first()["n"] or 0
    tasks = max(1, ceil(most / pairs_per_task))
    members = rows.repartition(tasks, "__k", member).distinct()
    reached = pairs.join(members, below).select(F.col("ancestor_id").alias(key), member)
    return reached.repartition(tasks, key, member).distinct().groupBy(key).agg(F.count(member).alias(out))


def gap_filled(calendar: DataFrame, facts: DataFrame, day: str, measures: dict[str, object]) -> DataFrame:
    """Every calendar day once; days without facts take the given defaults."""
    joined = calendar.join(facts, day, "left")
    return joined.select(day, *[F.coalesce(F.col(m), F.lit(v)).alias(m) for m, v in measures.items()])
