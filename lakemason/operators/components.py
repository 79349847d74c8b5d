"""Cycles of a directed graph, without a list of visited nodes in any row.

Nodes that lie on no cycle are trimmed first: those without an edge in or without one out, again and again. What is left
falls into strongly connected components (sets of nodes that all reach one another) by forward and backward reach:
every node takes the largest number that reaches it as its colour, and of each colour the nodes that reach back to the
node of that number are a component. It leaves, and the rest of each colour goes on by itself. Rows are nodes and edges
only, whatever number of paths the graph has; each round is written to the checkpoint folder.

Numbers are hashes of the ids, so that along a path they come in no order, and a round also takes over the colour
of the node whose number a node already has: the stretch that a colour has seen grows by a factor, not by one edge.
Trimming takes as many rounds as the longest chain of nodes outside of cycles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemason.session import cut


def _trimmed(edges: DataFrame) -> DataFrame:
    """The edges between nodes that have both an edge in and an edge out, until that takes nothing away."""
    size = edges.count()
    while size:
        both = edges.select(F.col("src").alias("id")).distinct().intersect(edges.select(F.col("dst").alias("id")))
        starts, ends = (both.withColumnRenamed("id", c) for c in ("src", "dst"))
        edges = cut(edges.join(starts, "src", "left_semi").join(ends, "dst", "left_semi"))
        left = edges.count()
        if left == size:
            break
        size = left
    return edges


def _coloured(edges: DataFrame) -> DataFrame:
    """``id, color``: for every node of ``edges`` the largest number (itself included) that reaches it."""
    ids = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()
    colors = cut(ids.select("id", F.struct(F.xxhash64("id").alias("hash"), F.col("id").alias("owner")).alias("color")))
    while True:
        own = colors.select(F.col("id").alias("src"), "color")
        reached = edges.join(own, "src").select(F.col("dst").alias("id"), "color").unionAll(colors)
        best = reached.groupBy("id").agg(F.max("color").alias("color"))
        # what reaches the owner of my colour reaches me
        owners = best.select(F.col("id").alias("owner"), F.col("color").alias("further"))
        jumped = best.withColumn("owner", F.col("color.owner")).join(owners, "owner").join(colors.withColumnRenamed("color", "old"), "id")
        following = cut(jumped.select("id", F.greatest("color", "further").alias("color"), (F.greatest("color", "further") != F.col("old")).alias("moved")))
        colors = following.select("id", "color")
        if following.filter("moved").isEmpty():
            return colors.select("id", F.col("color.owner").alias("color"))


def _phase(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One component of each colour, as ``id, color``, and the edges that the next phase still has to look at.

    The owner of a colour has the largest number of all nodes of that colour, so the nodes that reach it are those that
    get its colour again when the edges within the colour are turned round. Edges between colours lie on no cycle.
    """
    colors = _coloured(edges)
    source, target = colors.toDF("src", "color"), colors.toDF("dst", "other")
    inside = cut(edges.join(source, "src").join(target, "dst").filter("color = other").select("src", "dst"))
    back = _coloured(inside.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    found = cut(colors.filter("id = color").union(colors.join(back, ["id", "color"], "left_semi")).distinct())
    gone = found.select("id")
    rest = inside.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
    return found, cut(rest)


def strong_components(edges: DataFrame, source: str, target: str) -> DataFrame:
    """``id, component_id, size`` of every node on a cycle: its component's smallest id, and the number of its nodes.

    A node with an edge to itself is on a cycle, alone or with others. Edges with a NULL end and repeated edges count
    as none and once. The result is empty for graphs without cycles.
    """
    known = edges.select(F.col(source).alias("src"), F.col(target).alias("dst")).na.drop().distinct()
    known = cut(known)
    loops = known.filter("src = dst").select(F.col("src").alias("id"), F.col("src").alias("color"))
    left = _trimmed(known.filter("src <> dst"))
    found = []
    while not left.isEmpty():
        part, left = _phase(left)
        found.append(part)
        left = _trimmed(left)
    rows = loops
    for part in found:
        rows = rows.unionAll(part)
    # a component of one node is a cycle only by an edge to itself; with others around it the loop adds nothing
    sizes = rows.distinct().groupBy("color").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("component_id"))
    placed = rows.distinct().join(sizes, "color")
    alone = loops.select("id").withColumn("loops", F.lit(True))
    cyclic = placed.join(alone, "id", "left").filter("n > 1 OR loops")
    return cyclic.groupBy("id").agg(F.max(F.struct("n", "component_id")).alias("x")).select("id", "x.component_id", F.col("x.n").alias("size"))


def closing_edges(edges: DataFrame, source: str, target: str, components: DataFrame | None = None) -> DataFrame:
    """The edges that lie on a cycle: both ends in one component. Their columns stay as they are."""
    components = strong_components(edges, source, target) if components is None else components
    part = components.select(F.col("id").alias("__a"), F.col("component_id").alias("__x"))
    other = components.select(F.col("id").alias("__b"), F.col("component_id").alias("__y"))
    inside = edges.join(part, F.col(source) == F.col("__a")).join(other, F.col(target) == F.col("__b"))
    return inside.filter("__x = __y").select(*edges.columns)
