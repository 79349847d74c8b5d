"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemason.session import cut


def _lowest(edges: DataFrame) -> DataFrame:
    """Each node ``u`` and the lowest of itself and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = _lowest(edges)
    rest = edges.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every linked node; root is the smallest node reachable.

    Each round hangs neighbours onto the lowest node near them (large star), then onto the lowest of those
    (small star); a component of any shape becomes a star in a logarithmic number of rounds. Degrees are
    never collected: minima are partial aggregates and a hot node's links are joined, so Spark splits them.
    Every round is written to the checkpoint folder. Links to oneself, repeated links and nulls are dropped.
    """
    a, b = F.col(left), F.col(right)
    edges = cut(links.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    sign = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    before = edges.agg(*sign).first()
    while before.n:
        edges = cut(_small_star(_large_star(edges)))
        now = edges.agg(*sign).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
