"""Trees over region > nation > supplier, and calendar gap filling."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from lakemason.functions.columns import literal, money, ratio
from lakemason.operators import hierarchy as H
from lakemason.operators.components import closing_edges, strong_components
from lakemason.plans.registry import Tables, m, query, r
from lakemason.sources.tables import days

c = F.col

_NODES = """nodes AS (SELECT 'R' || r_regionkey AS id, r_name AS name, NULL AS parent_id FROM region
    UNION ALL SELECT 'N' || n_nationkey, n_name, 'R' || n_regionkey FROM nation
    UNION ALL SELECT 'S' || s_suppkey, s_name, 'N' || s_nationkey FROM supplier)"""
# One more edge: region 0 hangs below supplier 0, which closes a cycle when nation 15 is in region 0.
_LOOPED = _NODES[:-1] + """ UNION ALL SELECT 'R' || n_regionkey, 'LOOP', 'S' || s_suppkey FROM supplier
    JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey = 0)"""


def places(t: Tables):
    regions = t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("id"), c("r_name").alias("name"), F.lit(None).cast("string").alias("parent_id"))
    nations = t.nation.select(F.concat(F.lit("N"), "n_nationkey"), "n_name", F.concat(F.lit("R"), "n_regionkey"))
    suppliers = t.supplier.select(F.concat(F.lit("S"), "s_suppkey"), "s_name", F.concat(F.lit("N"), "s_nationkey"))
    return regions.unionAll(nations).unionAll(suppliers)


def looped(t: Tables):
    back = t.supplier.filter("s_suppkey = 0").join(t.nation, c("n_nationkey") == c("s_nationkey")).select(
        F.concat(F.lit("R"), "n_regionkey"), F.lit("LOOP"), F.concat(F.lit("S"), "s_suppkey"))
    return places(t).unionAll(back)


@query("rec_tree", "text: id path_breadcrumbs visual_tree; int: level_depth child_count", f"""
    WITH RECURSIVE {_NODES}, tree AS (SELECT id, name, 1 AS level_depth, name AS path_breadcrumbs FROM nodes WHERE parent_id IS NULL
      UNION ALL SELECT n.id, n.name, level_depth + 1, path_breadcrumbs || ' > ' || n.name FROM nodes n JOIN tree ON n.parent_id = tree.id)
    SELECT id, path_breadcrumbs, repeat('  ', level_depth - 1) || name AS visual_tree, level_depth,
      (SELECT COUNT(*) FROM nodes k WHERE k.parent_id = tree.id) AS child_count FROM tree""")
def _(t: Tables):
    return H.tree(places(t), "id", "parent_id", "name")


@query("rec_ancestors", "text: start_id id name; int: step_back", f"""
    WITH RECURSIVE {_NODES}, up AS (SELECT id AS start_id, id, name, parent_id, 1 AS step_back FROM nodes WHERE id LIKE 'S%'
      UNION ALL SELECT start_id, n.id, n.name, n.parent_id, step_back + 1 FROM nodes n JOIN up ON n.id = up.parent_id)
    SELECT start_id, id, name, step_back FROM up""")
def _(t: Tables):
    return H.ancestors(places(t), "id", "parent_id", "name", c("id").startswith("S"))


_CLOSURE = f"""WITH RECURSIVE {_NODES}, pairs AS (SELECT id AS ancestor_id, id AS descendant_id, 0 AS depth FROM nodes
    UNION ALL SELECT ancestor_id, n.id, depth + 1 FROM pairs JOIN nodes n ON n.parent_id = descendant_id)"""


@query("rec_closure", "text: ancestor_id descendant_id; int: depth", f"{_CLOSURE} SELECT * FROM pairs")
def _(t: Tables):
    return H.closure(places(t), "id", "parent_id")


@query("rec_cycle_safe", "text: id name; int: depth; list: visited_ids", f"""
    WITH RECURSIVE {_LOOPED}, walk AS (SELECT id, name, 1 AS depth, [id] AS visited_ids FROM nodes WHERE parent_id IS NULL
      UNION ALL SELECT n.id, n.name, depth + 1, list_append(visited_ids, n.id) FROM nodes n JOIN walk ON n.parent_id = walk.id
      WHERE NOT list_contains(visited_ids, n.id) AND depth < 10) SELECT * FROM walk""")
def _(t: Tables):
    return H.safe_tree(looped(t), "id", "parent_id", "name")


@query("rec_cycle_mark", "text: id; int: depth; list: path; bool: is_cycle", f"""
    WITH RECURSIVE {_LOOPED}, walk AS (SELECT id, 1 AS depth, [id] AS path, FALSE AS is_cycle FROM nodes WHERE parent_id IS NULL
      UNION ALL SELECT n.id, depth + 1, list_append(path, n.id), list_contains(path, n.id) FROM nodes n JOIN walk
      ON n.parent_id = walk.id WHERE NOT is_cycle) SELECT * FROM walk""")
def _(t: Tables):
    return H.marked_tree(looped(t), "id", "parent_id")


# Urgent orders of a month, in order: from each one's customer to the next one's.
_HANDOVERS = """handovers AS (SELECT * FROM (SELECT o_custkey AS giver, LEAD(o_custkey) OVER (PARTITION BY date_trunc('month', o_orderdate)
    ORDER BY o_orderdate, o_orderkey) AS taker FROM orders WHERE o_orderpriority = '1-URGENT') WHERE taker IS NOT NULL)"""
_MUTUAL = f"""WITH RECURSIVE {_HANDOVERS}, reach AS (SELECT giver AS a, taker AS b FROM handovers
      UNION SELECT a, taker FROM reach JOIN handovers ON giver = b),
    placed AS (SELECT x.a AS id, MIN(x.b) AS component_id, COUNT(*) AS size FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a GROUP BY x.a)"""


def handovers(t: Tables):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    month = Window.partitionBy(F.date_trunc("month", "o_orderdate")).orderBy("o_orderdate", "o_orderkey")
    return urgent.select(c("o_custkey").alias("giver"), F.lead("o_custkey").over(month).alias("taker")).filter("taker IS NOT NULL")


@query("rec_components", "int: id component_id size", f"{_MUTUAL} SELECT * FROM placed")
def _(t: Tables):
    """Customers on a cycle of handovers, by strongly connected component."""
    return strong_components(handovers(t), "giver", "taker")


@query("rec_cycle_edges", "int: giver taker n", f"""
    {_MUTUAL} SELECT giver, taker, COUNT(*) AS n FROM handovers JOIN placed p ON p.id = giver JOIN placed q ON q.id = taker
    WHERE p.component_id = q.component_id GROUP BY 1, 2""")
def _(t: Tables):
    return closing_edges(handovers(t), "giver", "taker").groupBy("giver", "taker").agg(F.count(F.lit(1)).alias("n"))


@query("rec_cycle_members", "text: id component_id; int: size", f"""
    WITH RECURSIVE {_LOOPED}, reach AS (SELECT parent_id AS a, id AS b FROM nodes WHERE parent_id IS NOT NULL
      UNION SELECT a, id FROM reach JOIN nodes ON parent_id = b)
    SELECT x.a AS id, MIN(x.b) AS component_id, COUNT(*) AS size FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a GROUP BY x.a""")
def _(t: Tables):
    """The places on the loop that the tree with one edge too many has."""
    return strong_components(looped(t), "parent_id", "id")


def _direct(t: Tables):
    return t.lineitem.groupBy(F.concat(F.lit("S"), "l_suppkey").alias("id")).agg(
        F.count_distinct("l_orderkey").alias("direct_orders"), F.sum(money("l_extendedprice")).alias("direct_revenue"))


@query("rec_rollup", "text: id name; float: direct_revenue rolled_revenue direct_share_pct; int: rolled_orders", f"""
    {_CLOSURE}, direct AS (SELECT 'S' || l_suppkey AS id, COUNT(DISTINCT l_orderkey) AS o, SUM({m('l_extendedprice')}) AS v
      FROM lineitem GROUP BY 1), rolled AS (SELECT ancestor_id, SUM(o) AS o, SUM(v) AS v FROM pairs JOIN direct
      ON direct.id = descendant_id GROUP BY 1)
    SELECT n.id, n.name, COALESCE(d.v, 0) AS direct_revenue, COALESCE(x.v, 0) AS rolled_revenue,
      CASE WHEN x.v > 0 THEN {r('COALESCE(d.v, 0) / x.v * 100')} ELSE 0 END AS direct_share_pct, COALESCE(x.o, 0) AS rolled_orders
    FROM nodes n LEFT JOIN direct d ON d.id = n.id LEFT JOIN rolled x ON x.ancestor_id = n.id""")
def _(t: Tables):
    nodes, direct = places(t), _direct(t)
    rolled = H.rolled_up(H.closure(nodes, "id", "parent_id", is_tree=True), direct, "id",
                         {"direct_orders": "rolled_orders", "direct_revenue": "rolled_revenue"})
    zero = F.lit(0).cast("decimal(28,2)")
    joined = nodes.join(direct, "id", "left").join(rolled, "id", "left")
    return joined.select(
        "id", "name", F.coalesce("direct_revenue", zero).alias("direct_revenue"),
        F.coalesce("rolled_revenue", zero).alias("rolled_revenue"),
        F.coalesce(ratio(F.coalesce("direct_revenue", zero), c("rolled_revenue"), 2, 100), F.lit(0)).alias("direct_share_pct"),
        F.coalesce("rolled_orders", F.lit(0)).alias("rolled_orders"))


@query("rec_rollup_distinct", "text: id; int: distinct_orders", f"""
    {_CLOSURE} SELECT ancestor_id AS id, COUNT(DISTINCT l_orderkey) AS distinct_orders FROM pairs
    JOIN lineitem ON 'S' || l_suppkey = descendant_id GROUP BY 1""")
def _(t: Tables):
    """Orders spanning several suppliers count once per ancestor."""
    lines = t.lineitem.select(F.concat(F.lit("S"), "l_suppkey").alias("id"), "l_orderkey")
    return H.rolled_up_distinct(H.closure(places(t), "id", "parent_id", is_tree=True), lines, "id", "l_orderkey", "distinct_orders")


@query("gap_fill", "text: day; int: orders_count; float: revenue", f"""
    SELECT CAST(d AS DATE) AS day, COALESCE(n, 0) AS orders_count, COALESCE(v, 0) AS revenue FROM (SELECT unnest(generate_series(
      TIMESTAMP '1996-01-01', TIMESTAMP '1996-12-31', INTERVAL 1 DAY)) AS d) LEFT JOIN (SELECT o_orderdate, COUNT(*) AS n,
      SUM({m('o_totalprice')}) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON d = o_orderdate""")
def _(t: Tables):
    in_year = t.orders.filter("o_orderstatus = 'F'").filter(
        (c("o_orderdate") >= literal(dt.datetime(1996, 1, 1))) & (c("o_orderdate") < literal(dt.datetime(1997, 1, 1))))
    daily = in_year.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("orders_count"), F.sum(money("o_totalprice")).alias("revenue"))
    return H.gap_filled(days(t.spark, "1996-01-01", "1996-12-31"), daily, "day", {"orders_count": 0, "revenue": 0})
