"""Constraint checks and column profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from lakemason.operators import dependencies as L, quality as Q, sketches as K
from lakemason.plans.joining import _VERSIONS, versions
from lakemason.plans.registry import Tables, query, r
from lakemason.session import scratch
from lakemason.sources.tables import SCHEMAS

c = F.col
_COLUMNS = ["o_orderstatus", "o_orderpriority", "o_custkey", "code"]
_CODED = "(SELECT *, NULLIF(o_orderpriority, '5-LOW') AS code FROM orders)"


def _coded(t: Tables):
    return t.orders.withColumn("code", F.nullif(c("o_orderpriority"), F.lit("5-LOW")))


@query("dq_counts", "text: table_name; int: row_count",
       " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in SCHEMAS))
def _(t: Tables):
    return Q.row_counts({n: getattr(t, n) for n in SCHEMAS})


def _orphan_sql(name: str, child: str, fk: str, parent: str, pk: str) -> str:
    return f"""SELECT '{name}' AS check_name, COUNT(*) AS orphans, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM {child} LEFT JOIN {parent} ON {fk} = {pk} WHERE {pk} IS NULL AND {fk} IS NOT NULL"""


_FILLED = "(SELECT * FROM orders WHERE o_orderstatus = 'F')"


@query("dq_orphans", "text: check_name status; int: orphans", " UNION ALL ".join([
    _orphan_sql("orders.customer", "orders", "o_custkey", "customer", "c_custkey"),
    _orphan_sql("lineitem.orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphan_sql("lineitem.part", "lineitem", "l_partkey", "part", "p_partkey"),
    _orphan_sql("lineitem.supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _orphan_sql("lineitem.filled_orders", "lineitem", "l_orderkey", _FILLED, "o_orderkey")]))
def _(t: Tables):
    orders = Q.orphans(t.orders, {"orders.customer": ("o_custkey", t.customer, "c_custkey")})
    return orders.unionAll(Q.orphans(t.lineitem, {
        "lineitem.orders": ("l_orderkey", t.orders, "o_orderkey"),
        "lineitem.part": ("l_partkey", t.part, "p_partkey"),
        "lineitem.supplier": ("l_suppkey", t.supplier, "s_suppkey"),
        "lineitem.filled_orders": ("l_orderkey", t.orders.filter("o_orderstatus = 'F'"), "o_orderkey"),
    }))


@query("dq_unique", "int: l_orderkey l_linenumber copies", """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _(t: Tables):
    return Q.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_check", "text: rule_name status; int: violations", """
    SELECT rule_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
      SELECT unnest(['quantity_positive', 'flag_known', 'shipped_after_order', 'discount_small']) AS rule_name,
        unnest([COUNT(*) FILTER (WHERE NOT l_quantity > 0), COUNT(*) FILTER (WHERE NOT l_returnflag IN ('A','N','R')),
          COUNT(*) FILTER (WHERE NOT l_shipdate >= o_orderdate),
          COUNT(*) FILTER (WHERE NOT NULLIF(l_discount, 0.1) < 0.08)]) AS violations
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def _(t: Tables):
    """The NULL outcome of a rule passes."""
    return Q.rule_violations(t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")), {
        "quantity_positive": c("l_quantity") > 0,
        "flag_known": c("l_returnflag").isin("A", "N", "R"),
        "shipped_after_order": c("l_shipdate") >= c("o_orderdate"),
        "discount_small": F.nullif(c("l_discount"), F.lit(0.1)) < 0.08,
    })


@query("dq_overlap", "int: o_custkey; time: valid_from valid_to", f"""
    {_VERSIONS}, bent AS (SELECT o_custkey, valid_from, CASE WHEN o_custkey % 3 = 0 AND valid_to < TIMESTAMP '2100-01-01'
      THEN valid_to + INTERVAL 40 DAY ELSE valid_to END AS valid_to FROM v)
    SELECT * FROM bent b WHERE EXISTS (SELECT 1 FROM bent e WHERE e.o_custkey = b.o_custkey AND e.valid_from < b.valid_from
      AND e.valid_to > b.valid_from)""")
def _(t: Tables):
    """Tier history with some periods stretched past their successor."""
    stretched = (c("o_custkey") % 3 == 0) & (F.year("valid_to") < 2100)
    bent = versions(t).withColumn("valid_to", F.when(stretched, c("valid_to") + F.expr("INTERVAL 40 DAYS")).otherwise(c("valid_to")))
    return Q.overlaps(bent, ["o_custkey"], "valid_from", "valid_to", [])


def _profile_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, COUNT(*) AS row_count, {r(f'(COUNT(*) - COUNT({column})) / COUNT(*)', 4)} AS null_frac,
        COUNT(DISTINCT {column}) AS n_distinct, {r(f'SUM(LENGTH(CAST({column} AS VARCHAR))) / COUNT({column})')} AS avg_width FROM {_CODED}"""


@query("prof_columns", "text: column_name; int: row_count n_distinct; float: null_frac avg_width",
       " UNION ALL ".join(_profile_sql(x) for x in _COLUMNS))
def _(t: Tables):
    return Q.profile(_coded(t), _COLUMNS)


def _common_sql(column: str) -> str:
    return f"""SELECT * FROM (SELECT '{column}' AS column_name, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, CAST({column} AS VARCHAR))
        AS value_rank, CAST({column} AS VARCHAR) AS value, COUNT(*) AS row_count,
        {r(f'COUNT(*) / (SELECT COUNT(*) FROM orders)', 4)} AS frequency
        FROM {_CODED} WHERE {column} IS NOT NULL GROUP BY {column}) WHERE value_rank <= 4"""


@query("prof_common_values", "text: column_name value; int: value_rank row_count; float: frequency",
       " UNION ALL ".join(_common_sql(x) for x in _COLUMNS))
def _(t: Tables):
    return Q.common_values(_coded(t), _COLUMNS, 4)


@query("prof_correlation", "int: row_count; float: correlation", """
    SELECT n AS row_count, ROUND((n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)), 6) AS correlation FROM (
      SELECT COUNT(*)::DOUBLE AS n, SUM(x)::DOUBLE AS sx, SUM(y)::DOUBLE AS sy, SUM(x * y)::DOUBLE AS sxy, SUM(x * x)::DOUBLE AS sxx,
        SUM(y * y)::DOUBLE AS syy FROM (SELECT RANK() OVER (ORDER BY o_orderkey) AS x, RANK() OVER (ORDER BY o_orderdate) AS y FROM orders))""")
def _(t: Tables):
    return Q.order_correlation(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey", "o_orderdate")


@query("prof_selectivity", "text: o_orderstatus o_orderpriority; int: actual_rows; float: independent_rows joint_selectivity", f"""
    WITH j AS (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2)
    SELECT o_orderstatus, o_orderpriority, n AS actual_rows,
      {r('SUM(n) OVER (PARTITION BY o_orderstatus) * SUM(n) OVER (PARTITION BY o_orderpriority) / SUM(n) OVER ()')} AS independent_rows,
      {r('n / SUM(n) OVER ()', 6)} AS joint_selectivity FROM j""")
def _(t: Tables):
    return Q.selectivity(t.orders, "o_orderstatus", "o_orderpriority")


@query("prof_dependency", "int: n_distinct_first n_distinct_second n_distinct_pair; float: first_determines_second second_determines_first", f"""
    WITH j AS (SELECT n_name, r_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
      s AS (SELECT *, COUNT(*) OVER (PARTITION BY n_name) AS pa, COUNT(*) OVER (PARTITION BY r_name) AS pb FROM j)
    SELECT COUNT(DISTINCT n_name) AS n_distinct_first, COUNT(DISTINCT r_name) AS n_distinct_second, COUNT(*) AS n_distinct_pair,
      {r('SUM(CASE WHEN pa = 1 THEN n ELSE 0 END) / SUM(n)', 4)} AS first_determines_second,
      {r('SUM(CASE WHEN pb = 1 THEN n ELSE 0 END) / SUM(n)', 4)} AS second_determines_first FROM s""")
def _(t: Tables):
    placed = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).join(t.region, c("n_regionkey") == c("r_regionkey"))
    return Q.dependency(placed, "n_name", "r_name")


_PLACED = """(SELECT c_custkey, c_nationkey, n_name, r_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""
_PLACE_COLUMNS = ["c_custkey", "c_nationkey", "n_name", "r_name", "c_mktsegment"]


def _all_dependencies() -> str:
    """Error of every set and column, told if it is small and that of no part of the set is."""
    parts = []
    for size in range(len(_PLACE_COLUMNS)):
        for left in combinations(_PLACE_COLUMNS, size):
            for right in (x for x in _PLACE_COLUMNS if x not in left):
                keys = "".join(f"{x}, " for x in left)
                parts.append(f"""SELECT [{', '.join(repr(x) for x in left)}]::VARCHAR[] AS left_side, '{right}' AS dependent,
                  SUM(n - top) / SUM(n) AS error FROM (SELECT SUM(k) AS n, MAX(k) AS top FROM (SELECT {keys}{right}, COUNT(*) AS k
                  FROM {_PLACED} GROUP BY ALL) {'GROUP BY ' + ', '.join(left) if left else ''})""")
    return " UNION ALL ".join(parts)


@query("prof_dependencies", "text: determinant dependent; float: error", f"""
    WITH tried AS ({_all_dependencies()}), small AS (SELECT * FROM tried WHERE error <= 0.1)
    SELECT array_to_string(left_side, ',') AS determinant, dependent, ROUND(error, 6) AS error FROM small s WHERE NOT EXISTS (
      SELECT 1 FROM small p WHERE p.dependent = s.dependent AND len(p.left_side) < len(s.left_side) AND list_has_all(s.left_side, p.left_side))""")
def _(t: Tables):
    """All minimal dependencies among the columns of the placed customers, up to a tenth of the rows off."""
    placed = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).join(t.region, c("n_regionkey") == c("r_regionkey"))
    found = L.dependencies(placed, _PLACE_COLUMNS, max_error=0.1)
    return found.select(F.array_join("determinant", ",").alias("determinant"), "dependent", F.round("error", 6).alias("error"))


@query("prof_joint_values", "text: column_names items; int: value_rank row_count; float: frequency independent_frequency", """
    WITH o AS (SELECT o_orderstatus AS a, o_orderpriority AS b, CAST(year(o_orderdate) AS VARCHAR) AS d FROM orders), n AS (SELECT COUNT(*) AS n FROM o),
    joint AS (SELECT 'status,priority' AS column_names, a AS x, b AS y, COUNT(*) AS k FROM o GROUP BY a, b
      UNION ALL SELECT 'status,year', a, d, COUNT(*) FROM o GROUP BY a, d UNION ALL SELECT 'priority,year', b, d, COUNT(*) FROM o GROUP BY b, d),
    single AS (SELECT a AS v, COUNT(*) AS k FROM o GROUP BY 1 UNION ALL SELECT b, COUNT(*) FROM o GROUP BY 1 UNION ALL SELECT d, COUNT(*) FROM o GROUP BY 1),
    ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY column_names ORDER BY k DESC, x, y) AS value_rank FROM joint)
    SELECT column_names, x || '|' || y AS items, value_rank, r.k AS row_count, ROUND(r.k / n, 6) AS frequency,
      ROUND((p.k::DOUBLE / n) * (q.k::DOUBLE / n), 6) AS independent_frequency FROM ranked r, n, single p, single q WHERE p.v = x AND q.v = y AND value_rank <= 5""")
def _(t: Tables):
    rows = t.orders.select(c("o_orderstatus").alias("status"), c("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year"))
    return L.joint_common_values(rows, ["status", "priority", "year"], 5).withColumn("items", F.array_join("items", "|"))


def _kept_profiles(t: Tables) -> K.PartitionProfiles:
    """Profiles by year of order, the last year added by an update of its own."""
    dated = _coded(t).withColumn("year", F.year("o_orderdate"))
    store = K.PartitionProfiles(t.spark, scratch(t.spark, "profiles"), "year")
    last = dated.agg(F.max("year")).scalar()
    store.update(dated.filter(c("year") < last), [*_COLUMNS, "o_totalprice"])
    store.update(dated, [*_COLUMNS, "o_totalprice"])
    return store


@query("prof_kept_columns", "text: column_name; int: row_count; float: null_frac; bool: distinct_within", " UNION ALL ".join(
    f"SELECT '{x}' AS column_name, COUNT(*) AS row_count, {r(f'(COUNT(*) - COUNT({x})) / COUNT(*)', 4)} AS null_frac, TRUE AS distinct_within FROM {_CODED}"
    for x in [*_COLUMNS, "o_totalprice"]))
def _(t: Tables):
    """Profile merged from the sketches of each year; the distinct count is held against the exact one."""
    exact = Q.profile(_coded(t), [*_COLUMNS, "o_totalprice"]).select("column_name", c("n_distinct").alias("true_distinct"))
    merged = _kept_profiles(t).columns().join(exact, "column_name")
    within = F.abs(c("n_distinct") - c("true_distinct")) <= 4 * K.DISTINCT_ERROR * c("true_distinct")
    return merged.select("column_name", "row_count", "null_frac", within.alias("distinct_within"))


@query("prof_kept_common", "text: column_name value; int: value_rank row_count; float: frequency",
       " UNION ALL ".join(_common_sql(x) for x in ("o_orderstatus", "o_orderpriority", "code")))
def _(t: Tables):
    """Columns with few values: counts out of merged sketches are exact."""
    return _kept_profiles(t).common_values(4).filter(c("column_name").isin("o_orderstatus", "o_orderpriority", "code"))


@query("prof_kept_quantiles", "float: point; bool: rank_within", "SELECT unnest([0.1, 0.5, 0.9]) AS point, TRUE AS rank_within")
def _(t: Tables):
    """Where the merged quantiles of the price lie among all prices."""
    points = [0.1, 0.5, 0.9]
    found = _kept_profiles(t).quantiles(points).filter("column_name = 'o_totalprice'")
    values = found.agg(*[F.max(F.when(c("point") == p, c("value"))).alias(f"v{i}") for i, p in enumerate(points)])
    counted = t.orders.select("o_totalprice", *[values.select(v).scalar().alias(v) for v in values.columns])
    shares = counted.agg(*[F.mean((c("o_totalprice") <= c(v)).cast("int")).alias(v) for v in values.columns])
    told = F.array(*[F.struct(F.lit(p).alias("point"), (F.abs(c(f"v{i}") - p) <= 2 * K.RANK_ERROR).alias("rank_within")) for i, p in enumerate(points)])
    return shares.select(F.explode(told).alias("x")).select("x.*")


@query("prof_histogram", "int: bound; float: value", """
    WITH s AS (SELECT o_totalprice AS v, ROW_NUMBER() OVER (ORDER BY o_totalprice) AS rn, COUNT(*) OVER () AS n FROM orders)
    SELECT i AS bound, (SELECT MIN(v) FROM s WHERE rn >= CASE WHEN i = 0 THEN 1 ELSE CAST(CEIL(i * n / 20.0) AS BIGINT) END) AS value
    FROM (SELECT unnest(range(0, 21)) AS i)""")
def _(t: Tables):
    return Q.histogram(t.orders, "o_totalprice", 20)
