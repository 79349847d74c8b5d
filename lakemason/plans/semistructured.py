"""JSON texts: typed extraction, containment, filters and groups over fields. Twins use DuckDB's JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemason.functions.columns import json_contains, json_field, money, ratio
from lakemason.plans.registry import Tables, m, query, r

# Some rows without JSON, with a broken text, another type or a second field, chosen by event_id.
_PROPS = """(SELECT *, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '{broken' WHEN 2 THEN '{"k": "x"}'
    WHEN 3 THEN '{"k": 5, "source": "web"}' ELSE props END AS p FROM events)"""


def _props(t: Tables):
    n = F.col("event_id") % 7
    odd = F.when(n == 0, F.lit(None)).when(n == 1, "{broken").when(n == 2, '{"k": "x"}').when(n == 3, '{"k": 5, "source": "web"}')
    return t.events.withColumn("p", odd.otherwise(F.col("props")))


@query("json_extract", "int: event_id k; text: told source", f"""
    SELECT event_id, told, TRY_CAST(told AS BIGINT) AS k, source FROM (
      SELECT event_id, CASE WHEN json_valid(p) THEN p ->> '$.k' END AS told, CASE WHEN json_valid(p) THEN p ->> '$.source' END AS source
      FROM {_PROPS})""")
def _(t: Tables):
    """Fields as text and as a number; what does not convert is NULL."""
    return _props(t).select(
        "event_id", json_field("p", "k").alias("told"), json_field("p", "k", "bigint").alias("k"), json_field("p", "source").alias("source"))


@query("json_contains", "int: event_id user_id; text: p", f"""
    SELECT event_id, user_id, p FROM {_PROPS} WHERE json_valid(p) AND json_contains(CASE WHEN json_valid(p) THEN p END, '{{"k": 5}}')""")
def _(t: Tables):
    """Rows whose object holds a field with a value."""
    return _props(t).filter(json_contains("p", {"k": 5})).select("event_id", "user_id", "p")


@query("json_group", "int: decade events users; float: value mean", f"""
    SELECT decade, COUNT(*) AS events, COUNT(DISTINCT user_id) AS users, SUM(v) AS value, {r('SUM(v) / COUNT(*)')} AS mean
    FROM (SELECT CAST(props ->> '$.k' AS BIGINT) // 10 AS decade, user_id, {m('value')} AS v FROM events) WHERE decade >= 2 GROUP BY decade""")
def _(t: Tables):
    """A filter and a group over a typed field."""
    decade = F.floor(json_field("props", "k", "bigint") / 10)
    v = t.events.select(decade.alias("decade"), "user_id", money("value").alias("v")).filter("decade >= 2")
    total, n = F.sum("v"), F.count(F.lit(1))
    grouped = v.groupBy("decade").agg(n.alias("events"), F.count_distinct("user_id").alias("users"), total.alias("value"))
    return grouped.withColumn("mean", ratio(F.col("value"), F.col("events")))
