"""Set operations. Both sides are tagged, appended and counted per distinct row: one shuffle, with
copies collapsed map-side, so a row repeated across a third of the table is no hot spot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def tagged_union(parts: dict[str, DataFrame], tag: str = "entity_type") -> DataFrame:
    """UNION ALL with a literal column naming each part."""
    tagged = [df.select(F.lit(name).alias(tag), "*") for name, df in parts.items()]
    result = tagged[0]
    for part in tagged[1:]:
        result = result.unionAll(part)
    return result


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    names = left.columns
    both = left.select("*", F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionAll(
        right.toDF(*names).select("*", F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    return both.groupBy(*names).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionAll(right.toDF(*left.columns)).distinct()


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return _counted(left, right).filter((F.col("__l") > 0) & (F.col("__r") > 0)).select(*left.columns)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return _counted(left, right).filter((F.col("__l") > 0) & (F.col("__r") == 0)).select(*left.columns)


def reconcile(left: DataFrame, right: DataFrame, left_tag: str = "ONLY_IN_STAGING", right_tag: str = "ONLY_IN_PROD") -> DataFrame:
    """Two-way diff on distinct rows: which rows exist on one side only."""
    one_sided = _counted(left, right).filter((F.col("__l") == 0) | (F.col("__r") == 0))
    tag = F.when(F.col("__l") > 0, F.lit(left_tag)).otherwise(F.lit(right_tag))
    return one_sided.select(tag.alias("diff_type"), *left.columns)


def reconcile_counts(left: DataFrame, right: DataFrame, left_tag: str = "ONLY_IN_STAGING", right_tag: str = "ONLY_IN_PROD") -> DataFrame:
    """Two-way diff that also sees different numbers of copies; ``surplus`` says how many."""
    surplus = F.col("__l") - F.col("__r")
    tag = F.when(surplus > 0, F.lit(left_tag)).otherwise(F.lit(right_tag))
    return _counted(left, right).filter(surplus != 0).select(
        tag.alias("diff_type"), *left.columns, F.abs(surplus).alias("surplus")
    )
