"""Column profiles kept by partition: a new partition is read once, old ones never again.

For every partition of a table and every column a small row is stored: exact counts of rows, NULLs and characters, and
three sketches of the values. Sketches of different partitions merge without loss, so the profile of the
whole table, or of any of its partitions, is an aggregate of stored rows. The stated errors hold for merged sketches:

* distinct values: relative standard error ``DISTINCT_ERROR`` (HyperLogLog);
* quantiles of numbers: the rank of an answer is off by at most ``RANK_ERROR`` of the rows, 99 times in 100 (KLL);
* common values: a count is off by at most ``COUNT_ERROR`` of the rows, and exact while a column has at most
  ``TRACKED`` values (frequent items).

A partition's own sketches are aggregated where its rows are read, and one row for each task and partition is shuffled.
NULLs are counted but are no values. Profiling a partition again replaces its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

HLL_BITS = 12
KLL_K = 400
TRACKED = 10_000
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
RANK_ERROR = 2.296 / KLL_K**0.9723
COUNT_ERROR = 3.5 / 16_384
#: The label of rows without a partition value.
NO_LABEL = "(null)"

_STORED = (
    "row_count bigint, null_count bigint, width bigint, distinct_sketch binary, quantile_sketch binary, "
    "common_sketch struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>")


def _number(df: DataFrame, column: str) -> Column | None:
    """The column as a number that quantiles are taken of; dates and times in days and seconds."""
    kind = df.schema[column].dataType
    if isinstance(kind, NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double") / 1_000_000
    return None


class PartitionProfiles:
    """Stored profiles of one table under ``path``; ``part`` is its partition column, or any column with few values."""

    def __init__(self, spark: SparkSession, path: str, part: str):
        self.spark, self.path, self.part = spark, path, part

    def labels(self) -> set[str]:
        """Partitions profiled so far."""
        stored = self._stored()
        return set() if stored is None else {r.part for r in stored.select("part").distinct().collect()}

    def _stored(self) -> DataFrame | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        return self.spark.read.schema(f"{_STORED}, column_name string, part string").parquet(self.path)

    def update(self, df: DataFrame, columns: Sequence[str], labels: Sequence[str] | None = None) -> list[str]:
        """Profile the partitions named, or those of ``df`` that are not stored yet; returns their labels.

        One scan of these partitions. Where ``part`` is a partition column of the files, only their files are read.
        """
        label = F.coalesce(F.col(self.part).cast("string"), F.lit(NO_LABEL))
        if labels is None:
            known = self.labels()
            labels = sorted(r.part for r in df.select(label.alias("part")).distinct().collect() if r.part not in known)
        if not labels:
            return []
        plain = [x for x in labels if x != NO_LABEL]
        wanted = F.col(self.part).isin([F.lit(x).cast(df.schema[self.part].dataType) for x in plain]) if plain else F.lit(False)
        rows = df.filter(wanted | F.col(self.part).isNull() if NO_LABEL in labels else wanted)
        rows.groupBy(label.alias("part")).agg(*[self._cell(df, c).alias(f"c{i}") for i, c in enumerate(columns)]).select(
            "part", F.explode(F.array(*[F.col(f"c{i}") for i in range(len(columns))])).alias("cell")
        ).select("cell.*", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(self.path)
        return list(labels)

    @staticmethod
    def _cell(df: DataFrame, column: str) -> Column:
        value, number = F.col(column).cast("string"), _number(df, column)
        quantiles = F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number, F.lit(KLL_K))
        return F.struct(
            F.count(F.lit(1)).alias("row_count"), F.count_if(value.isNull()).alias("null_count"),
            F.coalesce(F.sum(F.length(value)), F.lit(0)).cast("bigint").alias("width"), F.hll_sketch_agg(value, HLL_BITS).alias("distinct_sketch"),
            quantiles.alias("quantile_sketch"), F.call_function("approx_top_k_accumulate", value, F.lit(TRACKED)).alias("common_sketch"),
            F.lit(column).alias("column_name"))

    def _of(self, labels: Sequence[str] | None) -> DataFrame:
        stored = self._stored()
        if stored is None:
            raise FileNotFoundError(f"nothing is profiled at {self.path}")
        return stored if labels is None else stored.filter(F.col("part").isin(list(labels)))

    def columns(self, labels: Sequence[str] | None = None) -> DataFrame:
        """``column_name, row_count, null_frac, n_distinct, avg_width`` from the stored rows alone."""
        rows, nulls = F.sum("row_count"), F.sum("null_count")
        return self._of(labels).groupBy("column_name").agg(
            rows.alias("row_count"), F.round(nulls / rows, 4).alias("null_frac"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
            F.round(F.sum("width") / F.nullif(rows - nulls, F.lit(0)), 2).alias("avg_width"))

    def quantiles(self, points: Sequence[float], labels: Sequence[str] | None = None) -> DataFrame:
        """``column_name, point, value`` of the number columns; columns of only NULLs have none."""
        merged = self._of(labels).filter("quantile_sketch IS NOT NULL AND row_count > null_count").groupBy("column_name").agg(
            F.kll_merge_agg_double("quantile_sketch").alias("sketch"))
        ranks = F.array(*[F.lit(float(p)) for p in points])
        values = F.kll_sketch_get_quantile_double("sketch", ranks)
        return merged.select("column_name", F.explode(F.arrays_zip(ranks.alias("point"), values.alias("value"))).alias("q")).select("column_name", "q.point", "q.value")

    def common_values(self, k: int, labels: Sequence[str] | None = None) -> DataFrame:
        """``column_name, value_rank, value, row_count, frequency`` of the ``k`` most frequent values by column."""
        merged = self._of(labels).groupBy("column_name").agg(
            F.call_function("approx_top_k_combine", F.col("common_sketch"), F.lit(TRACKED)).alias("sketch"), F.sum("row_count").alias("__all"))
        # ties at the end of the list are broken by value, so more are taken out of the sketch than are told
        top = merged.select("column_name", "__all", F.explode(F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(min(TRACKED, 50 * k)))).alias("x"))
        order = Window.partitionBy("column_name").orderBy(F.col("x.count").desc(), F.col("x.item"))
        ranked = top.filter("x.item IS NOT NULL").withColumn("value_rank", F.row_number().over(order)).filter(F.col("value_rank") <= k)
        return ranked.select(
            "column_name", "value_rank", F.col("x.item").alias("value"), F.col("x.count").alias("row_count"), F.round(F.col("x.count") / F.col("__all"), 4).alias("frequency"))
