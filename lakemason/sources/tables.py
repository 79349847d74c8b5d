"""Typed table scans. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType, _parse_datatype_string

#: Column layout of the fourteen Parquet tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def schema_of(name: str) -> StructType:
    return _parse_datatype_string(SCHEMAS[name])


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan ``{folder}/{name}.parquet`` with its declared schema."""
    return spark.read.schema(schema_of(name)).parquet(f"{folder}/{name}.parquet")


def inline(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """Literal rows (a VALUES list) with a declared schema."""
    return spark.createDataFrame(rows, schema)


def integers(spark: SparkSession, start: int, stop: int, step: int = 1, name: str = "n") -> DataFrame:
    """Inclusive integer series, produced in parallel."""
    return spark.range(start, stop + (1 if step > 0 else -1), step).withColumnRenamed("id", name)


def days(spark: SparkSession, start: str, stop: str, name: str = "day") -> DataFrame:
    """One row per calendar day from ``start`` to ``stop``, both included."""
    return spark.sql(
        "SELECT explode(sequence(CAST(:start AS DATE), CAST(:stop AS DATE), INTERVAL 1 DAY)) AS day",
        args={"start": start, "stop": stop},
    ).withColumnRenamed("day", name)
