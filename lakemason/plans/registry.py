"""Query registry. A query states its output columns once; both the Spark result and the SQL twin
are cast to them, so the two sides agree on names and types."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemason.sources.tables import SCHEMAS, read

QUERIES: dict[str, Query] = {}


class Tables:
    """The tables of one folder as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return read(self.spark, self.folder, name)


def _spark_output(name: str, kind: str) -> Column:
    column = F.col(name)
    if kind == "time":
        column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif kind == "list":
        column = F.array_join(column.cast("array<string>"), ">")
    else:
        column = column.cast({"int": "bigint", "float": "double", "text": "string", "bool": "boolean"}[kind])
    return column.alias(name)


def _sql_output(name: str, kind: str) -> str:
    if kind == "time":
        return f"strftime(CAST({name} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS {name}"
    if kind == "list":
        return f"array_to_string({name}, '>') AS {name}"
    sql_type = {"int": "BIGINT", "float": "DOUBLE", "text": "VARCHAR", "bool": "BOOLEAN"}[kind]
    return f"CAST({name} AS {sql_type}) AS {name}"


@dataclass(frozen=True)
class Query:
    name: str
    columns: dict[str, str]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder)).select(*[_spark_output(n, k) for n, k in self.columns.items()])

    def oracle(self) -> str:
        outputs = ", ".join(_sql_output(n, k) for n, k in self.columns.items())
        return f"SELECT {outputs} FROM ({self.sql}) AS answer"


def query(name: str, columns: str, sql: str | None = None):
    """Register a query. ``columns`` reads ``"int: a b; float: c"``."""
    kinds = {}
    for part in columns.split(";"):
        kind, names = part.split(":")
        kinds |= {n: kind.strip() for n in names.split()}

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, kinds, build, sql)
        return build

    return register


def m(column: str) -> str:
    """SQL twin of ``functions.columns.money``."""
    return f"CAST({column} AS DECIMAL(18,2))"


def r(expression: str, digits: int = 2) -> str:
    """Half-up rounding in the SQL twin, through decimals."""
    return f"ROUND(CAST({expression} AS DECIMAL(38,10)), {digits})"
