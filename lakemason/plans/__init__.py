"""Registered queries: each operator applied to the Parquet tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemason.plans.registry import QUERIES, Tables


def _load() -> None:
    from lakemason.plans import (  # noqa: F401  (importing registers)
        basics, dimensional, generated, hierarchies, ingestion, joining, layouts, profiling, semistructured, windowing,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: q.run for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: q.oracle() for name, q in QUERIES.items() if q.sql}


__all__ = ["Tables", "oracle_sql", "queries"]
