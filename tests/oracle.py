"""Compare registered queries with their SQL twins: names, types, rows and values."""

from __future__ import annotations

import math
import os

import duckdb

from lakemason.sources.tables import SCHEMAS

SPARK_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for name in SCHEMAS:
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)) for v in row)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    types = {n: str(d) for n, d in zip(relation.columns, relation.types)}
    for field in df.schema:
        if SPARK_TYPES[field.dataType.simpleString()] != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}"
    left = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    right = sorted(con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall(), key=_key)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    if not left:
        return "both sides are empty"
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-12))
            if not same:
                return f"{names}: {a} != {b}"
            if x != y:
                return f"inexact {names}: {a} ~ {b}"
    return None
