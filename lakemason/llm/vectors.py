"""What both vector searches share: usable vectors, and blocks of rows that queries visit."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


def usable(df: DataFrame, vec_id: str, vector: str, each: Callable[[Column], Column], zero: bool) -> DataFrame:
    """``vec_id, v`` with ``v`` an array of doubles. Rows with a null id, a null or empty vector, a null or
    non-finite component, or (unless ``zero``) only zeros take no part. Rows equal in id and vector count once;
    rows that share an id only are rows of their own: each is asked and offered, but never to its own id, and
    what the rows of one id find is ranked together."""
    v = F.transform(F.col(vector).cast("array<double>"), each)
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter("vec_id IS NOT NULL AND size(v) > 0").filter(~bad)
    if not zero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    return rows.distinct()


def visits(rows: DataFrame, queries: DataFrame, block_rows: int, n: int) -> DataFrame:
    """Rows dealt over blocks of about ``block_rows`` by a hash of id and vector, and every query (with its extra
    columns) sent to each block; blocks hold vectors of one length, rows before queries."""
    blocks = max(1, -(-n // block_rows))
    filed = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")).withColumn("role", F.lit(0))
    sent = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("role", F.lit(1))
    both = filed.unionByName(sent, allowMissingColumns=True).withColumn("dim", F.size("v"))
    return both.repartition(F.col("dim"), F.col("block")).sortWithinPartitions("dim", "block", "role", "vec_id")


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks_of(batches: Iterator[pa.RecordBatch], extra: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, Iterator[tuple]]]:
    """For each visited block its ids and vectors, and an iterator of query batches ``(ids, vectors, *extra)``."""

    def runs() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "block", "role")], axis=1)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
            for a, b in zip(starts, np.append(starts[1:], len(keys))):
                yield tuple(keys[a].tolist()), batch.slice(a, b - a)

    held, ids, vectors = None, [], []
    index = None
    for (dim, block, role), rows in runs():
        if held != (dim, block):
            held, ids, vectors, index = (dim, block), [], [], None
        i, v = rows.column("vec_id").to_numpy(zero_copy_only=False), matrix(rows.column("v"))
        if role == 0:
            ids.append(i)
            vectors.append(v)
            continue
        if not ids:
            continue
        if index is None:
            index = np.concatenate(ids), np.concatenate(vectors)
        yield *index, (i, v, *(rows.column(c).to_pylist() for c in extra))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if scores.dtype == object:  # unbounded integers
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def found_batch(query: list, found: list, scores: list, kind: pa.DataType) -> pa.RecordBatch:
    join = lambda parts, t: pa.array(np.concatenate(parts) if parts else [], t)
    return pa.RecordBatch.from_arrays([join(query, pa.int64()), join(found, pa.int64()), join(scores, kind)], ["query_id", "vec_id", "score"])


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all blocks, each of which sent its own k best at most."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")
