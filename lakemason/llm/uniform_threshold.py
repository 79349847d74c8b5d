"""Exact top-k by inner product with a three-phase uniform threshold.

A vector's score for a query is the sum of its partial scores over ``SLICES`` slices of the components, so the
slices are lists whose sums are sought. Rows lie in blocks; each block works on its share of every list.

1. Each block gathers, by query, the k best of each local list, resolves these rows and sends their k best
   scores. The k-th best score over all blocks is a safe cutoff: no result lies below it.
2. The cutoff goes back with the query. A score that reaches it has a partial score of at least a
   ``SLICES``-th of it in some list, so each block collects just the entries that reach this uniform threshold.
3. What was collected is resolved exactly; entries at or above the cutoff, k by block at most, are merged.

The sums are of integers, exact at any size: in doubles while these hold them, else in unbounded integers (a score
that does not fit a long is an error). Vectors of different lengths are not compared. See ``vectors.usable``
for nulls and repeated ids. Fewer candidates than k are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakemason.llm import vectors as V
from lakemason.session import cut

SLICES = 4
#: Queries scored against a block at a time.
TOGETHER = 64
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _exact(a: np.ndarray) -> np.ndarray:
    """Whole doubles whose products and sums stay exact, or else unbounded integers."""
    return a if not a.size or np.abs(a).max() < 1 << 22 else np.array([[int(x) for x in row] for row in a], object)


def partial_scores(vectors: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
    """One array (query, row) a slice."""
    cuts = np.linspace(0, vectors.shape[1], SLICES + 1).astype(int)
    v, q = _exact(vectors), _exact(queries)
    if v.dtype != q.dtype:
        v, q = (np.array([[int(x) for x in row] for row in a], object) for a in (vectors, queries))
    return [q[:, a:b] @ v[:, a:b].T for a, b in zip(cuts, cuts[1:])]


def _asked(batches: Iterator[pa.RecordBatch], extra: list[str]) -> Iterator[tuple]:
    for ids, vectors, (query_ids, query_vectors, *more) in V.blocks_of(batches, extra):
        for first in range(0, len(query_ids), TOGETHER):
            some = slice(first, first + TOGETHER)
            yield ids, query_ids[some], partial_scores(vectors, query_vectors[some]), *(m[some] for m in more)


def _sent(ids: np.ndarray, out: tuple, q: int, at: np.ndarray, totals: np.ndarray, k: int) -> None:
    top = V.best(ids[at], totals, k)
    for part, values in zip(out, (np.full(len(top), q), ids[at][top], totals[top])):
        part.append(np.array(values.tolist(), np.int64))


def top_k(df: DataFrame, queries, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 256.0,
          block_rows: int = 8192) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products of ``floor(scale * x)`` for each row that
    satisfies ``queries`` (a condition on ``vec_id``), among all other rows; ties to the smaller id."""
    rows = cut(V.usable(df, vec_id, vector, lambda x: _floored(x, scale), zero=True))
    n, asked = rows.count(), rows.filter(queries)

    def local_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, query_ids, parts in _asked(batches, []):
            out = [], [], []
            for i, q in enumerate(query_ids):
                others = np.flatnonzero(ids != q)
                lists = [others[V.best(ids[others], p[i][others], k)] for p in parts]
                at = np.unique(np.concatenate(lists))
                _sent(ids, out, q, at, sum(p[i][at] for p in parts), k)
            yield V.found_batch(*out, pa.int64())

    first = V.visits(rows, asked, block_rows, n).mapInArrow(local_lists, _FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    cutoffs = first.withColumn("place", place).filter(F.col("place") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("cutoff"))
    asked = cut(asked.join(cutoffs, "vec_id", "left"))

    def sufficient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, query_ids, parts, cutoff in _asked(batches, ["cutoff"]):
            out = [], [], []
            for i, (q, least) in enumerate(zip(query_ids, cutoff)):
                if least is None:  # fewer than k candidates: all are resolved
                    at = np.arange(len(ids))
                else:
                    at = np.flatnonzero(np.logical_or.reduce([p[i] * SLICES >= least for p in parts]))
                at = at[ids[at] != q]
                totals = sum(p[i][at] for p in parts)
                if least is not None:
                    at, totals = at[totals >= least], totals[totals >= least]
                _sent(ids, out, q, at, totals, k)
            yield V.found_batch(*out, pa.int64())

    return V.ranked(V.visits(rows, asked, block_rows, n).mapInArrow(sufficient, _FOUND), k)


def _floored(x, scale: float):
    """``floor(scale * x)`` kept as a double, which holds it whatever its size; non-finite stays so."""
    y = x * F.lit(scale)
    return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)
