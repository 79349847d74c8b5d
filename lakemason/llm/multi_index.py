"""Approximate nearest neighbours by multi-index hashing over learned binary codes.

Codes: vectors are centred, turned onto their principal axes and then by a rotation learned so that the signs
of the turned components lose least (iterative quantisation). The 64 signs are the code. Index: codes are cut
into four substrings of 16 bits, and each block of rows files its codes by each substring. Search: codes within
Hamming distance r agree within r div 4 bits in one of the substrings (one bit less in those beyond r mod 4), so
probing these near values finds every code within r; the distance is then verified and the original vectors
of what is left are compared in double precision. A query that finds fewer than k codes in a block widens its
radius there, so k rows are returned wherever there are k.

The rotation and the radius (the distance within which ``target`` of the true neighbours in the sample lie) are
fitted on at most ``sample`` vectors, chosen by a hash; every row is indexed. Only vectors of one length are compared.
Each of the ``FITTED`` commonest lengths has a code of its own, fitted on its part of the sample; vectors of rarer lengths are
compared with all others of their length. See ``vectors.usable`` for nulls, zeros and repeated ids.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakemason.llm import vectors as V
from lakemason.session import cut

BITS, PARTS, WIDTH = 64, 4, 16
#: Vector lengths that have a fitted code.
FITTED = 16


@dataclass
class Codes:
    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors - self.mean) @ self.rotation > 0
        return np.packbits(signs, axis=1).view(">u8").ravel().astype(np.uint64)


def learn(vectors: np.ndarray, k: int, target: float, rounds: int = 30, queries: int = 512) -> Codes:
    """Mean, rotation and radius from a sample."""
    rng = np.random.default_rng(7)
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    axes = np.linalg.svd(centred.T @ centred)[0]
    columns = []
    for _ in range(-(-BITS // vectors.shape[1])):  # vectors shorter than the code are turned more than once
        turned = centred @ axes[:, :BITS]
        rotation = np.linalg.qr(rng.normal(size=(turned.shape[1], turned.shape[1])))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(turned @ rotation > 0, 1.0, -1.0).T @ turned)
            rotation = (u @ v).T
        columns.append(axes[:, :BITS] @ rotation)
    codes = Codes(mean, np.concatenate(columns, axis=1)[:, :BITS], BITS)
    all_codes, asked = codes.of(vectors), np.arange(min(queries, len(vectors)))
    scores = vectors[asked] @ vectors.T
    scores[asked, asked] = -np.inf
    top = np.argsort(-scores, axis=1)[:, : max(1, min(k, len(vectors) - 1))]
    distance = np.bitwise_count(all_codes[asked][:, None] ^ all_codes[top])
    codes.radius = int(np.quantile(distance, target, method="higher"))
    return codes


@functools.cache
def _ball(radius: int) -> np.ndarray:
    flips = (sum(1 << b for b in c) for d in range(radius + 1) for c in itertools.combinations(range(WIDTH), d))
    return np.fromiter(flips, np.uint16)


class Index:
    """One block's codes, filed by each substring."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.tables = codes, []
        for values in self._parts(codes).T:
            order = np.argsort(values, kind="stable")
            known, starts = np.unique(values[order], return_index=True)
            self.tables.append((known, np.append(starts, len(values)), order))

    @staticmethod
    def _parts(codes: np.ndarray) -> np.ndarray:
        return np.stack([codes >> np.uint64(WIDTH * i) & np.uint64(0xFFFF) for i in range(PARTS)], axis=1).astype(np.uint16)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Positions of all codes within ``radius``."""
        hit = np.zeros(len(self.codes), bool)
        for i, ((known, starts, order), value) in enumerate(zip(self.tables, self._parts(np.array([code]))[0])):
            near = radius // PARTS - (i > radius % PARTS)
            if near < 0:
                continue
            if near < 4 and len(ball := _ball(near)) < len(known):
                at = np.minimum(known.searchsorted(wanted := ball ^ value), len(known) - 1)
                at = at[known[at] == wanted]
            else:  # more values in reach than there are: look at those that are
                at = np.flatnonzero(np.bitwise_count(known ^ value) <= near)
            sizes = starts[at + 1] - starts[at]
            hit[order[np.repeat(starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]] = True
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.codes[found] ^ code) <= radius]


def _nearest(index: Index, code: np.uint64, radius: int, least: int) -> np.ndarray:
    """All codes within the first radius, from the given one on, that holds ``least`` codes."""
    at = index.within(code, radius)
    while len(at) < least and radius < BITS:
        radius = min(BITS, radius + PARTS)
        at = index.within(code, radius)
    return at


def search(df: DataFrame, queries, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", sample: int = 8192,
           target: float = 0.985, block_rows: int = 16_384) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k largest inner products found for each row that satisfies
    ``queries`` (a condition on ``vec_id``), among all other rows."""
    rows = cut(V.usable(df, vec_id, vector, lambda x: x, zero=False))
    length = F.size("v")
    common = rows.groupBy(length.alias("dim")).count().orderBy(F.desc("count"), "dim").limit(FITTED).collect()
    dims = [r.dim for r in common]
    place = F.row_number().over(Window.partitionBy(length).orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v"))
    part = rows.filter(length.isin(dims)).withColumn("place", place).filter(F.col("place") <= max(1, sample // max(1, len(dims))))
    chosen: dict[int, list[np.ndarray]] = {}
    for r in part.orderBy("place").select("v").collect():
        chosen.setdefault(len(r.v), []).append(np.array(r.v))
    fitted = {dim: learn(np.stack(some), k, target) for dim, some in chosen.items()}
    found_type = "query_id bigint, vec_id bigint, score double"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, codes, index = None, None, None
        for ids, vectors, (query_ids, query_vectors) in V.blocks_of(batches, []):
            if held is not ids:
                held, codes = ids, fitted.get(vectors.shape[1])
                index = Index(codes.of(vectors)) if codes else None
            out = [], [], []
            for q, x, code in zip(query_ids, query_vectors, codes.of(query_vectors) if codes else query_ids):
                at = _nearest(index, code, codes.radius, k + (ids == q).sum()) if codes else np.arange(len(ids))
                at = at[ids[at] != q]
                scores = (vectors[at] * x).sum(axis=1)
                top = V.best(ids[at], scores, k)
                for part, values in zip(out, (np.full(len(top), q), ids[at][top], scores[top])):
                    part.append(values)
            yield V.found_batch(*out, pa.float64())

    met = V.visits(rows, rows.filter(queries), block_rows, rows.count())
    return V.ranked(met.mapInArrow(look, found_type), k)
