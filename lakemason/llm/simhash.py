"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: every bit of a text's fingerprint is the majority of that bit over the 64-bit hashes of its
word shingles. Texts link if their fingerprints differ in at most ``radius`` bits.

Search: the 64 bits are grouped into partitions of correlated bits. If the thresholds of the partitions sum
to ``radius - partitions + 1``, any linked pair agrees within the threshold in at least one partition, and a
partition with threshold -1 need not be looked at. Each fingerprint gets the thresholds that a dynamic
program finds cheapest, from the estimated number of candidates in each partition at each distance (counts
of all distinct fingerprints by sub-block value, taken as independent where a partition has several
sub-blocks). It is then filed under its own value in each partition, and probes every value within its
threshold. Filed and probing fingerprints of one value meet in blocks of bounded size, are verified in
arrays, and only links that join two sets within a block are kept, which loses no component.

Nulls and texts without words have fingerprint zero. Distinct fingerprints are searched once, however often
they occur, so copies never meet in pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakemason.llm.batches import small
from lakemason.llm.components import components
from lakemason.session import cut

BITS = 64
#: Fingerprints of one side that meet in one block.
BLOCK = 2048
#: Largest sub-block of a partition whose values are counted: at most 2 ** SUB counts each.
SUB = 16


def fingerprint_of(text: bytes, shingle: int, seed: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
    hashes = np.array([xxhash.xxh64_intdigest(g, seed) for g in grams], ">u8")
    # bit counts in blocks, so that a long text needs no array of all its bits
    counts = sum(np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(hashes), 65536))
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: Column | str, shingle: int = 3, seed: int = 42) -> Column:
    """The fingerprint of a text as a (signed) long. ASCII letters are lower-cased, words are split at ASCII space."""

    @F.arrow_udf("bigint")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in small(batches):
            values = np.array([fingerprint_of(t, shingle, seed) for t in batch.to_pylist()], np.uint64)
            yield pa.array(values.view(np.int64), pa.int64())

    return fingerprints(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary"))


def _read(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def group_bits(prints: DataFrame, n: int, partitions: int) -> list[list[int]]:
    """Bits (0 the highest) in ``partitions`` groups of near-equal size; correlated bits go together.

    The 64 x 64 counts of bits set together are summed over all fingerprints; groups grow from the
    strongest remaining correlation.
    """

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            b = _bits(_read(batch)).astype(np.float64)
            total += b.T @ b
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel())], ["at", "n"])

    sums = prints.select("fp").mapInArrow(together, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(BITS * BITS)
    for row in sums:
        both[row.at] = row.n
    p = both.reshape(BITS, BITS) / max(1, n)
    mean = np.diag(p)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    link = np.abs((p - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(link, 0)
    free, groups = set(range(BITS)), []
    for k in range(partitions):
        size = len(free) // (partitions - k)
        left = sorted(free)
        part = link[np.ix_(left, left)]
        group = [left[int(part.sum(axis=1).argmax())]]
        free.discard(group[0])
        while len(group) < size:
            rest = sorted(free)
            best = rest[int(link[np.ix_(rest, group)].mean(axis=1).argmax())]
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def pick(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The value of a partition: the given bits of each fingerprint, first bit highest."""
    out = np.zeros(len(fps), np.uint64)
    for b in bits:
        out = out << np.uint64(1) | fps >> np.uint64(BITS - 1 - b) & np.uint64(1)
    return out


def _subs(group: list[int]) -> list[list[int]]:
    pieces = -(-len(group) // SUB)
    return [group[i * len(group) // pieces : (i + 1) * len(group) // pieces] for i in range(pieces)]


def count_values(prints: DataFrame, groups: list[list[int]]) -> dict[tuple[int, int], np.ndarray]:
    """How many fingerprints have each value of each sub-block; at most 2 ** SUB counts a sub-block."""
    subs = [(k, j, bits) for k, g in enumerate(groups) for j, bits in enumerate(_subs(g))]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _read(batch)
            for at, (_, _, bits) in enumerate(subs):
                values, n = np.unique(pick(fps, bits), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), at)), pa.array(values.astype(np.int64)), pa.array(n)], ["at", "value", "n"])

    sums = prints.select("fp").mapInArrow(counted, "at bigint, value bigint, n bigint").groupBy("at", "value").agg(F.sum("n").alias("n"))
    out = {(k, j): np.zeros(1 << len(bits)) for k, j, bits in subs}
    for at, value, n in sums.toLocalIterator():
        out[subs[at][:2]][value] = n
    return out


def _shells(counts: np.ndarray, radius: int) -> np.ndarray:
    """Fingerprints at exactly distance 0..radius from every value: one flipped bit at a time."""
    width = int(math.log2(len(counts)))
    at = np.arange(len(counts))
    flipped = lambda x: sum(x[at ^ (1 << b)] for b in range(width))
    shells = [counts]
    for d in range(1, radius + 1):
        reached = flipped(shells[-1]) - (width - d + 2) * (shells[-2] if d > 1 else 0)
        shells.append(np.maximum(reached, 0) / d)
    return np.array(shells)


def allocate(costs: np.ndarray, budget: int) -> np.ndarray:
    """Cheapest thresholds by fingerprint. ``costs[q, k, t + 1]`` is what threshold t costs in partition k; the
    thresholds of a fingerprint sum to ``budget``. Dynamic program over partitions and the sum so far."""
    queries, partitions, choices = costs.shape
    low = -partitions
    span = budget - low + 1 + choices
    best = np.full((queries, span), np.inf)
    best[:, -low] = 0
    taken = np.zeros((queries, partitions, span), np.int8)
    for k in range(partitions):
        fresh = np.full_like(best, np.inf)
        for t in range(-1, choices - 1):
            moved = np.full_like(best, np.inf)
            source = best[:, : span - t] if t >= 0 else best[:, 1:]
            if t >= 0:
                moved[:, t:] = source
            else:
                moved[:, :-1] = source
            moved += costs[:, k, t + 1, None]
            better = moved < fresh
            fresh[better] = moved[better]
            taken[:, k][better] = t
        best = fresh
    out, rows, at = np.zeros((queries, partitions), np.int8), np.arange(queries), np.full(queries, budget - low)
    for k in reversed(range(partitions)):
        out[:, k] = taken[rows, k, at]
        at = at - out[:, k]
    return out


def _ball(width: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` of ``width`` bits."""
    flips = (sum(1 << b for b in c) for d in range(radius + 1) for c in itertools.combinations(range(width), d))
    return np.fromiter(flips, np.uint64)


def _probes(fps: np.ndarray, groups: list[list[int]], shells: dict[tuple[int, int], np.ndarray], n: int, radius: int) -> Iterator[tuple]:
    """``(partition, value, role, fp)`` arrays: role 0 files a fingerprint, role 1 lets it probe."""
    choices = radius + 2
    costs = np.zeros((len(fps), len(groups), choices))
    values = [pick(fps, g) for g in groups]
    for k, g in enumerate(groups):
        # chance that a fingerprint lies at each distance in this partition, its sub-blocks taken as independent
        near = np.zeros((len(fps), radius + 1))
        near[:, 0] = 1
        for j, bits in enumerate(_subs(g)):
            part = shells[k, j][:, pick(fps, bits).astype(np.int64)].T / max(1, n)
            near = np.stack([sum(near[:, i] * part[:, d - i] for i in range(d + 1)) for d in range(radius + 1)], axis=1)
        reach = np.cumsum([math.comb(len(g), d) for d in range(radius + 1)])
        costs[:, k, 1:] = np.cumsum(near, axis=1) * n + reach
    thresholds = allocate(costs, radius - len(groups) + 1)
    for k, g in enumerate(groups):
        yield k, values[k], 0, fps
        for t in range(radius + 1):
            if (mine := thresholds[:, k] == t).any():
                ball = _ball(len(g), t)
                yield k, (values[k][mine][:, None] ^ ball[None, :]).ravel(), 1, np.repeat(fps[mine], len(ball))


def _file_and_probe(groups, shells, n: int, radius: int, block: int):
    """Rows of ``_probes`` with the block in which they meet: filed and probing fingerprints of a crowded value
    are dealt over rows and columns of a grid of blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _read(batch)
            for first in range(0, len(whole), 4096):
                for k, values, role, fps in _probes(whole[first : first + 4096], groups, shells, n, radius):
                    share = np.full(len(values), float(n))
                    shift = len(groups[k])
                    for j, bits in enumerate(_subs(groups[k])):
                        shift -= len(bits)
                        sub = (values >> np.uint64(shift)).astype(np.int64) & ((1 << len(bits)) - 1)
                        share = np.minimum(share, shells[k, j][0][sub])
                    if role:  # who probes a value is at most all within the radius of it; those filed near it are a fair guess
                        keep = share > 0
                        values, fps, share = values[keep], fps[keep], share[keep]
                    grid = np.maximum(1, np.ceil(share / block)).astype(np.int64)
                    mine = ((fps * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)) % grid
                    repeat = np.repeat(np.arange(len(values)), grid)
                    other = np.arange(len(repeat)) - np.repeat(np.cumsum(grid) - grid, grid)
                    row, column = (other, mine[repeat]) if role else (mine[repeat], other)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(repeat), k, np.int32)), pa.array(values[repeat].view(np.int64)), pa.array((row << 20 | column).astype(np.int64)),
                         pa.array(np.full(len(repeat), role, np.int32)), pa.array(fps[repeat].view(np.int64))], ["part", "value", "block", "role", "fp"])

    return rows


def spanning(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Positions of links that join two sets not joined by earlier ones."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    kept = []
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        a, b = root(a), root(b)
        if a != b:
            parent[a] = b
            kept.append(i)
    return kept


def _verify(radius: int):
    """Verified links of each block. Rows come sorted by block, filed ones first; a block may span batches."""

    def links(filed: np.ndarray, probing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = [], []
        for first in range(0, len(probing), BLOCK):
            some = probing[first : first + BLOCK]
            q, x = np.nonzero(np.bitwise_count(some[:, None] ^ filed[None, :]) <= radius)
            other = some[q] != filed[x]
            left.append(some[q[other]])
            right.append(filed[x[other]])
        return np.concatenate(left), np.concatenate(right)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[np.ndarray] = []

        def done(keys: np.ndarray, role: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            sizes = np.diff(np.append(starts, len(keys)))
            n_filed = np.add.reduceat(role == 0, starts) if len(starts) else sizes
            left, right = [], []
            useful = (n_filed > 0) & (n_filed < sizes)
            small = useful & (sizes <= 64)
            # small blocks: all pairs of filed and probing rows of many blocks at once
            filed, probing = n_filed[small], (sizes - n_filed)[small]
            pairs = filed * probing
            at = np.repeat(np.arange(len(pairs)), pairs)
            step = np.arange(len(at)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            base = starts[small][at]
            x, q = base + step % np.maximum(filed[at], 1), base + filed[at] + step // np.maximum(filed[at], 1)
            a, b = fps[q], fps[x]
            near = (np.bitwise_count(a ^ b) <= radius) & (a != b)
            left.append(a[near])
            right.append(b[near])
            for s, size, f in zip(starts[useful & ~small], sizes[useful & ~small], n_filed[useful & ~small]):
                a, b = links(fps[s : s + f], fps[s + f : s + size])
                kept = spanning(a, b)
                left.append(a[kept])
                right.append(b[kept])
            a, b = np.concatenate(left), np.concatenate(right)
            kept = spanning(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a[kept].view(np.int64)), pa.array(b[kept].view(np.int64))], ["a", "b"])

        for batch in batches:
            now = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("part", "value", "block", "role", "fp")], axis=1)
            if not len(now):
                continue
            pending.append(now)
            if len(pending) > 1 and (pending[0][0, :3] == now[-1, :3]).all():
                continue
            rows = np.concatenate(pending)
            last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
            stop = last[-1] + 1 if len(last) else 0
            pending = [rows[stop:]]
            if stop:
                yield from done(rows[:stop, :3], rows[:stop, 3], rows[:stop, 4].view(np.uint64))
        if pending:
            rows = np.concatenate(pending)
            yield from done(rows[:, :3], rows[:, 3], np.ascontiguousarray(rows[:, 4]).view(np.uint64))

    return verified


def link(prints: DataFrame, radius: int = 3, partitions: int | None = None, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``): enough of them to connect all that differ
    in at most ``radius`` bits. Partitions default to the fewest whose values are not crowded at this number
    of fingerprints (4 of 16 bits below 2 ** 22, 3 below 2 ** 34, else 2)."""
    n = prints.count()
    partitions = partitions or (4 if n < 1 << 22 else 3 if n < 1 << 34 else 2)
    groups = group_bits(prints, n, partitions)
    shells = {at: _shells(c, radius) for at, c in count_values(prints, groups).items()}
    rows = prints.select("fp").mapInArrow(_file_and_probe(groups, shells, n, radius, block), "part int, value bigint, block bigint, role int, fp bigint")
    met = rows.repartition("part", "value", "block").sortWithinPartitions("part", "value", "block", "role", "fp")
    return met.mapInArrow(_verify(radius), "a bigint, b bigint")


def _rooted(prints: DataFrame, radius: int) -> DataFrame:
    """The rows of distinct fingerprints with the ``root`` of their component: its smallest fingerprint."""
    roots = components(link(prints, radius), "a", "b")
    return prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3, shingle: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id reachable over links. A null id has its own
    fingerprint but is never the smallest, unless all ids of its component are null."""
    prints = cut(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text, shingle).alias("fp")))
    rooted = _rooted(cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))), radius)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3, shingle: int = 3) -> DataFrame:
    """Exactly one row of each component, whatever the ids: the first by id (nulls last), digest of the text and
    digest of the whole row. Rows equal in all columns are one row; equal ids alone join nothing."""
    key = F.col(f"`{doc_id}`")
    digest = F.sha2(F.col(f"`{text}`"), 256)
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]))
    marked = docs.withColumn("__row", F.sha2(F.concat_ws("/", F.coalesce(digest, F.lit("")), rest), 256))
    order = F.struct(key.isNull().alias("none"), key.alias("id"), digest.alias("digest"), F.col("__row").alias("row"))
    prints = cut(marked.select(order.alias("first"), fingerprint(F.col(f"`{text}`"), shingle).alias("fp")))
    rooted = _rooted(cut(prints.groupBy("fp").agg(F.min("first").alias("first"))), radius)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("__row"))
    return marked.dropDuplicates(["__row"]).join(kept, "__row", "left_semi").drop("__row")
