"""Spelling variants: words one edit apart, grouped by following each word to a much more frequent neighbour.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. They are found by
scanning sorted lists with an edit matrix of three diagonals: a row of the matrix belongs to a prefix of the list,
so it is computed once and reused by all words that share the prefix, and where every cell of a row exceeds one edit,
the whole range of the list with that prefix is skipped.

One edit leaves the first or the second half of a word as it is, so the vocabulary is dealt into blocks of words that
share such a half, and a block is one sorted list. A block larger than ``BLOCK`` is dealt again by the halves of what
its words do not share, until two code points or fewer remain, so no task holds more than such a block whatever the
vocabulary looks like; no pair is lost by it.

Null and empty texts have no words; a null id counts as an empty one; repeated rows count again; extra columns are
ignored. Very long runs are words like others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakemason.llm.batches import small
from lakemason.session import cut

#: Words of a block that is not dealt again.
BLOCK = 20_000
#: Rows that a task scans at a time (whole blocks), and distinct words that it counts before it passes them on.
SCAN, COUNTED = 60_000, 300_000
#: A form is at least so many times as frequent.
TIMES = 5
#: One run in so many is misspelt on purpose.
PLANT = 199

# Fixed value: what a word is made of, after A-Z are lower-cased.
_RUN = re.compile("[a-zÀ-ÿ]+")


def runs(text: bytes | None, doc_id: int | None) -> Iterator[tuple[str, int]]:
    """The words of a text and how often they occur, planted misspellings made."""
    found = Counter(_RUN.findall((text or b"").lower().decode()))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in found.items():
        h = zlib.crc32(run.encode(), start)
        if h % PLANT == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def vocabulary(docs: DataFrame, least_length: int = 6, least: int = 5) -> DataFrame:
    """``word, n`` of the words with that many code points and occurrences."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            first = 0
            for part in small([batch.column(1)]):
                for doc_id, text in zip(ids[first : first + len(part)], part.to_pylist()):
                    for word, n in runs(text, doc_id):
                        if len(word) >= least_length:
                            seen[word] = seen.get(word, 0) + n
                first += len(part)
                if len(seen) > COUNTED:
                    yield flush()
                    seen = {}
        yield flush()

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(counted, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def halves(blocks: DataFrame) -> DataFrame:
    """Deal rows ``block, middle, word`` by the halves of ``middle``.

    Middles of m and m or m + 1 code points that are one edit apart share their first or last ``(m + 1) // 2``
    (of equal lengths: ``m // 2``), so each row goes to the blocks of both lengths, from the front and from the back.
    """
    size = F.length("middle")
    keys = F.array_distinct(F.array(F.floor(size / 2).cast("int"), F.floor((size + 1) / 2).cast("int")))
    dealt = blocks.select("block", "middle", "word", F.explode(keys).alias("k")).withColumn("side", F.explode(F.array(F.lit("<"), F.lit(">"))))
    front = F.col("side") == "<"
    shared = F.when(front, F.expr("left(middle, k)")).otherwise(F.expr("right(middle, k)"))
    rest = F.when(front, F.expr("substring(middle, k + 1)")).otherwise(F.expr("left(middle, length(middle) - k)"))
    return dealt.select(F.concat("block", "side", F.col("k").cast("string"), F.lit(":"), shared).alias("block"), rest.alias("middle"), "word")


def near_rows(blocks: np.ndarray, middles: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows that are one edit apart within a block; rows come sorted by block and middle.

    The lists of all blocks are scanned together, a code point further in each step. A node is a range of rows with
    a common prefix; ``node`` and ``query`` pair it with the later rows whose own prefix is within one edit of it, and
    the three arrays of ``row`` are the matrix row of each pair (two stands for two and more).
    """
    lengths = np.fromiter(map(len, middles), np.int64, len(middles))
    starts = np.cumsum(lengths) - lengths
    codes = np.append(np.frombuffer("".join(middles).encode("utf-32-le"), np.uint32).astype(np.int64), -1)

    def at(rows: np.ndarray, depth: int) -> np.ndarray:
        inside = (depth >= 0) & (depth < lengths[rows])
        return np.where(inside, codes[np.where(inside, starts[rows] + depth, len(codes) - 1)], -1)

    def spread(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All numbers of the ranges, and the range of each."""
        sizes = np.maximum(stop - first, 0)
        owner = np.repeat(np.arange(len(first)), sizes)
        return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner], owner

    edges = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])) if len(blocks) else np.zeros(0, np.int64)
    first, stop = edges, np.append(edges[1:], len(blocks))
    query, node = spread(first + 1, stop)
    row = [np.full(len(query), v, np.int8) for v in (2, 0, 1)]
    left, right, depth = [], [], 0
    while len(query):
        # a middle that ends here is compared with the queries that end here, one before or one after
        ended = lengths[first] == depth
        closing = ended[node]
        off = lengths[query] - depth
        for o in (-1, 0, 1):
            hit = closing & (off == o) & (row[o + 1] == 1)
            left.append(first[node[hit]])
            right.append(query[hit])
        # the ranges of the next code point
        inner, owner = spread(first + ended, stop)
        letter = at(inner, depth)
        opens = np.ones(len(inner), bool)
        opens[1:] = (owner[1:] != owner[:-1]) | (letter[1:] != letter[:-1])
        begin = np.flatnonzero(opens)
        child_first, child_letter, parent = inner[begin], letter[begin], owner[begin]
        child_stop = child_first + np.diff(np.append(begin, len(inner)))
        child_at = np.searchsorted(parent, np.arange(len(first) + 1))
        child, pair = spread(child_at[node], child_at[node + 1])
        # a range meets only rows behind its first one: of two near rows, the later is the query
        later = query[pair] > child_first[child]
        child, pair = child[later], pair[later]
        q, c, old = query[pair], child_letter[child], [r[pair] for r in row]
        new = []
        for o in (0, 1, 2):
            cell = old[o] + (at(q, depth + o - 1) != c)
            if o < 2:
                cell = np.minimum(cell, old[o + 1] + 1)
            if o:
                cell = np.minimum(cell, new[-1] + 1)
            new.append(np.minimum(cell, 2).astype(np.int8))
        alive = np.minimum(np.minimum(new[0], new[1]), new[2]) < 2
        node, query, row = child[alive], q[alive], [r[alive] for r in new]
        first, stop = child_first, child_stop
        depth += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of sorted rows ``block, middle, word``: whole blocks at a time."""
    blocks: list[str] = []
    middles: list[str] = []
    words: list[str] = []

    def found(stop: int) -> pa.RecordBatch:
        numbers = np.zeros(stop, np.int64)
        numbers[1:] = np.cumsum([a != b for a, b in zip(blocks[: stop - 1], blocks[1:stop])])
        a, b = near_rows(numbers, middles[:stop])
        pairs = [(words[i], words[j]) if words[i] < words[j] else (words[j], words[i]) for i, j in zip(a.tolist(), b.tolist())]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        for kept, column in zip((blocks, middles, words), batch.columns):
            kept.extend(column.to_pylist())
        if len(blocks) > SCAN:
            whole = len(blocks)
            while whole and blocks[whole - 1] == blocks[-1]:
                whole -= 1
            if whole:
                yield found(whole)
                del blocks[:whole], middles[:whole], words[:whole]
    if blocks:
        yield found(len(blocks))


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: each pair of the distinct ``word`` column that is one edit apart, once, ``a`` first in code-point order."""
    spark = words.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    open_rows = words.select(F.lit("").alias("block"), F.col("word").alias("middle"), "word")
    closed = []
    while open_rows is not None:
        dealt = halves(open_rows)
        sizes = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), F.max(F.length("middle")).alias("longest"))
        large = cut(sizes.filter((F.col("rows") > block) & (F.col("longest") > 2)).select("block"))
        if large.isEmpty():
            closed.append(dealt)
            open_rows = None
        else:
            closed.append(dealt.join(large, "block", "left_anti"))
            open_rows = cut(dealt.join(large, "block", "left_semi"))
    found = None
    for part in closed:
        rows = part.repartition(tasks, "block").sortWithinPartitions("block", "middle").mapInArrow(_scan, "a string, b string")
        found = rows if found is None else found.unionAll(rows)
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of rows ``word, form``: each round doubles the steps taken.

    A form is ``TIMES`` as frequent as its word, so a chain has at most 27 steps before counts leave 64 bits, and
    five rounds reach every end; rounds stop earlier when nothing moves.
    """
    steps = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(5):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = cut(moved)
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return steps


def group_variants(docs: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs``."""
    words = cut(vocabulary(docs))
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionAll(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left").withColumn("is_form", -F.col("best.less") >= TIMES * F.col("n"))
    joined = cut(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("is_form"), F.col("best.near")).alias("form"), F.when(F.col("is_form"), -F.col("best.less")).alias("form_n")))
    ends = roots(joined.filter(F.col("form").isNotNull()))
    return joined.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
