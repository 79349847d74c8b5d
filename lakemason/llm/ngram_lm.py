"""Interpolated modified Kneser-Ney language model, counted in Spark, scored from memory-mapped arrays.

Training is three passes that shuffle packed arrays, never single rows:

1. words: hashes of a task's words are counted there, merged by hash range, and written as sorted arrays of
   hashes with their counts. A word's id is its place in these arrays.
2. pairs: each task counts its word pairs ``(history id << 32 | word id)``; pairs are dealt over shards by
   their history (a frequent history over several shards, by its count), merged and written as sorted arrays.
3. statistics: what each shard knows about histories (how often they occur, with how many words once, twice,
   more often) and about words (after how many histories they occur) is summed by id range into dense arrays.

Scoring maps those files into memory in each worker and looks up a batch of tokens in sorted order. Files lie in
the shared checkpoint folder; where that is not a mounted file system a worker fetches a file when it first
needs it, into a file that has no name any more once it is mapped.

A text is its words (ASCII-lower-cased, split at ASCII space) and one end token, the first after a boundary.
A null or empty text is just the end token. Texts are scored one by one; repeated rows get equal scores.
An untrained model gives every token probability one over its vocabulary and the unknown word.
"""

from __future__ import annotations

import functools
import itertools
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemason.session import scratch

#: The end token; no word hashes the empty string.
END = xxhash.xxh64_intdigest(b"")
#: Tokens counted and tokens scored together in a task, and tokens that one shard of pairs gets on average.
CHUNK, SCORED, PER_SHARD = 1_000_000, 200_000, 2_000_000
#: Words per file of word statistics.
PER_RANGE = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)

_hashes: dict[bytes, int] = {}


def _new(word: bytes) -> int:
    if len(_hashes) > 250_000:
        _hashes.clear()
    h = _hashes[word] = xxhash.xxh64_intdigest(word)
    return h


def tokens(text: bytes) -> list[int]:
    """Hashes of a text's words, then the end token."""
    known = _hashes
    return [known.get(w) or _new(w) for w in text.lower().split()] + [END]


def _chunks(batches: Iterable[pa.RecordBatch], most: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token hashes of many texts one behind another, and the number of tokens of each text."""
    flat, lengths, size = [], [], 0
    for batch in batches:
        for text in batch.column("text"):
            found = np.array(tokens(text.as_py()), np.uint64)
            flat.append(found)
            lengths.append(len(found))
            size += len(found)
            if size >= most:
                yield np.concatenate(flat), np.array(lengths)
                flat, lengths, size = [], [], 0
    if flat:
        yield np.concatenate(flat), np.array(lengths)


# Files of plain arrays


def _system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def _write(folder: str, *arrays: np.ndarray) -> str:
    """A new file that holds the arrays one behind another. Each attempt of a task writes its own file."""
    system, path = _system(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}.bin"
    with system.open_output_stream(f"{path}/{name}") as out:
        for array in arrays:
            out.write(np.ascontiguousarray(array).tobytes())
    return f"{folder}/{name}"


@functools.lru_cache(maxsize=4096)
def _mapped(uri: str) -> np.ndarray:
    system, path = _system(uri)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    with tempfile.NamedTemporaryFile() as local, system.open_input_stream(path) as remote:
        while block := remote.read(1 << 22):
            local.write(block)
        local.flush()
        return np.memmap(local.name, np.uint8, "r") if local.tell() else np.zeros(0, np.uint8)


def _fields(uri: str, n: int, *kinds: str) -> list[np.ndarray]:
    """The arrays of a file, ``n`` entries each."""
    data, out, at = _mapped(uri), [], 0
    for kind in map(np.dtype, kinds):
        out.append(data[at : at + n * kind.itemsize].view(kind))
        at += n * kind.itemsize
    return out


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[starts], np.add.reduceat(c, starts) if len(starts) else c


_PACKED = "shard bigint, keys binary, counts binary"


def _packed(shards: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One row a shard, keys as 8-byte and counts as 4-byte integers."""
    order = np.argsort(shards, kind="stable")
    shards, keys, counts = shards[order], keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])) if len(shards) else np.zeros(0, np.int64)
    stops = np.append(starts[1:], len(shards))
    rows = [(int(shards[a]), keys[a:b].astype("<u8").tobytes(), counts[a:b].astype("<u4").tobytes()) for a, b in zip(starts, stops)]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["shard", "keys", "counts"])


def _by_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Merged keys and counts of each shard; rows come sorted by shard."""
    rows = itertools.chain.from_iterable(b.to_pylist() for b in batches)
    for shard, group in itertools.groupby(rows, lambda r: r["shard"]):
        group = list(group)
        yield shard, *_merged([np.frombuffer(r["keys"], "<u8") for r in group], [np.frombuffer(r["counts"], "<u4").astype(np.int64) for r in group])


def _dealt(packed: DataFrame, shards: int) -> DataFrame:
    return packed.repartition(min(shards, 4096), "shard").sortWithinPartitions("shard")


# The model


@dataclass
class Words:
    """Sorted arrays of word hashes by the high bits of the hash, and their counts."""

    bits: int
    files: list[str]
    sizes: list[int]
    total: int

    def __post_init__(self):
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    @property
    def distinct(self) -> int:
        return int(self.offsets[-1])

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts. Hashes are looked up once each, in order."""
        wanted, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(wanted), -1), np.zeros(len(wanted), np.int64)
        cuts = np.searchsorted(wanted >> np.uint64(64 - self.bits), np.arange(len(self.files) + 1))
        for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a == b or not self.sizes[s]:
                continue
            known, n = _fields(self.files[s], self.sizes[s], "<u8", "<i8")
            at = np.minimum(known.searchsorted(wanted[a:b]), len(known) - 1)
            hit = known[at] == wanted[a:b]
            ids[a:b] = np.where(hit, self.offsets[s] + at, -1)
            counts[a:b] = np.where(hit, n[at], 0)
        return ids[back], counts[back]


@dataclass
class Model:
    words: Words
    shards: int
    pair_files: dict[int, tuple[str, int]]
    range_files: dict[int, tuple[str, int]]
    discounts: np.ndarray
    low_discounts: np.ndarray
    pair_types: int
    low_left: float
    per_shard: int = PER_SHARD

    def shard_of(self, history: np.ndarray, count: np.ndarray, word: np.ndarray) -> np.ndarray:
        return shard_of(history, count, word, self.shards, self.per_shard)

    def stats(self, ids: np.ndarray) -> np.ndarray:
        """Rows ``(occurrences as history, with 1, 2, more words, histories before it)`` by word id."""
        wanted, back = np.unique(ids, return_inverse=True)
        out = np.zeros((len(wanted), 5), np.int64)
        cuts = np.searchsorted(wanted // PER_RANGE, np.arange(-1, max(self.range_files, default=-1) + 2))
        for r, (a, b) in enumerate(zip(cuts, cuts[1:]), -1):
            if a < b and r in self.range_files:
                path, n = self.range_files[r]
                out[a:b] = _fields(path, n * 5, "<i8")[0].reshape(n, 5)[wanted[a:b] - r * PER_RANGE]
        return out[back]

    def pair_counts(self, history: np.ndarray, history_count: np.ndarray, word: np.ndarray) -> np.ndarray:
        keys = history.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)
        shards = self.shard_of(history, history_count, word)
        order = np.lexsort((keys, shards))
        counts = np.zeros(len(keys), np.int64)
        k, s = keys[order], shards[order]
        cuts = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(s))):
            if int(s[a]) not in self.pair_files:
                continue
            path, n = self.pair_files[int(s[a])]
            known, c = _fields(path, n, "<u8", "<u4")
            at = np.minimum(known.searchsorted(k[a:b]), n - 1)
            counts[order[a:b]] = np.where(known[at] == k[a:b], c[at], 0)
        return counts

    def probabilities(self, hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability and training count of each token; ``firsts`` are where texts begin."""
        ids, counts = self.words.lookup(hashes)
        end_id, end_count = (int(x[0]) for x in self.words.lookup(np.array([END], np.uint64)))
        history, history_count = np.roll(ids, 1), np.roll(counts, 1)
        history[firsts], history_count[firsts] = end_id, end_count
        after, at = self.stats(history), self.stats(ids)[:, 4]
        low = np.maximum(at - self.low_discounts[np.minimum(at, 3)], 0) / max(1, self.pair_types)
        low += self.low_left / (self.words.distinct + 1)
        both = (ids >= 0) & (history >= 0)
        seen = np.zeros(len(ids), np.int64)
        seen[both] = self.pair_counts(history[both], history_count[both], ids[both])
        total = after[:, 0]
        high = np.maximum(seen - self.discounts[np.minimum(seen, 3)], 0)
        left = after[:, 1:4] @ self.discounts[1:]
        return np.where(total > 0, (high + left * low) / np.maximum(total, 1), low), counts


def shard_of(history: np.ndarray, count: np.ndarray, word: np.ndarray, shards: int, per_shard: int) -> np.ndarray:
    """Shard of a pair: by its history; a history with many tokens has several shards, chosen by the word."""
    split = np.maximum(1, -(-count * 4 // per_shard)).astype(np.uint64)
    part = (word.astype(np.uint64) * MIX >> np.uint64(33)) % split
    mixed = (history.astype(np.uint64) + np.uint64(1)) * MIX + part * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed ^ mixed >> np.uint64(32)) * MIX >> np.uint64(40)).astype(np.int64) % shards


def discounts(of_counts: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many n-grams have count 1, 2, 3, 4."""
    n1, n2, n3, n4 = (max(float(x), 0.5) for x in of_counts)
    y = n1 / (n1 + 2 * n2)
    return np.array([0.0, *(min(max(k - (k + 1) * y * more / less, 0.05), k - 0.05) for k, less, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))])


def text_column(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")


def _train_words(texts: DataFrame, folder: str, bits: int) -> Words:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, _ in _chunks(batches):
            keys, counts = np.unique(flat, return_counts=True)
            yield _packed((keys >> np.uint64(64 - bits)).astype(np.int64), keys, counts)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in _by_shard(batches):
            path = _write(folder, keys.astype("<u8"), counts.astype("<i8"))
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n": len(keys), "total": int(counts.sum())}])

    packed = _dealt(texts.mapInArrow(count, _PACKED), 1 << bits)
    stored = {r.shard: r for r in packed.mapInArrow(store, "shard bigint, path string, n bigint, total bigint").collect()}
    each = range(1 << bits)
    return Words(bits, [stored[s].path if s in stored else "" for s in each], [stored[s].n if s in stored else 0 for s in each], sum(r.total for r in stored.values()))


def train(texts: DataFrame, per_shard: int = PER_SHARD) -> Model:
    """A model of the column ``text`` (binary). What the driver gets is a row a file; files hold about ``per_shard``
    tokens each, so their number follows the input."""
    spark: SparkSession = texts.sparkSession
    folder = scratch(spark, "ngram")
    bits = max(6, (texts.count() // 2048).bit_length())  # about as many files of words as thousands of texts
    words = _train_words(texts, f"{folder}/words", bits)
    shards = max(16, -(-words.total // per_shard))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, lengths in _chunks(batches):
            ids, counts = words.lookup(flat)
            end_id, end_count = (x[0] for x in words.lookup(np.array([END], np.uint64)))
            firsts = np.cumsum(lengths) - lengths
            history, many = np.roll(ids, 1), np.roll(counts, 1)
            history[firsts], many[firsts] = end_id, end_count
            keys = history.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64)
            keys, at, n = np.unique(keys, return_index=True, return_counts=True)
            yield _packed(shard_of(history[at], many[at], ids[at], shards, per_shard), keys, n)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in _by_shard(batches):
            path = _write(f"{folder}/pairs", keys.astype("<u8"), counts.astype("<u4"))
            of_counts = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n": len(keys), "of_counts": of_counts}])

    pairs = _dealt(texts.mapInArrow(count, _PACKED), shards)
    stored = pairs.mapInArrow(store, "shard bigint, path string, n bigint, of_counts array<bigint>").collect()

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys ``id * 5 + field`` and sums, by range of ids."""
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _fields(row["path"], row["n"], "<u8", "<u4")
                history, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
                starts = np.flatnonzero(np.append(True, history[1:] != history[:-1]))
                counts = counts.astype(np.int64)
                sums = [np.add.reduceat(counts, starts), *(np.add.reduceat((np.minimum(counts, 3) == k).astype(np.int64), starts) for k in (1, 2, 3))]
                words_seen, before = np.unique(word, return_counts=True)
                who = np.concatenate([*(history[starts] * 5 + i for i in range(4)), words_seen * 5 + 4])
                n = np.concatenate([*sums, before])
                # counts travel as 32 bits; a larger sum is sent in parts
                while len(n):
                    yield _packed(who[n > 0] // (5 * PER_RANGE), who[n > 0], np.minimum(n[n > 0], 0xFFFFFFFF))
                    n = n - 0xFFFFFFFF
                    who, n = who[n > 0], n[n > 0]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in _by_shard(batches):
            dense = np.zeros(PER_RANGE * 5, np.int64)
            dense[keys.astype(np.int64) - shard * PER_RANGE * 5] = counts
            of_counts = np.bincount(np.minimum(dense[4::5], 5), minlength=6)[1:].tolist()
            path = _write(f"{folder}/stats", dense.astype("<i8"))
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n": PER_RANGE, "of_counts": of_counts}])

    files = spark.createDataFrame([(r.path, r.n) for r in stored] or [("", 0)], "path string, n bigint").filter("n > 0")
    files = files.repartition(max(1, min(len(stored), 4096)))
    by_range = _dealt(files.mapInArrow(statistics, _PACKED), -(-words.distinct // PER_RANGE) or 1)
    dense = by_range.mapInArrow(ranges, "shard bigint, path string, n bigint, of_counts array<bigint>").collect()

    low_counts = np.sum([r.of_counts for r in dense], axis=0) if dense else np.zeros(5)
    high, low = discounts(np.sum([r.of_counts for r in stored], axis=0) if stored else np.zeros(4)), discounts(low_counts[:4])
    types = sum(r.n for r in stored)
    left = (low[1] * low_counts[0] + low[2] * low_counts[1] + low[3] * low_counts[2:].sum()) / types if types else 1.0
    return Model(words, shards, {r.shard: (r.path, r.n) for r in stored}, {r.shard: (r.path, r.n) for r in dense}, high, low, types, float(left), per_shard)


RESULT = "struct<n_tokens: bigint, n_known: bigint, base_score: double, score: double>"


def score(text: Column | str, model: Model) -> Column:
    """Tokens, tokens seen in training, log10 probability under smoothed word counts, and under the model."""
    sent = _sent(model)

    @F.arrow_udf(RESULT)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        scale = m.words.total + 0.1 * (m.words.distinct + 1)
        for batch in batches:
            parts = [np.zeros((0, 4))]
            for flat, lengths in _chunks([pa.RecordBatch.from_arrays([batch], ["text"])], SCORED):
                firsts = np.cumsum(lengths) - lengths
                p, counts = m.probabilities(flat, firsts)
                columns = (np.ones(len(flat)), counts > 0, np.log10((counts + 0.1) / scale), np.log10(p))
                parts.append(np.stack([np.add.reduceat(c.astype(float), firsts) for c in columns], axis=1))
            rows = np.concatenate(parts)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.StructArray.from_arrays(
                [pa.array(rows[:, i].astype(np.int64) if i < 2 else rows[:, i], k) for i, k in enumerate(kinds)], names=["n_tokens", "n_known", "base_score", "score"])

    return scored(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary"))


def _sent(model: Model):
    """The model's file names and totals (not its arrays) for the tasks: a name per PER_SHARD tokens."""
    return SparkSession.active().sparkContext.broadcast(model)


def perplexity(score: Column, n_tokens: Column) -> Column:
    """Per-token perplexity from a log10 score."""
    return F.pow(F.lit(10.0), -score / n_tokens)
