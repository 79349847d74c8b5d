"""Text quality: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Features are single words and pairs, and pairs and triples of word shapes (case, digits, the marks a word
ends in, whether it repeats the word before), each hashed into one of ``2**BITS`` slots. Within a family
every occurrence counts one over the number of occurrences, so long and short texts compare. A score is
the sparse dot product of a text's features with the weights, through a logistic curve.

A null or empty text has only the bias and gets the base score. Rows are scored one by one: repeated rows
get equal scores, extra columns stay. Without labelled rows every score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakemason.llm.batches import small
from lakemason.llm.labelled import training_rows

BITS = 18
FAMILIES = 4
#: What one family weighs in a text; the bias has slot 0.
SCALE = 8.0
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_MARKS = re.compile(rb"[^\w\x80-\xff]+$")
_words: dict[bytes, int] = {}


def _hash_word(word: bytes) -> int:
    """Upper 32 bits: the word. Lower 32 bits: its shape."""
    marks = _MARKS.search(word)
    body = word[: marks.start()] if marks else word
    shape = (
        b"0" if body.isdigit() else b"A" if body.isupper() and len(body) > 1 else b"Aa" if body[:1].isupper()
        else b"a" if body.islower() else b"?" if body else b"",
        bytes([min(len(body), 12)]) if len(body) < 3 else b"",
        marks.group()[:4] if marks else b"",
    )
    code = xxhash.xxh32_intdigest(word) << 32 | xxhash.xxh32_intdigest(b"\0".join(shape))
    if len(_words) > 150_000:
        _words.clear()
    _words[word] = code
    return code


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text, one entry an occurrence."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(1, np.int64), np.ones(1)
    known = _words
    codes = np.fromiter([known.get(w) or _hash_word(w) for w in words], np.uint64, n)
    word, shape = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
    shape[1:] += (codes[1:] == codes[:-1]).astype(np.uint64) << np.uint64(33)
    a, b, c = _MIX
    families = [word * a, word[:-1] * a + word[1:] * b, shape[:-1] * b + shape[1:] * c, shape[:-2] * a + shape[1:-1] * c + shape[2:] * b]
    shift = np.uint64(64 - BITS)
    slots = [((f ^ f >> np.uint64(29)) * a >> shift).astype(np.int64) for f in families]
    return np.concatenate([np.zeros(1, np.int64), *slots]), np.concatenate([[1.0], *[np.full(len(s), SCALE / max(1, len(s))) for s in slots]])


@dataclass
class Ftrl:
    """The leader's state: gradient sums ``z`` and squared-gradient sums ``n`` by slot."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 1.0

    def __post_init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(self, slots: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        slots, at = np.unique(slots, return_inverse=True)
        values = np.bincount(at, values)
        w = self.weights(slots)
        g = (1 / (1 + np.exp(-np.clip(w @ values, -30, 30))) - label) * values
        self.z[slots] += g - (np.sqrt(self.n[slots] + g * g) - np.sqrt(self.n[slots])) / self.alpha * w
        self.n[slots] += g * g


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", max_rows: int = 12_000, epochs: int = 2) -> np.ndarray:
    """Weights by slot, learned in order of a hash of the id from at most ``max_rows`` labelled rows (the
    bound of the sample; the updates are sequential, so one task makes them)."""
    rows = training_rows(docs, labels, target, max_rows)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = Ftrl()
        seen = [(*features(t), y) for b in batches for t, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist())]
        for _ in range(epochs):
            for slots, values, label in seen:
                leader.learn(slots, values, label)
        yield pa.RecordBatch.from_arrays([pa.array([leader.weights().astype("<f4").tobytes()], pa.binary())], ["weights"])

    ordered = rows.select(F.col("text").cast("binary").alias("text"), "label", F.xxhash64("doc_id").alias("at"))
    ordered = ordered.repartition(1).sortWithinPartitions("at", "text").select("text", "label")
    learned = ordered.mapInArrow(train, "weights binary").collect()
    return np.frombuffer(learned[0].weights, "<f4") if learned else np.zeros(1 << BITS, "<f4")


def score(text: Column | str, weights: np.ndarray) -> Column:
    """The probability of label 1, 0 to 1, as a column. The weights (``2**BITS`` floats) go to each task."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in small(batches):
            sums = [float(weights[s] @ v) for s, v in map(features, batch.to_pylist())]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(sums), -30, 30))), pa.float64())

    text = F.col(text) if isinstance(text, str) else text
    return scored.asNondeterministic()(F.coalesce(text, F.lit("")).cast("binary"))
