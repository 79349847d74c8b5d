"""Alignment of two tokenizers: which tokens of one cover the bytes of which tokens of the other.

A text with a space before it is encoded by a byte-level BPE (A) and by a piece model with byte fallback (B, which
adds that space itself). Which bytes a token covers is a sparse matrix, tokens by bytes; the product of A's with the
transpose of B's has an entry wherever two tokens overlap. The offsets where tokens of both end cut the tokens into
groups, and the product of the matrices "A id by group" and "group by B id" counts the links of each id pair.
Matrices are compressed sparse rows, multiplied row by row (Gustavson), a bounded number of products at a time.

Neither tokenizer merges across a single space between two other characters, so a text falls into chunks at such
places. A worker encodes and aligns each distinct chunk once and a text is a row of "texts by chunks", whose product
with "chunks by id pairs" gives the text's links. Texts without such places are one chunk.

Null and empty texts, and those that either tokenizer does not give back byte for byte, have no tokens. Repeated
rows count once each; extra columns are ignored. Ids of the vocabularies must be below 2**31.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lakemason.llm.batches import small
from lakemason.session import cut

#: Products that a multiplication holds at a time (one row of the left matrix at least).
PRODUCTS = 4_000_000
#: Text that is counted together, and encoded together, in characters.
BLOCK, PART = 2_000_000, 100_000
#: About how many bytes of chunks a worker remembers.
REMEMBERED = 100_000_000


@dataclass
class Csr:
    """A sparse matrix: the columns and values of row i lie at ``ptr[i]`` to ``ptr[i + 1]``, columns ascending."""

    ptr: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    width: int

    @staticmethod
    def of(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, shape: tuple[int, int]) -> Csr:
        """From entries in any order; entries of the same place are added."""
        place = rows * shape[1] + cols
        order = np.argsort(place, kind="stable")
        place = place[order]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        place = place[first]
        added = np.add.reduceat(vals[order], first) if len(first) else vals[:0]
        ptr = np.searchsorted(place, np.arange(shape[0] + 1) * shape[1])
        return Csr(ptr, place % max(shape[1], 1), added, shape[1])

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def __matmul__(self, other: Csr) -> Csr:
        """Row i of the product is the sum of the other's rows that row i names, each times its value."""
        sizes = np.diff(other.ptr)[self.cols]
        before = np.concatenate([[0], np.cumsum(sizes)])[self.ptr]
        parts, row, height = [], 0, len(self.ptr) - 1
        while row < height:
            stop = max(row + 1, int(np.searchsorted(before, before[row] + PRODUCTS, "right")) - 1)
            here = slice(self.ptr[row], self.ptr[stop])
            n = sizes[here]
            owner = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + other.ptr[self.cols[here]][owner]
            rows = np.repeat(np.arange(stop - row), np.diff(self.ptr[row : stop + 1]))[owner]
            parts.append(Csr.of(rows, other.cols[at], self.vals[here][owner] * other.vals[at], (stop - row, other.width)))
            row = stop
        if not parts:
            return Csr(np.zeros(height + 1, np.int64), self.cols[:0], self.vals[:0], other.width)
        ends = np.cumsum([0] + [p.ptr[-1] for p in parts])
        ptr = np.concatenate([[0]] + [p.ptr[1:] + e for p, e in zip(parts, ends)])
        return Csr(ptr, np.concatenate([p.cols for p in parts]), np.concatenate([p.vals for p in parts]), other.width)


class Tokenizers:
    """Both vocabularies, their tokens' bytes, and encoding to ids."""

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # bytes as the byte-level alphabet writes them: printable ones stand for themselves, the others from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        back = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        with open(a_path, encoding="utf-8") as file:
            stored = json.load(file)
        entries = {**stored["model"]["vocab"], **{t["content"]: t["id"] for t in stored.get("added_tokens", ())}}
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.a_bytes[number] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        # how an id is written, by what follows it
        self.a_said = [np.array([f"{i}{mark}" for i in range(len(self.a_bytes))], object) for mark in ",|"]
        self.b_said = [np.array([f"{i}{mark}" for i in range(len(self.b_bytes))], object) for mark in (",", ";", "\n")]
        #: No piece goes on after a space that follows something else: then a text may be cut there.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text that starts with a space; nothing if the bytes of the tokens are not the text's."""
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:]) if len(text) > 1 else []
        raw = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


@lru_cache(maxsize=1)
def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def _incidence(lengths: np.ndarray, transposed: bool) -> Csr:
    """Tokens by bytes, or bytes by tokens."""
    total = int(lengths.sum())
    if transposed:
        return Csr(np.arange(total + 1), np.repeat(np.arange(len(lengths)), lengths), np.ones(total, np.int64), len(lengths))
    return Csr(np.concatenate([[0], np.cumsum(lengths)]), np.arange(total), np.ones(total, np.int64), total)


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Csr:
    """How many bytes each A token shares with each B token."""
    return _incidence(a_lengths, False) @ _incidence(b_lengths, True)


def groups(shared: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and of each B token. A new one starts where a token meets none that the one before met."""
    first, last = shared.cols[shared.ptr[:-1]], shared.cols[shared.ptr[1:] - 1]
    of_a = np.cumsum(np.append(0, first[1:] != last[:-1])) if len(first) else first
    of_b = np.zeros(shared.width, np.int64)
    of_b[shared.cols] = of_a[shared.rows]
    return of_a, of_b


class Chunks:
    """The distinct chunks a worker has met: tokens, groups, links, and links by id pair."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.number: dict[str, int] = {}  # chunk without its space
        self.said: list[str] = []  # its groups
        self.counts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links; all zero if not given back
        self.pairs, self.codes, self.links = (np.zeros(0, np.int64) for _ in range(3))  # number of id pairs; the pairs and their links
        self.size = 0
        self._new: list[tuple[np.ndarray, ...]] = []

    def learn(self, new: Iterable[str]) -> None:
        """Encode and align chunks not met before, many at a time; those that begin or end in white space alone."""
        part: list[str] = []
        size = 0
        for chunk in new:
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                self._align([chunk])
                continue
            if part and size + len(chunk) > PART:
                self._align(part)
                part, size = [], 0
            part.append(chunk)
            size += len(chunk) + 1
        if part:
            self._align(part)
        if self._new:
            old = (self.counts, self.pairs, self.codes, self.links)
            self.counts, self.pairs, self.codes, self.links = (np.concatenate([o, *n]) for o, n in zip(old, zip(*self._new)))
            self._new = []

    def _align(self, part: list[str]) -> None:
        tok = self.tokenizers
        together = tok.encode("".join(" " + c for c in part)) if tok.cuts or len(part) == 1 else None
        if together is None and len(part) > 1:  # some chunk does not come back: halve until it is alone
            self._align(part[: len(part) // 2])
            self._align(part[len(part) // 2 :])
            return
        for chunk in part:
            self.number[chunk] = len(self.number)
            self.size += 300 + 2 * len(chunk)
        if together is None:
            self.said.append("")
            none = np.zeros(0, np.int64)
            self._new.append((np.zeros((1, 4), np.int64), np.zeros(1, np.int64), none, none))
            return
        a, b = together
        ends = np.cumsum([len(c.encode()) + 1 for c in part])
        shared = overlaps(tok.a_len[a], tok.b_len[b])
        of_a, of_b = groups(shared)
        n, n_groups = len(part), int(of_a[-1]) + 1
        chunk_of_a = np.searchsorted(ends, np.cumsum(tok.a_len[a]))
        chunk_of_group = np.zeros(n_groups, np.int64)
        chunk_of_group[of_a] = chunk_of_a
        # rows: (chunk, A id); columns: groups; then B ids
        left_rows, left = np.unique(chunk_of_a << 32 | a, return_inverse=True)
        b_ids, right = np.unique(b, return_inverse=True)
        by_group = Csr.of(left, of_a, np.ones(len(a), np.int64), (len(left_rows), n_groups))
        linked = by_group @ Csr.of(of_b, right, np.ones(len(b), np.int64), (n_groups, len(b_ids)))
        rows = left_rows[linked.rows]
        links = np.bincount(of_a, minlength=n_groups) * np.bincount(of_b, minlength=n_groups)
        ends_of = np.searchsorted(chunk_of_group, np.arange(n + 1))
        n_links = np.diff(np.concatenate([[0], np.cumsum(links)])[ends_of])
        totals = [np.bincount(c, minlength=n) for c in (chunk_of_a, chunk_of_group[of_b], chunk_of_group)]
        codes = (rows & 0xFFFFFFFF) << 32 | b_ids[linked.cols]
        self._new.append((np.stack([*totals, n_links], 1).astype(np.int64), np.bincount(rows >> 32, minlength=n), codes, linked.vals))
        said = self._written(a, b, of_a, of_b, chunk_of_group)
        self.said += said
        self.size += sum(map(len, said)) + 16 * len(codes)

    def _written(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, owner: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each chunk."""
        tok = self.tokenizers
        last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
        last_group = np.append(owner[1:] != owner[:-1], True)[of_b] & last_b
        said_a = np.where(last_a, tok.a_said[1][a], tok.a_said[0][a])
        said_b = np.where(last_group, tok.b_said[2][b], np.where(last_b, tok.b_said[1][b], tok.b_said[0][b]))
        order = np.argsort(np.concatenate([of_a * 2, of_b * 2 + 1]), kind="stable")
        return "".join(np.concatenate([said_a, said_b])[order].tolist()).split("\n")[:-1]


#: Where a text's words are not its chunks: white space at an end, or beside a space.
_EDGE = re.compile(r"^\s|\s$| \s|\s ")


def chunks_of(text: str) -> list[str]:
    """A text cut at single spaces between two other characters; each chunk stands for a space and itself."""
    words = text.split(" ")
    if not _EDGE.search(text):
        return words
    out = [words[0]]
    before = words[0]
    for word in words[1:]:
        if word and before and not word[0].isspace() and not before[-1].isspace():
            out.append(word)
        else:
            out[-1] += " " + word
        before = word
    return out


class Block:
    """Texts counted together."""

    def __init__(self, chunks: Chunks):
        self.chunks = chunks
        self.ids: list[int | None] = []
        self.texts: list[str | None] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        self.ids.append(doc_id)
        self.texts.append(text)
        self.size += len(text or "")

    def packed(self, number: int) -> dict[str, object]:
        """One row: the texts' own columns, the distinct id pairs and how many texts hold them, and the texts' links."""
        table = self.chunks
        parts = [(chunks_of(t) if table.tokenizers.cuts else [t]) if t else [] for t in self.texts]
        known = table.number
        table.learn(dict.fromkeys(p for part in parts for p in part if p not in known))
        rows = [[known[p] for p in part] for part in parts]
        sizes = np.array([len(r) for r in rows], np.int64)
        text_of = np.repeat(np.arange(len(sizes)), sizes)
        chunk = np.fromiter((c for r in rows for c in r), np.int64, int(sizes.sum()))
        lost = np.zeros(len(sizes), bool)
        lost[text_of[table.counts[chunk, 0] == 0]] = True
        said = table.said
        shas = [hashlib.sha256(";".join([said[c] for c in row]).encode()).hexdigest() if row and not gone else "" for row, gone in zip(rows, lost.tolist())]
        kept = ~lost[text_of]
        text_of, chunk = text_of[kept], chunk[kept]
        # texts by chunks, times chunks by id pairs
        met, local = np.unique(chunk, return_inverse=True)
        held_by = Csr.of(text_of, local, np.ones(len(local), np.int64), (len(sizes), len(met)))
        counts = np.stack([np.bincount(text_of, table.counts[chunk, k], len(sizes)) for k in range(4)]).astype(np.int64)
        spans, starts = table.pairs[met], (np.cumsum(table.pairs) - table.pairs)[met]
        at = np.arange(int(spans.sum())) - np.repeat(np.cumsum(spans) - spans, spans) + np.repeat(starts, spans)
        codes, pair = np.unique(table.codes[at], return_inverse=True)
        ptr = np.concatenate([[0], np.cumsum(spans)])
        links = held_by @ Csr(ptr, pair, table.links[at], len(codes))
        own = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([self.ids, *counts, np.diff(links.ptr), shas], _OWN.types)], schema=_OWN)
        steps = np.diff(links.cols, prepend=0).astype("<i4")  # columns ascend within a text: small numbers
        packed = own.serialize().to_pybytes()
        return {
            "block": number, "own": zstandard.compress(len(packed).to_bytes(8, "little") + packed + steps.tobytes() + links.vals.astype("<i8").tobytes(), 1),
            "a": codes >> 32, "b": codes & 0xFFFFFFFF, "texts": np.bincount(links.cols, minlength=len(codes)),
        }


#: What a block says of its texts. It goes through the shuffle as bytes, as a row with lists is slow to hand to Python.
_OWN = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_pairs")] + [("sha", pa.string())])
_LONGS = pa.list_(pa.int64())
_BLOCKS = {"block": pa.int64(), "own": pa.binary(), "a": _LONGS, "b": _LONGS, "texts": _LONGS}
_worker: dict[tuple[str, str], Chunks] = {}


def _chunks(a_path: str, b_path: str) -> Chunks:
    """What this worker remembers, emptied when it grows too large."""
    known = _worker.get((a_path, b_path))
    if known is None or known.size > REMEMBERED:
        _worker.clear()
        known = _worker[a_path, b_path] = Chunks(_tokenizers(a_path, b_path))
    return known


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, size: int = BLOCK) -> DataFrame:
    """The documents in blocks of about ``size`` characters, one row each; a longer text is a block."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        block = Block(_chunks(a_path, b_path))

        def row() -> pa.RecordBatch:
            packed = block.packed(base + n)
            return pa.RecordBatch.from_arrays([pa.array([packed[k]], kind) for k, kind in _BLOCKS.items()], list(_BLOCKS))

        for batch in batches:
            ids, first = batch.column(0).to_pylist(), 0
            for part in small([batch.column(1)], 32):
                for doc_id, text in zip(ids[first : first + len(part)], part.to_pylist()):
                    block.add(doc_id, text)
                    if block.size >= size:
                        yield row()
                        n += 1
                        block = Block(_chunks(a_path, b_path))
                first += len(part)
        if block.ids:
            yield row()

    return docs.select("doc_id", "text").mapInArrow(blocks, "block bigint, own binary, a array<bigint>, b array<bigint>, texts array<bigint>")


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and place, a block's own row (place -1) before the counts of its pairs."""
    own: bytes | None = None
    counts: list[np.ndarray] = []
    best: list[np.ndarray] = []

    def told() -> pa.RecordBatch:
        n, top = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (counts, best))
        raw = zstandard.decompress(own)
        at = 8 + int.from_bytes(raw[:8], "little")
        texts = pa.ipc.read_record_batch(pa.py_buffer(raw[8:at]), _OWN)
        total = (len(raw) - at) // 12
        cols, vals = np.cumsum(np.frombuffer(raw, "<i4", total, at), dtype=np.int64), np.frombuffer(raw, "<i8", total, at + total * 4)
        text_of = np.repeat(np.arange(len(texts)), texts.column("n_pairs").to_numpy())
        n_best, count_sum = (np.zeros(len(texts), np.int64) for _ in range(2))
        np.add.at(n_best, text_of, vals * top[cols])
        np.add.at(count_sum, text_of, vals * n[cols])
        out = [texts.column(k) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [pa.array(n_best), pa.array(count_sum), texts.column("sha")]
        return pa.RecordBatch.from_arrays(out, list(_COUNTED))

    for batch in batches:
        places, heads = batch.column("place").to_numpy(), batch.column("own")
        edges = [0, *np.flatnonzero(places < 0).tolist(), len(places)]
        for first, stop in zip(edges, edges[1:]):
            if first < stop and places[first] < 0:
                if own is not None:
                    yield told()
                own, counts, best = heads[first].as_py(), [], []
                first += 1
            if first < stop:
                counts.append(batch.column("n")[first:stop].to_numpy())
                best.append(batch.column("best")[first:stop].to_numpy())
    if own is not None:
        yield told()


_COUNTED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def linked_counts(docs: DataFrame, a_path: str, b_path: str, size: int = BLOCK) -> DataFrame:
    """One row per document: its tokens, groups and links, and what its links' id pairs count in all documents.

    An id pair's count is the number of documents that hold it linked; ``n_best`` are the links whose pair counts most
    among the pairs of its A id, ``count_sum`` the counts of all links.
    """
    blocks = cut(aligned_blocks(docs, a_path, b_path, size))
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "texts")).alias("place", "pair")).select("block", "place", "pair.a", "pair.b", "pair.texts")
    counts = cut(asked.groupBy("a", "b").agg(F.sum("texts").alias("n")))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))  # one row an id of A: no more than its vocabulary
    counts = counts.join(F.broadcast(top), "a").select("a", "b", "n", (F.col("n") == F.col("top")).cast("bigint").alias("best"))
    heads = blocks.select("block", F.lit(-1).alias("place"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("best"), "own")
    answers = asked.join(counts, ["a", "b"]).select("block", "place", "n", "best", F.lit(None).cast("binary").alias("own"))
    rows = heads.unionAll(answers).repartition("block").sortWithinPartitions("block", "place")
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in _COUNTED)
    return rows.drop("block").mapInArrow(_summed, schema)


def align(text: Column | str, a_path: str, b_path: str) -> Column:
    """A text's own alignment: ids of both, the group of each token, and the overlap links with their bytes
    (positions of an A and a B token and the bytes they share); all empty for texts without tokens."""
    fields = [(n, pa.list_(pa.int64())) for n in ("a_ids", "b_ids", "a_groups", "b_groups")]
    link = pa.struct([(n, pa.int64()) for n in ("a", "b", "bytes")])
    kind = pa.struct([*fields, ("overlaps", pa.list_(link))])
    empty = {n: [] for n in ("a_ids", "b_ids", "a_groups", "b_groups", "overlaps")}

    @F.arrow_udf("a_ids array<bigint>, b_ids array<bigint>, a_groups array<bigint>, b_groups array<bigint>, overlaps array<struct<a bigint, b bigint, bytes bigint>>")
    def aligned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = _tokenizers(a_path, b_path)
        for batch in small(batches):
            out = []
            for text in batch.to_pylist():
                both = tok.encode(" " + text) if text else None
                if both is None:
                    out.append(empty)
                    continue
                shared = overlaps(tok.a_len[both[0]], tok.b_len[both[1]])
                of_a, of_b = groups(shared)
                links = [{"a": a, "b": b, "bytes": n} for a, b, n in zip(shared.rows.tolist(), shared.cols.tolist(), shared.vals.tolist())]
                out.append({"a_ids": both[0].tolist(), "b_ids": both[1].tolist(), "a_groups": of_a.tolist(), "b_groups": of_b.tolist(), "overlaps": links})
            yield pa.array(out, kind)

    return aligned.asNondeterministic()(text)
