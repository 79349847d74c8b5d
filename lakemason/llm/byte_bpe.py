"""Byte-level BPE: encode whole texts to token ids and decode ids back to bytes.

Texts are cut into pieces without a regular expression. Every code point gets a class from a lookup
array (letter, number, white space, other, and by looking one or two code points ahead: the last
white space of a run, an apostrophe that opens a contraction). A class is a transition function of a
small automaton. These functions form a finite monoid, so runs of them are composed by table lookup
in any grouping: blocks are composed side by side, block totals are scanned, and each position learns
its state. A piece starts where (state, class) says so. Each piece is merged once and cached.

Ids and byte ends are packed as little-endian unsigned 32-bit integers, so a text of any length is
two binary values. ``ends[i]`` is the byte offset behind token i, kept so that any range of tokens
can be mapped back to the text.

A null text encodes as an empty one; a text without characters has no tokens and decodes to no bytes.
Rows keep their order and number, so repeated rows and repeated ids give repeated results.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakemason.llm.batches import small

# Classes of a position.
END, LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_RUN, LAST_BLANK, LAST_SPACE = range(9)
# States: what the piece so far is. FRESH: complete. TAIL1, TAIL2: one or two letters of a contraction to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, AFTER_BLANK, TAIL1, TAIL2 = range(8)
STATES, CLASSES, WIDTH = 8, 9, 64

# The code points of Unicode's White_Space, and the contractions of the pattern.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

#: Characters that are scanned together, and pieces that a worker remembers.
CHUNK, REMEMBERED = 1 << 18, 150_000
#: Pieces merged side by side, bytes above which a piece is merged by a heap instead, and the rank of no pair.
TOGETHER, LONGEST, NONE = 2048, 100, (1 << 31) - 1


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this position."""
    if kind == END:
        return FRESH, True
    if state in (TAIL2, TAIL1):
        return (TAIL1 if state == TAIL2 else FRESH), False
    if kind in (LETTER, NUMBER):
        run = IN_LETTERS if kind == LETTER else IN_NUMBERS
        return run, state not in (run, AFTER_BLANK)
    if kind in (OTHER, SHORT, LONG):
        joined = state in (IN_OTHERS, AFTER_BLANK)
        return (IN_OTHERS if joined or kind == OTHER else TAIL1 if kind == SHORT else TAIL2), not joined
    if kind == SPACE_RUN:
        return IN_SPACE, state != IN_SPACE
    return (AFTER_BLANK if kind == LAST_BLANK else FRESH), True


@functools.cache
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Element of each class, products of elements, state after an element from each state, piece starts."""
    letters = [tuple(_step(s, k)[0] for s in range(STATES)) for k in range(CLASSES)]
    elements = {tuple(range(STATES)): 0}
    waiting = list(elements)
    while waiting:
        f = waiting.pop()
        for g in letters:
            composed = tuple(g[s] for s in f)
            if composed not in elements:
                elements[composed] = len(elements)
                waiting.append(composed)
    functions = list(elements)
    product = np.array([[elements[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    starts = np.array([[_step(s, k)[1] for k in range(CLASSES)] for s in range(STATES)])
    return np.array([elements[f] for f in letters], np.uint16), product, np.array(functions, np.uint8), starts


@functools.cache
def _code_point_classes() -> np.ndarray:
    of = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE_RUN
    return table


def _prefixes(elements: np.ndarray, product: np.ndarray) -> np.ndarray:
    """Products of all elements up to each position; composition is associative, so blocks go side by side."""
    n = len(elements)
    blocks = -(-n // WIDTH)
    steps = np.zeros(blocks * WIDTH, np.uint16)
    steps[:n] = elements
    steps = np.ascontiguousarray(steps.reshape(blocks, WIDTH).T)
    flat, size = product.ravel(), np.int32(len(product))
    for j in range(1, WIDTH):
        steps[j] = flat.take(steps[j - 1] * size + steps[j])
    if blocks > 1:
        before = np.zeros(blocks, np.uint16)
        before[1:] = _prefixes(steps[-1], product)[:-1]
        steps = flat.take(before * size + steps)
    return steps.T.reshape(-1)[:n]


def piece_starts(text: str, stops: np.ndarray) -> np.ndarray:
    """Positions where a piece starts; ``stops`` holds the positions of the separators between texts."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = _code_point_classes().take(points)
    kinds[stops] = END
    following = np.append(kinds[1:], END)
    last = (kinds == SPACE_RUN) & (following != SPACE_RUN) & (following != END)
    kinds[last] = LAST_SPACE
    kinds[last & (points == 32)] = LAST_BLANK
    marks = np.flatnonzero((points == ord("'")) & (kinds == OTHER))
    if len(marks):
        ahead = np.concatenate([points, [0, 0]])
        ahead[stops] = 0
        one, two = ahead[marks + 1], ahead[marks + 2]
        kinds[marks[np.isin(one, [ord(c) for c in ONE_LETTER])]] = SHORT
        pair = functools.reduce(np.logical_or, ((one == ord(a)) & (two == ord(b)) for a, b in TWO_LETTERS))
        kinds[marks[pair]] = LONG
    element, product, after, starts = _automaton()
    prefix = _prefixes(element.take(kinds), product)
    states = np.zeros(len(kinds), np.uint8)
    states[1:] = after[:, FRESH].take(prefix[:-1])
    return np.flatnonzero(starts.ravel().take(states * np.int32(CLASSES) + kinds))


def merge_all(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Packed ids of distinct pieces. In each, the adjacent pair of lowest rank (the leftmost of equal
    ones) is merged until none is left; pieces of like length take each step together."""
    out: list[bytes] = [b""] * len(pieces)
    order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
    short = [i for i in order if len(pieces[i]) <= LONGEST]
    for first in range(0, len(short), TOGETHER):
        group = short[first : first + TOGETHER]
        for i, ids in zip(group, _merge_rows([pieces[i] for i in group], vocabulary)):
            out[i] = ids
    for i in order[len(short) :]:
        out[i] = np.array(_merge_long(pieces[i], vocabulary.ranks), "<u4").tobytes()
    return out


def _merge_rows(pieces: list[bytes], v: Vocabulary) -> list[bytes]:
    sizes = np.array([len(p) for p in pieces])
    width = int(sizes[-1])
    ids = np.full((len(pieces), width + 2), NONE, np.int64)
    ids[np.arange(width + 2) < sizes[:, None]] = v.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    ranks = np.full((len(pieces), width + 1), NONE, np.int64)
    both = ids[:, 1:] != NONE
    ranks[both] = v.ranks_of(ids[:, :-1][both], ids[:, 1:][both])
    rows, columns = np.arange(len(pieces)), np.arange(width + 2)
    done = np.empty(ids.shape, np.int64)
    while len(rows):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), at]
        if not (going := best != NONE).all():
            done[rows[~going], : ids.shape[1]] = ids[~going]
            rows, ids, ranks, at, best = rows[going], ids[going], ranks[going], at[going], best[going]
            if not len(rows):
                break
        each = np.arange(len(rows))
        behind = columns[None, : ids.shape[1] - 1] > at[:, None]
        ids = np.where(behind, ids[:, 1:], ids[:, :-1])
        ids = np.concatenate([ids, np.full((len(rows), 1), NONE)], axis=1)
        ids[each, at] = best
        ranks = np.where(behind[:, : ranks.shape[1] - 1], ranks[:, 1:], ranks[:, :-1])
        ranks = np.concatenate([ranks, np.full((len(rows), 1), NONE)], axis=1)
        ranks[each, at] = v.ranks_of(best, ids[each, at + 1])
        left = np.flatnonzero(at > 0)
        ranks[left, at[left] - 1] = v.ranks_of(ids[left, at[left] - 1], best[left])
    lengths = (done != NONE).sum(axis=1)
    packed, stops = done[done != NONE].astype("<u4").tobytes(), np.cumsum(lengths) * 4
    return [packed[b - 4 * n : b] for b, n in zip(stops.tolist(), lengths.tolist())]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap over linked parts, for pieces where rescanning would be quadratic."""
    n = len(piece)
    stop, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (rank := ranks.get(piece[i : stop[after[i]]])) is not None:
            heapq.heappush(heap, (rank, i, stop[after[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or stop[after[i]] != end:
            continue
        gone = after[i]
        alive[gone], stop[i], after[i] = False, end, after[gone]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[piece[i : stop[i]]] for i in range(n) if alive[i]]


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks of tokens, and of token pairs: the pair (a, b) has the rank of the token that its bytes spell."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.uint32)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.pairs = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], NONE)
        self.pieces: dict[str, bytes] = {}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = self.pairs.searchsorted(keys)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], NONE)

    def remember(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids by piece, at least of these. The store is emptied when full, which changes no result."""
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        if new := list(set(pieces).difference(self.pieces)):
            self.pieces.update(zip(new, merge_all([p.encode() for p in new], self)))
        return self.pieces


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(texts: list[str], path: str) -> Iterator[bytes]:
    """Packed ids of each text; texts are scanned together up to CHUNK characters."""
    known = vocabulary(path)
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < CHUNK):
            size += len(texts[last]) + 1
            last += 1
        joined = "\n".join(texts[first:last]) + "\n"
        stops = np.cumsum([len(t) + 1 for t in texts[first:last]]) - 1
        starts = piece_starts(joined, stops)
        ends = np.searchsorted(starts, stops).tolist()
        starts, begin = starts.tolist(), 0
        pieces = [joined[a:b] for a, b in zip(starts, starts[1:])] + ["\n"]
        ids = known.remember(pieces)
        for end in ends:
            yield b"".join(map(ids.__getitem__, pieces[begin:end]))
            begin = end + 1
        first = last


def encode(text: Column | str, path: str) -> Column:
    """``struct<ids: binary, ends: binary>`` of a text column by the rank file at ``path``, which every worker can open."""

    @F.arrow_udf("struct<ids: binary, ends: binary>")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = vocabulary(path).lengths
        for batch in small(batches):
            ids = list(encode_texts(batch.to_pylist(), path))
            ends = [np.cumsum(lengths[np.frombuffer(i, "<u4")], dtype="<u4").tobytes() for i in ids]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(ends, pa.binary())], names=["ids", "ends"])

    return packed(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _text_of(ids: bytes, ends: bytes, tokens_of: list[bytes]) -> bytes:
    text = b"".join(map(tokens_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    stops = np.frombuffer(ends, "<u4")
    if len(text) != (int(stops[-1]) if len(stops) else 0):
        raise ValueError("ids and ends of a row disagree")
    return text


def decode(tokens: Column | str, path: str) -> Column:
    """The bytes that packed tokens (as ``encode`` returns them) stand for; null tokens give null."""

    @F.arrow_udf("binary")
    def unpacked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens_of = vocabulary(path).tokens
        for batch in small(batches):
            yield pa.array([r and _text_of(r["ids"], r["ends"], tokens_of) for r in batch.to_pylist()], pa.binary())

    return unpacked(F.col(tokens) if isinstance(tokens, str) else tokens)


def encode_decode(text: Column | str, path: str) -> Column:
    """``struct<ids, ends, decoded>``: encoding, and what decoding the ids gives, in one pass of one worker."""

    @F.arrow_udf("struct<ids: binary, ends: binary, decoded: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(path)
        for batch in small(batches):
            ids = list(encode_texts(batch.to_pylist(), path))
            ends = [np.cumsum(known.lengths[np.frombuffer(i, "<u4")], dtype="<u4").tobytes() for i in ids]
            texts = [_text_of(i, e, known.tokens) for i, e in zip(ids, ends)]
            yield pa.StructArray.from_arrays([pa.array(c, pa.binary()) for c in (ids, ends, texts)], names=["ids", "ends", "decoded"])

    return both(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def encode_documents(docs: DataFrame, path: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """All columns of ``docs`` and the packed tokens of its text as column ``out`` (replaced if it is there)."""
    return docs.withColumn(out, encode(text, path))
