"""Secrets in texts, also inside nested encodings.

A worklist starts with the text itself. Each layer is scanned by all patterns, then unwrapped in every way
that applies: percent escapes and Unicode escapes are replaced in place, base64 runs are decoded at all four
alignments and also joined across line breaks, and gzip, zlib and bzip2 streams are expanded wherever they start.
Decoded bytes stand as one character each (latin-1): the patterns are ASCII, so no byte hides a find and streams
stay intact. What comes out and was not seen before at its place joins the worklist, until nothing new comes out
(a digest per layer stops cycles). Every layer carries, for each of its characters, where in the original text it
comes from, so a find in any depth has a span there.

Spans are ``kind:start:end`` in code points of the original text, end exclusive, ordered by start, then
kind, then end. A find in an inner layer spans the encoded runs it came from.

Work is bounded. An escape sign that is itself escaped nine times or more is unescaped in one step, shorter chains
level by level. Streams are expanded and scanned in windows of ``WINDOW`` bytes that overlap by ``OVERLAP``; a
stream of any size is scanned, in the memory of a window. Base64 runs that repeat the same four characters decode to a
text that repeats three, of which a part shows all. A text may unwrap to ``MAX_WORK`` characters in all layers
together (and ``WORK_PER_CHARACTER`` times its own length, if that is more); what is left unopened beyond is reported
by its place in the text as kind ``packed``, never passed over.

A null or empty text has no finds. Texts are scanned one by one and whole; repeated rows give equal results
and extra columns stay.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from lakemason.llm.batches import small

# The patterns, the least size of what they find, and the order of kinds.
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "packed"]
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};)+")
_ONE_UNICODE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_LONG_CHAIN = re.compile(r"%(?:25){9,}|\\(?:u005[cC]|x5[cC]){9,}|&(?:#38;|#x26;){9,}")
_RUN = r"[A-Za-z0-9+/_-]++"
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_BREAK = r"[ \t]*(?:\r\n?|\n|(?:\\r)?\\n)[ \t]*"
_WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-]){_RUN}(?:{_BREAK}{_RUN})+={{0,2}}")
_PIECE = re.compile(rf"({_RUN}={{0,2}})(?:{_BREAK})?")
_PACKED = re.compile(r"\x1f\x8b\x08|BZh[1-9]|x[\x01\x5e\x9c\xda]")
LEAST_BASE64 = 16

#: Bytes of an expanded stream that are scanned together, and how many of them the next window sees again.
WINDOW, OVERLAP = 1 << 23, 1 << 16
#: Bytes that are read from or expanded of a stream at a time.
PIECE = 1 << 20
#: Characters of a repeating base64 run that are decoded.
REPEATED = 4096
#: Characters that the layers of one text may have together: at least, and for each character of the text.
MAX_WORK, WORK_PER_CHARACTER = 1 << 27, 64

Span = tuple[int, int, int]


def scan(text: str) -> list[Span]:
    """Kind, start and end of the finds in one layer; per kind leftmost and not overlapping."""
    found = []
    if "=" in text or ":" in text:
        found += [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    found += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found + [(2, m.start(), m.end()) for m in _HEX.finditer(text)]


def _percent(run: str) -> str:
    return bytes.fromhex(run.replace("%", "")).decode("latin-1")


def _escapes(run: str) -> str:
    points = [int(next(filter(None, m.groups()[:4]), "0"), 16) if m[5] is None else int(m[5]) for m in _ONE_UNICODE.finditer(run)]
    # surrogate pairs join, lone surrogates and numbers beyond Unicode become U+FFFD
    text = "".join(chr(p) if p < 0x110000 else "\ufffd" for p in points)
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


class _Layer:
    """A text and where its characters come from: ``None`` for the original itself, two numbers if all come from one
    place, else two arrays."""

    def __init__(self, text: str, starts: np.ndarray | int | None = None, ends: np.ndarray | int | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def replaced(self, pattern: re.Pattern, decode: Callable[[str], str]) -> _Layer | None:
        """The layer with every decodable run replaced by what it stands for."""
        if isinstance(self.starts, int):
            text = pattern.sub(lambda m: decode(m[0]) or m[0], self.text)
            return _Layer(text, self.starts, self.ends) if text != self.text else None
        parts, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            plain = decode(m[0])
            if not plain:
                continue
            parts += [self.text[at : m.start()], plain]
            a, b = self.origin(m.start(), m.end())
            kept = np.arange(at, m.start())
            starts += [kept if self.starts is None else self.starts[kept], np.full(len(plain), a)]
            ends += [kept + 1 if self.ends is None else self.ends[kept], np.full(len(plain), b)]
            at = m.end()
        if not parts:
            return None
        kept = np.arange(at, len(self.text))
        starts.append(kept if self.starts is None else self.starts[kept])
        ends.append(kept + 1 if self.ends is None else self.ends[kept])
        return _Layer("".join([*parts, self.text[at:]]), np.concatenate(starts), np.concatenate(ends))


class _Work:
    """What may still be unwrapped of a text, in characters."""

    def __init__(self, text: str):
        self.left = max(MAX_WORK, WORK_PER_CHARACTER * len(text))


def _chunks(data: memoryview, ends: list[int]) -> Iterator[bytes]:
    """What the compressed stream at the start of ``data`` holds, with the members that follow it directly, piece by piece.
    The end of each whole member is added to ``ends``."""
    at = 0
    while True:
        opener = bz2.BZ2Decompressor() if bytes(data[at : at + 3]) == b"BZh" else zlib.decompressobj(47)
        fed = at
        while not opener.eof:
            hungry = opener.needs_input if isinstance(opener, bz2.BZ2Decompressor) else not opener.unconsumed_tail
            piece = bytes(data[fed : fed + PIECE]) if hungry else getattr(opener, "unconsumed_tail", b"")
            fed += len(piece) if hungry else 0
            chunk = opener.decompress(piece, PIECE)
            if chunk:
                yield chunk
            elif not piece and hungry:
                return
        at = fed - len(opener.unused_data)
        ends.append(at)
        if bytes(data[at : at + 3]) not in (b"\x1f\x8b\x08", b"BZh"):
            return


def _measured(data: memoryview, most: int) -> tuple[int, int | None, bytes | None] | None:
    """Size, end (None if missing) and, if it fits a window, content of the stream at the start of ``data``; None if it is
    no stream. Counting ends beyond ``most``."""
    ends, held, size = [], [], 0
    try:
        for chunk in _chunks(data, ends):
            size += len(chunk)
            held = [*held, chunk] if size <= WINDOW else []
            if size > most:
                return size, None, None
    except (zlib.error, OSError, EOFError):
        if not ends:
            return None
    return size, ends[-1] if ends else None, b"".join(held) if size <= WINDOW else None


def _windows(data: memoryview) -> Iterator[bytes]:
    """A stream in overlapping windows."""
    held, size = [], 0
    try:
        for chunk in _chunks(data, []):
            held.append(chunk)
            size += len(chunk)
            if size >= WINDOW:
                whole = b"".join(held)
                yield whole
                held, size = [whole[-OVERLAP:]], OVERLAP
    except (zlib.error, OSError, EOFError):
        pass
    yield b"".join(held)


#: A layer to scan, or the place of what is left unopened.
Found = _Layer | tuple[int, int]


def _streams(layer: _Layer, work: _Work) -> Iterator[Found]:
    """Contents of the compressed streams of a layer."""
    m = _PACKED.search(layer.text)
    data = memoryview(layer.text.encode("latin-1", "replace") if m else b"")
    while m:
        at = m.start() + 1
        if (found := _measured(data[m.start() :], max(0, work.left))) is not None:
            size, taken, content = found
            end = len(data) if taken is None else m.start() + taken
            place = layer.origin(m.start(), end)
            for window in (content,) if content is not None else _windows(data[m.start() :]):
                if work.left <= 0:
                    yield place
                    break
                yield _Layer(window.decode("latin-1"), *place)
            at = at if taken is None else end
        m = _PACKED.search(layer.text, at)


def _decoded(layer: _Layer, start: int, end: int) -> Iterator[_Layer]:
    """The base64 characters between two positions decoded at each alignment; a byte comes from the runs (lines)
    that its characters stand in."""
    pieces = [(m[1].rstrip("="), *layer.origin(*m.span(1))) for m in _PIECE.finditer(layer.text, start, end)]
    body = "".join(p for p, _, _ in pieces).replace("-", "+").replace("_", "/")
    if len(body) < LEAST_BASE64:
        return
    if len({p[1:] for p in pieces}) == 1:
        starts, ends = pieces[0][1:]
        if len(body) > REPEATED and body[4:] == body[:-4]:
            body = body[:REPEATED]
    else:
        sizes = [len(p) for p, _, _ in pieces]
        starts, ends = (np.repeat([p[k] for p in pieces], sizes) for k in (1, 2))
    for skip in range(4):
        run = body[skip : len(body) - ((len(body) - skip) % 4 == 1)]
        data = base64.b64decode(run + "=" * (-len(run) % 4))
        text = data.decode("latin-1")
        if isinstance(starts, int):
            yield _Layer(text, starts, ends)
        else:
            first = skip + np.arange(len(data)) * 4 // 3
            yield _Layer(text, starts[first], ends[np.minimum(first + 1, len(body) - 1)])


def _unwrapped(layer: _Layer, work: _Work) -> Iterator[Found]:
    """All that one step unwraps in a layer, made as it is asked for."""
    text = layer.text
    ways = []
    if "%" in text or "\\" in text or "&#" in text:
        if _LONG_CHAIN.search(text):
            ways = [(_LONG_CHAIN, lambda run: run[0])]
        else:
            ways = [(_PERCENT, _percent)] * ("%" in text) + [(_UNICODE, _escapes)] * ("\\" in text or "&#" in text)
    for pattern, decode in ways:
        if work.left > 0:
            if (inner := layer.replaced(pattern, decode)) is not None:
                yield inner
        else:
            yield from (layer.origin(*m.span()) for m in pattern.finditer(text))
    yield from _streams(layer, work)
    for pattern in (_BASE64, _WRAPPED) if "\n" in text or "\r" in text or "\\n" in text else (_BASE64,):
        for m in pattern.finditer(text):
            if work.left > 0:
                yield from _decoded(layer, m.start(), m.end())
            else:
                yield layer.origin(*m.span())


def find(text: str) -> tuple[list[Span], list[Span]]:
    """The finds in the text itself, and all finds of all layers, both as spans of the original text."""
    base = sorted(scan(text), key=lambda s: (s[1], s[0], s[2]))
    spans = set(base)
    work, seen = _Work(text), {(hashlib.blake2b(text.encode()).digest(), 0, len(text))}
    open_layers = [_unwrapped(_Layer(text), work)]
    while open_layers:
        inner = next(open_layers[-1], None)
        if inner is None:
            open_layers.pop()
        elif isinstance(inner, tuple):
            spans.add((KINDS.index("packed"), *inner))
        elif inner.text:
            place = inner.origin(0, len(inner.text))
            if (mark := (hashlib.blake2b(inner.text.encode()).digest(), *place)) in seen:
                continue
            if work.left <= 0:
                spans.add((KINDS.index("packed"), *place))
                continue
            seen.add(mark)
            work.left -= len(inner.text)
            spans |= {(kind, *inner.origin(a, b)) for kind, a, b in scan(inner.text)}
            open_layers.append(_unwrapped(inner, work))
    return base, sorted(spans, key=lambda s: (s[1], s[0], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for kind, a, b in spans)


def redacted(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every span (overlapping ones together) replaced by ``mark``."""
    parts, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= at:
            parts += [text[at:a], mark]
        at = max(at, b)
    return "".join([*parts, text[at:]])


RESULT = "struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base: string, spans: string, redacted: string>"


def secrets(text: Column | str, redact: bool = False) -> Column:
    """Counts and spans of the finds in the text itself (``base``), all spans, and if asked the text without them."""

    @F.arrow_udf(RESULT)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in small(batches):
            rows = []
            for t in batch.to_pylist():
                base, spans = find(t)
                kinds = [kind for kind, _, _ in base]
                rows.append((*map(kinds.count, range(3)), joined(base), joined(spans), redacted(t, spans) if redact else None))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 3
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["n_assign", "n_access", "n_hex", "base", "spans", "redacted"])

    return found(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
