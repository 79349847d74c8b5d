"""Main text of web pages: the contiguous region of highest score, words scoring positive and tags negative.

A page is a row of tokens: texts and tags. A word scores the share of words in its kind of block that belong to
the content of labelled pages; a tag costs the share of its kind that lies outside of it, times ``CROSS``.
One linear scan finds the best region; its texts, less those in menus, forms and other boilerplate elements
within it, are the answer.

Labelled pages are those whose markup names its content (``article``, else ``main``): their tokens inside are content,
all others are not. A kind is the element's name and its classes, hashed into ``2**BITS`` slots, so the weights have
a fixed size whatever markup the corpus holds; kinds seen seldom lean on the name, names on the priors below.

Within a block all white space (``<br>`` too) becomes one space; blocks are joined by a line feed in page order.
A null or empty page, and one whose best region has no likely content, gives an empty text. Rows are independent:
repeated rows get equal texts, extra columns stay. Unclosed and misnested markup is read as far as it goes.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakemason.llm.batches import small

BITS = 16
#: What it costs to cross a tag that never occurs inside content, in words that are surely content.
CROSS = 25.0
#: What any tag costs.
STEP = 0.01
#: Seen that often, a kind's own share counts as much as the share that it leans on.
LEAN = 4.0
#: A region with less likely content than this many words is none.
LEAST = 0.5

# Elements and class words of the parts of a page that are not its main text.
BOILERPLATE_TAGS = set("nav footer aside form button select dialog menu noscript iframe object svg canvas audio video".split())
BOILERPLATE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice popup modal "
    "overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar footer comment comments disqus reply replies share sharing social "
    "related recommended newsletter subscribe signup login masthead topbar toolbar pagination pager widget".split()
)
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
# Class words of what has such parts beside it, and of content that has a header.
BESIDE = {"with", "has", "no", "without"}
CONTENT_WORDS = {"article", "post", "entry", "content", "main", "story"}
# Elements whose text is never shown as page text, those without an end tag, and those that break a line.
RAW = {"script", "style", "title", "textarea", "template", "xmp", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: A new one of these ends an open one, within the element named.
IMPLIED = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
#: Share of a name's tags taken to lie inside content before any page is seen.
PRIOR = {name: 0.99 for name in "header hgroup p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption ul ol li dl dt dd table tr td th".split()}

#: Kind of the tags within boilerplate, whose own tags stand for them, and of scripts and styles.
INNER = ("-", "-")

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_END = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
_NAMED = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z]+")
_slots: dict[str, int] = {}


def _slot(kind: str) -> int:
    """Slot of a kind of tag or block; those of names (``=name``) and of names with classes share the table."""
    found = _slots.get(kind)
    if found is None:
        if len(_slots) > 100_000:
            _slots.clear()
        found = _slots[kind] = xxhash.xxh32_intdigest(kind.encode(errors="replace")) >> 32 - BITS
    return found


@dataclass
class Page:
    """A page's tokens in order; ``words`` is 0 for tags."""

    words: list[int] = field(default_factory=list)
    kinds: list[tuple[str, str]] = field(default_factory=list)  # (element name, name with classes)
    texts: list[str | None] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)  # texts with the same number are one block
    dropped: list[bool] = field(default_factory=list)  # inside boilerplate
    content: list[int] = field(default_factory=list)  # number of the content element around it, 0 for none
    #: Words in each content element, by its name and number.
    marked: dict[tuple[str, int], int] = field(default_factory=dict)

    def add(self, words: int, kind: tuple[str, str], text: str | None, block: int, dropped: bool, content: int) -> None:
        self.words.append(words)
        self.kinds.append(kind)
        self.texts.append(text)
        self.blocks.append(block)
        self.dropped.append(dropped)
        self.content.append(content)


def _boilerplate(name: str, attributes: dict[str, str], inside: bool) -> bool:
    if name in BOILERPLATE_TAGS or name == "header" and not inside:
        return True
    if name in ("html", "body", "main") or not attributes:
        return False
    if attributes.get("role") in BOILERPLATE_ROLES or attributes.get("aria-hidden") == "true":
        return True
    words = set(_PARTS.split(f"{attributes.get('class', '')} {attributes.get('id', '')}"))
    if not BOILERPLATE_WORDS.isdisjoint(words):
        return words.isdisjoint(BESIDE)
    return "header" in words and not inside and words.isdisjoint(CONTENT_WORDS)


def parse(source: str) -> Page:
    """The tokens of a page, in one pass."""
    page = Page()
    # open block elements: name, kind, boilerplate at or above it, content element around it
    stack: list[tuple[str, tuple[str, str], bool, int]] = []
    at, block, numbered, size, last = 0, 0, 0, len(source), source.rfind(">")
    top = ("", ("", ""), False, 0)

    def say(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        parts = len(text.split())
        if parts:
            # scripts without spaces between words: about as many characters as a word has
            page.add(max(parts, len(text) // 12), top[1], text, block, top[2], top[3])
        elif text:
            page.add(0, ("", ""), text, block, top[2], top[3])

    while at < size:
        tag = _OPEN.search(source, at)
        if tag is None or tag.end() > last + 1:
            say(source[at:])
            break
        if tag.start() > at:
            say(source[at : tag.start()])
        if tag[1]:
            end = source.find("-->", tag.end())
            at = size if end < 0 else end + 3
            continue
        ended = _END.match(source, tag.end())
        at = ended.end() if ended else source.find(">", tag.end()) + 1
        if not at:
            say(source[tag.start() :])
            break
        if tag[2]:
            continue
        name, closing = tag[4].lower(), bool(tag[3])
        breaks = name in BLOCKS
        block += breaks
        if closing:
            kind = (f"/{name}", f"/{name}")
            if breaks:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                if depth is not None:
                    kind = (f"/{stack[depth][1][0]}", f"/{stack[depth][1][1]}")
                    del stack[depth:]
                    top = stack[-1] if stack else ("", ("", ""), False, 0)
            page.add(0, INNER if top[2] or name in RAW else kind, None, block, top[2], top[3])
            continue
        attributes = {k.lower(): v.strip("\"'").lower() for k, v in _NAMED.findall(source, tag.end(), at)} if at - tag.end() > 1 else {}
        if breaks and stack:
            if top[0] == "p":  # a block ends an open paragraph
                stack.pop()
            elif name in IMPLIED:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        del stack[depth:]
                    elif stack[depth][0] not in IMPLIED[name]:
                        continue
                    break
            top = stack[-1] if stack else ("", ("", ""), False, 0)
        drops = top[2] or _boilerplate(name, attributes, bool(top[3]))
        classes = " ".join(sorted(set(f"{attributes.get('class', '')} {attributes.get('id', '')}".split())))
        sign = "-" if drops else ""
        kind = (f"{sign}{name}", f"{sign}{name} {classes}" if classes else f"{sign}{name}")
        page.add(0, INNER if top[2] or name in RAW else kind, None, block, drops, top[3])
        if name == "br":
            page.add(0, ("", ""), " ", block, drops, top[3])
        if name in RAW:
            end = re.compile(f"</{name}", re.IGNORECASE).search(source, at)
            at = size if end is None else end.start()
        elif breaks and name not in VOID:
            content = top[3]
            marks = name in ("article", "main") or attributes.get("role") == "main" or attributes.get("itemprop") == "articlebody"
            if marks and not drops and (name == "article" or not content):
                numbered += 1
                content = numbered
                page.marked["article" if name == "article" else "main", content] = 0
            top = (name, kind, drops, content)
            stack.append(top)
        elif drops and not top[2] and name not in VOID:  # inline boilerplate: up to its own end
            end = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(source, at)
            at = at if end is None else end.start()
    return page


def _labels(page: Page) -> int | None:
    """Number of the element that is the page's content: its largest article, else its largest main element."""
    if not page.marked:
        return None
    size = dict.fromkeys((number for _, number in page.marked), 0)
    for words, dropped, content in zip(page.words, page.dropped, page.content):
        if content and not dropped:
            size[content] += words
    best = max(page.marked, key=lambda key: (key[0] == "article", size[key[1]], -key[1]))
    return best[1]


@dataclass
class Weights:
    """By slot, words and tags inside and outside of the content of labelled pages."""

    word_in: np.ndarray
    word_out: np.ndarray
    tag_in: np.ndarray
    tag_out: np.ndarray

    def __post_init__(self):
        self._known: dict[tuple[bool, tuple[str, str]], float] = {}

    def _share(self, word: bool, kind: tuple[str, str]) -> float:
        inside, outside = (self.word_in, self.word_out) if word else (self.tag_in, self.tag_out)
        name = kind[0].lstrip("/")
        share = (0.02 if word else 0.5) if name.startswith("-") else PRIOR.get(name, 0.98 if name not in BLOCKS else 0.9)
        for key in (f"={kind[0]}", kind[1]):
            slot = _slot(key)
            share = (inside[slot] + LEAN * share) / (inside[slot] + outside[slot] + LEAN)
        return float(share)

    def share(self, word: bool, kind: tuple[str, str]) -> float:
        """How likely a word of such a block, or such a tag, is content."""
        found = self._known.get((word, kind))
        if found is None:
            if len(self._known) > 100_000:
                self._known.clear()
            found = self._known[word, kind] = self._share(word, kind)
        return found


def token_scores(page: Page, weights: Weights) -> list[float]:
    """What each token adds to a region: words positive, tags negative, white space nothing. Tags of boilerplate that
    lies in a content element cost no more than any tag: it is left out of the text anyway."""
    share = weights.share

    def cost(kind: tuple[str, str], content: int) -> float:
        if kind is INNER or content and kind[0].startswith(("-", "/-")):
            return -STEP
        return -STEP - CROSS * (1 - share(False, kind))

    return [
        words * share(True, kind) if words else 0.0 if text is not None else cost(kind, content)
        for words, kind, text, content in zip(page.words, page.kinds, page.texts, page.content)
    ]


def best_region(scores: list[float]) -> tuple[int, int, float]:
    """First and last-plus-one token of the region with the largest sum, and the sum; the first and shortest of equals."""
    best, found, running, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if running <= 0:
            running, start = 0.0, i
        running += score
        if running > best:
            best, found = running, (start, i + 1)
    return *found, best


def main_text(source: str | None, weights: Weights) -> str:
    """The main text of one page."""
    if not source:
        return ""
    page = parse(source)
    first, stop, score = best_region(token_scores(page, weights))
    if score < LEAST:
        return ""
    blocks: list[tuple[int, list[str]]] = []
    for text, block, dropped in zip(page.texts[first:stop], page.blocks[first:stop], page.dropped[first:stop]):
        if dropped or text is None:
            continue
        if not blocks or blocks[-1][0] != block:
            blocks.append((block, []))
        blocks[-1][1].append(text)
    lines = (" ".join("".join(parts).split()) for _, parts in blocks)
    return "\n".join(line for line in lines if line)


def fit(pages: DataFrame, source: str = "html") -> Weights:
    """Weights from all labelled pages: one pass that counts by slot; at most ``4 * 2**BITS`` counts reach the driver."""

    def counted_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, 1 << BITS), np.int64)
        for batch in batches:
            for part in small([batch.column(0)]):
                for text in part.to_pylist():
                    page = parse(text) if text else Page()
                    content = _labels(page)
                    if content is None:
                        continue
                    for words, kind, said, dropped, owner in zip(page.words, page.kinds, page.texts, page.dropped, page.content):
                        if (said is None or words) and kind is not INNER:
                            row = (0 if said is not None else 2) + (owner != content or dropped)
                            for key in (f"={kind[0]}", kind[1]):
                                sums[row, _slot(key)] += words or 1
        rows, slots = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(rows * (1 << BITS) + slots, pa.int64()), pa.array(sums[rows, slots])], ["slot", "n"])

    counted = pages.select(F.col(source)).mapInArrow(counted_slots, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    table = np.zeros(4 << BITS)
    for row in counted.collect():
        table[row.slot] = row.n
    return Weights(*table.reshape(4, -1))


def extract(source: Column | str, weights: Weights) -> Column:
    """The main text as a column. The weights (four numbers for each of ``2**BITS`` slots) go to each task."""

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in small(batches):
            yield pa.array([main_text(text, weights) for text in batch.to_pylist()], pa.string())

    return extracted.asNondeterministic()(source)
