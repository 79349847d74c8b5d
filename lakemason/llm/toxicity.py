"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols (insult, threat, target, negation, reporting verb, clause break, other). Five small
transducers read the symbols of a text: negation and reported speech mark what follows within a few
words, targets mark a clause, insults and threats emit weighted matches. They are composed once into a
single table ``(state, symbol) -> (state, match kind)``, so a text is scored in one left-to-right pass, and
what counts is the clause an insult or threat stands in: aimed at someone, plain, negated or reported.

The insult and threat lexicon starts from a few fixed English words and is extended by words and word
stems learned from labelled rows; the weights of the match kinds are a logistic fit around prior weights.

A null or empty text has no match and gets the base score. Rows are scored one by one: repeated rows get
equal scores, extra columns stay. Without labelled rows the fixed lexicon and prior weights are used.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakemason.llm.batches import small
from lakemason.llm.labelled import training_rows

# The words the grammar knows without labels.
INSULTS = "idiot moron stupid scum trash worthless pathetic loser disgusting clown"
THREATS = "kill hurt destroy beat stab shoot burn strangle"
TARGETS = "you your yours youre u he she they them him her his their we us people everyone dich du ihr sie toi vous tu usted ustedes"
NEGATIONS = "not no never isnt arent wasnt dont nobody kein keine nicht nie pas jamais nunca"
REPORTS = "said says say quoted quote reported wrote writes claimed called alleged sagte schrieb selon dijo"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK = range(7)
KINDS = ["insult", "aimed insult", "negated insult", "reported insult", "threat", "aimed threat", "negated threat", "reported threat", "aimed later"]
#: What a match is worth before labels speak; the fit stays near these where labels say nothing.
PRIOR = np.array([2.0, 2.5, 0.3, 0.3, 1.0, 2.5, 0.2, 0.2, 0.5])
PRIOR_BASE = -3.0
#: Words that a negation or a reporting verb reaches within its clause.
NEGATION_REACH, REPORT_REACH = 2, 6
STEM_LENGTHS = (4, 5, 6)

_TOKENS = re.compile(r"[^\W\d_]+|[.!?;:\n]")


def _countdown(opens: int, reach: int):
    """A transducer that marks the ``reach`` words behind a symbol, within a clause."""

    def step(state: int, symbol: int) -> tuple[int, bool]:
        if symbol == BREAK:
            return 0, False
        return (reach if symbol == opens else max(0, state - 1)), state > 0

    return step


def _target(state: int, symbol: int) -> tuple[int, bool]:
    """Whether someone was named in this clause. State 2: a match came first and waits for a target."""
    if symbol == BREAK:
        return 0, False
    if symbol == TARGET:
        return 1, state == 2
    if symbol in (INSULT, THREAT) and state == 0:
        return 2, False
    return state, state == 1


@functools.cache
def grammar() -> tuple[list[list[int]], list[list[int]]]:
    """The composed transducer: next state and match kind (-1: none) by state and symbol."""
    negation, report = _countdown(NEGATION, NEGATION_REACH), _countdown(REPORT, REPORT_REACH)
    states, following, kinds = {(0, 0, 0): 0}, [], []
    waiting = [(0, 0, 0)]
    for now in waiting:
        next_row, kind_row = [], []
        for symbol in range(BREAK + 1):
            (n, negated), (r, reported), (t, aimed) = negation(now[0], symbol), report(now[1], symbol), _target(now[2], symbol)
            if (n, r, t) not in states:
                states[n, r, t] = len(states)
                waiting.append((n, r, t))
            kind = -1
            if symbol in (INSULT, THREAT):
                kind = (3 if reported else 2 if negated else 1 if aimed else 0) + (4 if symbol == THREAT else 0)
            elif symbol == TARGET and aimed:
                kind = 8
            next_row.append(states[n, r, t])
            kind_row.append(kind)
        following.append(next_row)
        kinds.append(kind_row)
    return following, kinds


@dataclass
class Grammar:
    """Lexicon (weight by word, weight by stem) and the weights of the match kinds."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    base: float = PRIOR_BASE
    weights: np.ndarray = field(default_factory=PRIOR.copy)

    def __post_init__(self):
        self.symbols: dict[str, tuple[int, float]] = {}
        self.fixed = {c: (BREAK, 0.0) for c in ".!?;:\n"}
        for words, symbol in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT), (INSULTS, INSULT)):
            self.fixed |= {w: (symbol, 1.0) for w in words.split()}
        self.fixed |= {w: (THREAT if w in THREATS.split() else INSULT, x) for w, x in self.words.items()}

    def symbol(self, word: str) -> tuple[int, float]:
        known = self.fixed.get(word)
        if known is None:
            stem = next((s for n in STEM_LENGTHS if (s := self.stems.get(word[:n]))), None)
            known = (INSULT, stem) if stem else (OTHER, 0.0)
        if len(self.symbols) > 100_000:
            self.symbols.clear()
        self.symbols[word] = known
        return known

    def matches(self, text: str) -> np.ndarray:
        """Summed lexicon weights by match kind."""
        found = np.zeros(len(KINDS))
        symbols, symbol = self.symbols, self.symbol
        read = [symbols.get(w) or symbol(w) for w in _TOKENS.findall(text.lower())]
        if not any(w for _, w in read):
            return found
        following, kinds = grammar()
        state, last = 0, 0.0
        for s, weight in read:
            if (kind := kinds[state][s]) >= 0:
                found[kind] += last if kind == 8 else weight
            if s in (INSULT, THREAT):
                last = weight
            state = following[state][s]
        return found

    def score(self, found: np.ndarray) -> np.ndarray:
        """Probability of the label from match sums, one row a text."""
        return 1 / (1 + np.exp(-np.clip(self.base + np.log1p(found) @ self.weights, -30, 30)))


def _features(word: str) -> set[str]:
    return {word + "$", *(word[:n] for n in STEM_LENGTHS if len(word) >= n)}


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word, word before it) of toxic texts: copies of one text count once."""
    for batch in small(batches):
        seen = set()
        for text in batch.column("text").to_pylist():
            words = [w for w in _TOKENS.findall(text.lower()) if w.isalpha()]
            seen.update(zip(words, ["", *words]))
        words, before = zip(*seen) if seen else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(before, pa.string())], ["word", "before"])


def learn_lexicon(rows: DataFrame, least: int = 5, least_odds: float = 30.0) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems that stand in ``least`` or more different contexts of toxic texts, in three of these texts or
    more, and whose share of them is ``least_odds`` times that of clean texts. The rows are a bounded sample, and so
    is the lexicon."""
    pairs = rows.filter("label = 1").select("text").mapInArrow(_contexts, "word string, before string").distinct()
    whole = pairs.select(F.concat("word", F.lit("$")).alias("feature"))
    stems = [pairs.filter(F.length("word") >= n).select(F.substring("word", 1, n).alias("feature")) for n in STEM_LENGTHS]
    counted = functools.reduce(DataFrame.unionAll, stems, whole).groupBy("feature").count().filter(F.col("count") >= least)
    candidates = {r[0] for r in counted.collect()}
    if not candidates:
        return {}, {}

    def texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        known: dict[str, set[str]] = {}
        for batch in small(batches):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found = {"\n"}
                for word in set(_TOKENS.findall(text.lower())):
                    if word not in known:
                        if len(known) > 50_000:
                            known.clear()
                        known[word] = _features(word) & candidates
                    found |= known[word]
                counts[label > 0].update(found)
        both = sorted(counts[0].keys() | counts[1].keys())
        columns = [pa.array(both, pa.string()), *(pa.array([c[f] for f in both], pa.int64()) for c in counts)]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])

    summed = rows.select("text", "label").mapInArrow(texts_with, "feature string, clean bigint, toxic bigint")
    n = {r.feature: (r.clean, r.toxic) for r in summed.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).collect()}
    n_clean, n_toxic = n.pop("\n")
    odds = {f: t / (n_toxic + 1) / ((c + 0.5) / (n_clean + 1)) for f, (c, t) in n.items() if t >= 3}
    kept = {f: min(1.0, math.log(x) / 6) for f, x in odds.items() if x >= least_odds}
    return {f[:-1]: w for f, w in kept.items() if f[-1] == "$"}, {f: w for f, w in kept.items() if f[-1] != "$"}


def _match_udf(grammar_: Grammar) -> Column:
    @F.arrow_udf("array<double>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in small(batches):
            yield pa.array([grammar_.matches(t).tolist() for t in batch.to_pylist()], pa.list_(pa.float64()))

    return found


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", max_rows: int = 20_000, pull: float = 1.0) -> Grammar:
    """A grammar fitted on at most ``max_rows`` labelled rows; ``pull`` ties the weights to their priors."""
    rows = training_rows(docs, labels, target, max_rows)
    grammar_ = Grammar(*learn_lexicon(rows))
    seen = rows.select("label", _match_udf(grammar_)("text").alias("found")).collect()
    if len({r.label for r in seen}) < 2:
        return grammar_
    x = np.column_stack([np.ones(len(seen)), np.log1p(np.array([r.found for r in seen]))])
    y, prior = np.array([r.label for r in seen], float), np.append(PRIOR_BASE, PRIOR)
    ridge = np.diag([0.01, *[pull] * len(PRIOR)])
    w = prior.copy()
    for _ in itertools.repeat(None, 30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ (w - prior))
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    # A sharper penalty never helps an aimed or plain match: these only ever speak for the label.
    grammar_.base, grammar_.weights = float(w[0]), np.maximum(w[1:], 0)
    return grammar_


def score(text: Column | str, grammar_: Grammar) -> Column:
    """The probability that a text is toxic, 0 to 1, as a column."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in small(batches):
            found = np.array([grammar_.matches(t) for t in batch.to_pylist()]).reshape(-1, len(KINDS))
            yield pa.array(grammar_.score(found), pa.float64())

    return scored.asNondeterministic()(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
