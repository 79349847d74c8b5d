"""The two classifiers against plain versions: dictionaries for the regression, a walk over clauses for the grammar."""

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakemason.llm import quality, toxicity
from lakemason.llm.labelled import held_out, training_rows
from lakemason.llm.queries import QUERIES

LABELS = "doc_id bigint, quality int, toxic int"


def plain_features(text):
    """Slot and value of each occurrence, word by word."""
    mask, mix = 2**64 - 1, [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]
    words, shapes, before = [], [], None
    for raw in text.encode().split():
        marks = re.search(rb"[^\w\x80-\xff]+$", raw)
        body = raw[: marks.start()] if marks else raw
        if body.isdigit():
            case = b"0"
        elif body.isupper() and len(body) > 1:
            case = b"A"
        elif body[:1].isupper():
            case = b"Aa"
        else:
            case = b"a" if body.islower() else b"?" if body else b""
        shape = xxhash.xxh32_intdigest(b"\0".join([case, bytes([len(body)]) if len(body) < 3 else b"", marks.group()[:4] if marks else b""]))
        words.append(xxhash.xxh32_intdigest(raw))
        shapes.append(shape + ((raw == before) << 33))
        before = raw
    families = [
        [w * mix[0] for w in words], [a * mix[0] + b * mix[1] for a, b in zip(words, words[1:])],
        [a * mix[1] + b * mix[2] for a, b in zip(shapes, shapes[1:])], [a * mix[0] + b * mix[2] + c * mix[1] for a, b, c in zip(shapes, shapes[1:], shapes[2:])]]
    out = {0: 1.0}
    for family in families:
        for code in family:
            code &= mask
            slot = ((code ^ code >> 29) * mix[0] & mask) >> 64 - quality.BITS
            out[slot] = out.get(slot, 0.0) + quality.SCALE / len(family)
    return out


def plain_fit(rows, epochs=2, alpha=0.3, beta=1.0, l1=0.05, l2=1.0):
    z, n = {}, {}

    def weight(slot):
        a = z.get(slot, 0.0)
        return 0.0 if abs(a) <= l1 else (math.copysign(l1, a) - a) / ((beta + math.sqrt(n.get(slot, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for text, label in rows:
            values = plain_features(text)
            held = {s: weight(s) for s in values}
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(held[s] * v for s, v in values.items())))))
            for s, v in values.items():
                g, old = (p - label) * v, n.get(s, 0.0)
                z[s] = z.get(s, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * held[s]
                n[s] = old + g * g
    return {s: weight(s) for s in z}


def test_quality_equals_a_regression_in_dictionaries(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = training_rows(docs, labels, "quality", 12_000).orderBy(F.xxhash64("doc_id"), F.col("text").cast("binary")).collect()
    weights = plain_fit([(r.text, r.label) for r in rows])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in QUERIES["op4_quality"](spark, sf_dir).collect():
        plain = sum(weights.get(s, 0.0) * v for s, v in plain_features(texts[row.doc_id]).items())
        assert row.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, plain)))), abs=1e-4)


def plain_matches(grammar, text):
    """Each clause by itself, each insult or threat by what stands around it."""
    lists = {k: set(getattr(toxicity, k).split()) for k in ("INSULTS", "THREATS", "TARGETS", "NEGATIONS", "REPORTS")}

    def hit(word):
        if word in grammar.words:
            return ("threat" if word in lists["THREATS"] else "insult"), grammar.words[word]
        if word in lists["INSULTS"] | lists["THREATS"]:
            return ("insult" if word in lists["INSULTS"] else "threat"), 1.0
        if word in lists["TARGETS"] | lists["NEGATIONS"] | lists["REPORTS"]:
            return None, 0.0
        stem = next((grammar.stems[word[:n]] for n in toxicity.STEM_LENGTHS if grammar.stems.get(word[:n])), 0.0)
        return ("insult", stem) if stem else (None, 0.0)

    found = dict.fromkeys(toxicity.KINDS, 0.0)
    for clause in re.split(r"[.!?;:\n]", text.lower()):
        words = re.findall(r"[^\W\d_]+", clause)
        hits = [(i, *hit(w)) for i, w in enumerate(words)]
        hits = [h for h in hits if h[1]]
        is_target = lambda i: words[i] in lists["TARGETS"] and words[i] not in grammar.words
        for i, kind, value in hits:
            near = lambda names, reach: any(w in lists[names] and w not in grammar.words for w in words[max(0, i - reach) : i])
            if near("REPORTS", toxicity.REPORT_REACH):
                name = f"reported {kind}"
            elif near("NEGATIONS", toxicity.NEGATION_REACH):
                name = f"negated {kind}"
            else:
                name = f"aimed {kind}" if any(is_target(j) for j in range(i)) else kind
            found[name] += value
        # the first target counts once if a hit came before it and no target did
        first = next((j for j in range(len(words)) if is_target(j)), None)
        earlier = [h for h in hits if first is not None and h[0] < first]
        if earlier:
            found["aimed later"] += earlier[-1][2]
    return np.array([found[k] for k in toxicity.KINDS])


def test_grammar_equals_a_walk_over_clauses():
    rnd = random.Random(12)
    grammar = toxicity.Grammar(words={"zorg": 0.5, "kill": 0.7}, stems={"blar": 0.4})
    vocabulary = "you not said idiot kill zorg blargh blarney house he never quoted stab , . ! \n ; walks moron éa das dich nicht".split(" ")
    for _ in range(3000):
        text = " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 14)))
        assert grammar.matches(text).tolist() == pytest.approx(plain_matches(grammar, text).tolist()), text


def test_toxicity_equals_the_walk_over_all_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    grammar = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in QUERIES["op6_toxicity"](spark, sf_dir).collect():
        sums = np.log1p(plain_matches(grammar, texts[row.doc_id])) @ grammar.weights + grammar.base
        assert row.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, sums)))), abs=1e-9)


def test_the_bound_on_labelled_rows_holds_for_an_id_on_many_texts(spark, make_docs):
    docs = make_docs([(0, f"text {i}") for i in range(500)] + [(i, f"other {i}") for i in range(1, 40)] + [(1, "other 1"), (1, None)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(0, 1, 0)], LABELS)
    known = sum(1 for r in labels.select("doc_id", held_out().alias("h")).distinct().collect() if not r.h)
    for bound in (10, 1000):
        rows = training_rows(docs, labels, "quality", bound).collect()
        assert len(rows) == len({r.doc_id for r in rows}) == min(bound, known)
    again = training_rows(docs.repartition(7), labels, "quality", 1000).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
