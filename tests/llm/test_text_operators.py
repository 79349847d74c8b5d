"""Operators that look at one text at a time, against plain versions of the same definitions."""

import base64
import bz2
import gzip
import hashlib
import random
import re
import resource
import time
import urllib.parse
import zlib

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from lakemason.llm import byte_bpe, chat, quality, secret_scan, toxicity
from lakemason.llm.queries import QUERIES, vocabulary_path

public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [None, "", " ", "\n\n", "'s", "a" * 9000, "é中 \U0001f600 don't 'LL 12²\t\r\n x", "\x1c \x85  y"]


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(vocabulary_path())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_and_merges_equal_the_library_on_random_texts(reference):
    rnd = random.Random(3)
    atoms = ["a", "B", "é", "1", "²", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "'t", "!", "中", "don't", "\r", "_", "\U0001f600", "́", "re"]
    texts = ["".join(rnd.choices(atoms, k=rnd.randint(0, 40))) for _ in range(3000)] + ["!" * 700, "ab" * 400, "\n" * 300]
    for text, ids in zip(texts, byte_bpe.encode_texts(texts, vocabulary_path())):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text)


def test_letters_of_all_planes(reference):
    texts = ["a" + chr(c) + " " + chr(c) + "1" for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    for text, ids in zip(texts, byte_bpe.encode_texts(texts, vocabulary_path())):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text)


def test_encoding_round_trip_with_odd_rows_and_clashing_columns(spark, make_docs, reference):
    docs = make_docs(list(enumerate(ODD + ODD))).withColumn("ids", F.lit(7)).withColumn("tokens", F.lit("x"))
    out = byte_bpe.encode_documents(docs, vocabulary_path()).withColumn("back", byte_bpe.decode("tokens", vocabulary_path()))
    for row in out.collect():
        text = row.text or ""
        assert bytes(row.back).decode() == text and row.ids == 7
        ids, ends = (np.frombuffer(row.tokens[k], "<u4").tolist() for k in ("ids", "ends"))
        assert ids == reference.encode_ordinary(text)
        assert ends == np.cumsum([len(reference.decode_single_token_bytes(i)) for i in ids]).tolist()
    assert byte_bpe.encode_documents(docs.limit(0), vocabulary_path()).count() == 0


def test_bpe_query_against_the_library(spark, sf_dir, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in QUERIES["op7_byte_bpe"](spark, sf_dir).collect():
        ids = reference.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


# Secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def joined(spans):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)


def test_secrets_query_against_the_patterns(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in QUERIES["op8_secret_scan"](spark, sf_dir).collect():
        base = base_spans(texts[row.doc_id])
        assert [row.n_assign, row.n_access, row.n_hex] == [[k for _, k, _ in base].count(i) for i in range(3)]
        assert row.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) <= set(row.spans.split(","))


def test_base_rules():
    for text in ("token=abc", "password=token:abcdef", "API_KEY: 'abcdef'", "ſecret=abcdef", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "secret==abcdef", "f" * 24, "f" * 23, "Kpasswd\" = \"a.b/c=d"):
        base, spans = secret_scan.find(text)
        assert [(a, k, b) for k, a, b in base] == base_spans(text), text


INNER = "password = hunter2hunter2"


def nest(layers):
    wrap = {
        "url": urllib.parse.quote, "percent": lambda t: "".join(f"%{b:02X}" for b in t.encode()), "base64": lambda t: base64.b64encode(t.encode()).decode(),
        "unicode": lambda t: "".join(f"\\u{ord(c):04x}" for c in t), "gzip": lambda t: base64.b64encode(gzip.compress(t.encode(), mtime=0)).decode(),
    }
    text = INNER
    for layer in layers:
        text = wrap[layer](text)
    return text


@pytest.mark.parametrize("layers", [["url"], ["percent"], ["base64"], ["unicode"], ["gzip"], ["base64", "base64"], ["percent", "base64"], ["gzip", "percent"], ["unicode", "gzip", "base64", "percent"]])
def test_nested_secrets_are_found_and_mapped(layers):
    text = f"see é {nest(layers)} end"
    start, end = 6, len(text) - 4
    spans = [(a, b) for k, a, b in secret_scan.find(text)[1] if k == 0]
    assert any(start <= a < b <= end for a, b in spans), spans


def test_cycles_end_and_work_is_bounded(monkeypatch):
    assert secret_scan.find("%25" * 50 + "%2525")[1] == []
    monkeypatch.setattr(secret_scan, "MAX_WORK", 10_000)
    monkeypatch.setattr(secret_scan, "WORK_PER_CHARACTER", 1)
    monkeypatch.setattr(secret_scan, "WINDOW", 4096)
    monkeypatch.setattr(secret_scan, "OVERLAP", 64)
    monkeypatch.setattr(secret_scan, "PIECE", 1000)
    bomb = base64.b64encode(gzip.compress(b"." * 100_000)).decode()
    assert {k for k, _, _ in secret_scan.find(f"x {bomb}")[1]} == {3}
    late = base64.b64encode(gzip.compress(b"." * 8500 + INNER.encode())).decode()
    assert [k for k, _, _ in secret_scan.find(f"x {late}")[1]] == [0]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress])
def test_large_streams_are_scanned_in_windows(pack):
    data = b"0 " * (secret_scan.WINDOW - len(INNER) // 4) + INNER.encode() + b" 1" * (1 << 22)
    run = base64.b64encode(pack(data)).decode()
    began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert (0, 4, 4 + len(run)) in secret_scan.find(f"see {run} end")[1]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - began < 500 << 10


@pytest.mark.parametrize("chain", ["%" + "25" * 50_000 + "70assword=hunter2hunter2", "\\" + "u005c" * 20_000 + "u0070assword=hunter2hunter2", "&" + "#38;" * 25_000 + "#112;assword=hunter2hunter2"])
def test_long_chains_of_escapes_end_in_few_steps(chain):
    began = time.monotonic()
    assert any(k == 0 and b == len(chain) for k, _, b in secret_scan.find(chain)[1])
    assert time.monotonic() - began < 5


def test_repeating_runs_are_decoded_in_part():
    run = base64.b64encode(b"f" * 3_000_000).decode()
    assert secret_scan.find(f"see {run}")[1] == [(2, 4, 4 + len(run))]


def wrapped(data, width=20, by="\n"):
    run = base64.b64encode(data).decode()
    return by.join(run[i : i + width] for i in range(0, len(run), width))


PACKED = gzip.compress(f"first {INNER} last".encode(), mtime=0)
HARD = {
    "percent gzip": urllib.parse.quote(PACKED), "all percent gzip": "".join(f"%{b:02x}" for b in PACKED),
    "escaped gzip": "".join(f"\\x{b:02x}" for b in PACKED), "percent bzip2": urllib.parse.quote(bz2.compress(INNER.encode())),
    "other byte": base64.b64encode(b"\xff\xfe " + INNER.encode()).decode(), "control": base64.b64encode(b"\x00\x01" + INNER.encode()).decode(),
    "percent other byte": "%ff%fe" + "".join(f"%{b:02x}" for b in INNER.encode()), "lone surrogate": "\\ud800" + "".join(f"\\u{ord(c):04x}" for c in INNER),
    **{f"glued {glue}": glue + base64.b64encode(INNER.encode()).decode().rstrip("=") for glue in ("/", "io/", "a_b-", "abcde", "https/long-path/x/")},
    "glued packed": "ab/" + base64.b64encode(PACKED).decode(), "glued after": base64.b64encode(INNER.encode() + b"..").decode() + "/rest",
    "wrapped": wrapped(b"x" * 9 + INNER.encode() + b"y" * 9), "wrapped CRLF": wrapped(INNER.encode() * 2, 12, "\r\n"), "wrapped packed": wrapped(PACKED),
    "wrapped escaped": wrapped(PACKED, 20, "\\n"), "second stream": base64.b64encode(gzip.compress(b"nothing here") + b"--" + zlib.compress(INNER.encode())).decode(),
    "two members": base64.b64encode(gzip.compress(INNER[:7].encode()) + gzip.compress(INNER[7:].encode())).decode(),
}


@pytest.mark.parametrize("name", HARD)
def test_hard_layers_are_unwrapped(name):
    text = f"see é {HARD[name]} end"
    spans = [(a, b) for k, a, b in secret_scan.find(text)[1] if k == 0]
    assert any(6 <= a < b <= len(text) - 4 for a, b in spans), spans


def test_each_copy_of_an_encoded_secret_has_its_span():
    run = base64.b64encode(INNER.encode()).decode()
    text = f"word\nlist\n{run} and {run}\nmore"
    spans = secret_scan.find(text)[1]
    assert spans == [(0, 10, 10 + len(run)), (0, 15 + len(run), 15 + 2 * len(run))]


def test_secret_columns_on_odd_rows(make_docs):
    rows = make_docs([(i, t) for i, t in enumerate([*ODD, "token=abcdef token=abcdef", "token=abcdef token=abcdef"])]).withColumn("spans", F.lit(1))
    found = rows.select("*", secret_scan.secrets("text", redact=True).alias("s")).orderBy("doc_id").collect()
    assert [r.s.n_assign for r in found] == [0] * len(ODD) + [2, 2]
    assert found[-1].s.spans == "assign:0:12,assign:13:25" and found[-1].s.redacted == "[SECRET] [SECRET]"
    # a run of 24 or more hexadecimal digits is a find: the long row is one
    assert [r.s.n_hex for r in found[: len(ODD)]] == [int(t == "a" * 9000) for t in ODD]
    assert all(r.s.redacted == ("[SECRET]" if r.s.n_hex else r.text or "") for r in found[: len(ODD)])


# Classifiers


def held_out_accuracy(spark, sf_dir, name, target):
    labels = {r.doc_id: r[target] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len({r.doc_id for r in rows}) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    return sum(a == b for a, b in seen) / len(seen)


def test_quality_on_held_out_rows(spark, sf_dir):
    assert held_out_accuracy(spark, sf_dir.replace("sf0.001", "sf0.01"), "op4_quality", "quality") > 0.95


def test_toxicity_on_held_out_rows(spark, sf_dir):
    assert held_out_accuracy(spark, sf_dir.replace("sf0.001", "sf0.01"), "op6_toxicity", "toxic") > 0.93


def test_classifiers_on_odd_rows_and_without_labels(spark, make_docs):
    docs, none = make_docs(list(enumerate(ODD))), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    grammar, weights = toxicity.fit(docs, none), quality.fit(docs, none)
    rows = docs.withColumn("score", F.lit("clash")).select("doc_id", "score", toxicity.score("text", grammar).alias("t"), quality.score("text", weights).alias("q")).collect()
    assert len(rows) == len(ODD) and all(r.q == 0.5 and 0 < r.t < 0.3 for r in rows)
    assert toxicity.fit(docs.limit(0), none).words == {}


def test_clauses_change_what_an_insult_counts():
    grammar = toxicity.Grammar()
    kinds = lambda t: [toxicity.KINDS[i] for i in np.flatnonzero(grammar.matches(t))]
    assert kinds("what an idiot") == ["insult"]
    assert kinds("you are an idiot") == ["aimed insult"]
    assert kinds("idiot, that is what you are") == ["insult", "aimed later"]
    assert kinds("it is not an idiot") == ["negated insult"]
    assert kinds("someone said idiot") == ["reported insult"]
    assert kinds("she left. an idiot") == ["insult"]
    assert kinds("i will hurt you") == ["threat", "aimed later"]
    scores = [float(grammar.score(grammar.matches(t))) for t in ("a fine day", "it is not an idiot", "what an idiot", "you are an idiot")]
    assert scores == sorted(scores) and scores[0] < scores[-1]


def test_toxic_rows_are_found_by_learned_words(spark, make_docs):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 5)))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            words[10] = words[40] = "zorgle" + word()
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs, table = make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    grammar = toxicity.fit(docs, table)
    out = docs.select("doc_id", (toxicity.score("text", grammar) >= 0.3).alias("hit")).collect()
    assert all(r.hit == (r.doc_id % 5 == 0) for r in out)


# Chat


def test_chat_round_trip_of_hostile_texts(spark):
    rnd = random.Random(9)
    atoms = ["</s>", "<s>", "[INST] ", " [/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</TURN>>", "\\", "[", "<", "/", "INST]", "ok", "\n", " ", "é", "[\\INST]", "<\\\\/s>"]
    roles = ["user", "assistant", "system", "tool", "", None, "<</ROLE>>", "us\\er"]
    rows = [(c, t, rnd.choice(roles), None if rnd.random() < 0.1 else "".join(rnd.choices(atoms, k=rnd.randint(0, 8)))) for c in range(60) for t in range(rnd.randint(1, 6))]
    rows += [(None, 0, "user", "no id"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (8, None, "user", "x")]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit(1)))
    out = out.withColumn("turns", chat.recovered(F.col("parsed"))).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    assert len(got) == len({r[0] for r in rows})
    for conv, row in got.items():
        turns = sorted((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert [(t.role, t.text) for t in row.turns] == [(r, x) for _, r, x in turns]
        assert row.loss == "".join(x for _, r, x in turns if r == "assistant")
        for span in row.loss_spans:
            assert row.formatted[span.start - 3 : span.start] == "<s>" and row.formatted[span.start + span.length :].startswith("</s>")


def test_only_conflicting_texts_are_escaped(spark):
    rows = [(1, 0, "user", "a < b [c] \\ d"), (1, 1, "assistant", "x </s> y")]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).first()
    assert out.formatted == "[INST] a < b [c] \\ d [/INST]<s>x <\\/s> y</s>"
    empty = chat.format_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))
    assert empty.count() == 0
