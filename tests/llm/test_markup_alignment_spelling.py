"""Page text, tokenizer alignment and spelling variants against plain versions of the same definitions."""

import collections
import hashlib
import html
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemason.llm import alignment, html_text, spelling
from lakemason.llm.queries import QUERIES, SQL, pieces_path, tokenizer_path
from tests.oracle import compare, connect

pytest.importorskip("public_tokenizers")

PAGES = "page_id bigint, url string, html string"


@pytest.mark.parametrize("name", ["op11_html_text", "op13_spelling"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None


# Pages


def test_best_region_is_the_largest_sum():
    rnd = random.Random(2)
    for _ in range(300):
        scores = [rnd.choice([-9.0, -2.0, -1.0, 0.0, 1.0, 3.0]) for _ in range(rnd.randint(0, 14))]
        first, stop, total = html_text.best_region(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores) + 1) for j in range(i, len(scores) + 1)]
        assert total == max(sums) and sum(scores[first:stop]) == total


def page(body, head="<title>T</title><script>var a = '<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


WORDS = "one two three four five six seven eight nine ten eleven twelve"
CASES = {
    "plain article": (f"<nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>{WORDS}</p></article><footer>Foot</footer>", f"A & B\n{WORDS}"),
    "no article": (f"<header><p>Site</p></header><div class='menu'><ul><li>x y</li></ul></div><div class=content><h2>Head</h2><p>{WORDS}<p>{WORDS}</div><aside>more</aside>", f"Head\n{WORDS}\n{WORDS}"),
    "parts inside": (f"<article><header><h1>Head</h1></header><p>{WORDS}</p><div class='ad-box'>buy now</div><form><p>mail</p><input></form><style>p{{}}</style><p>{WORDS}</p>"
                     "<section class='comments'><p>nice text</p></section></article>", f"Head\n{WORDS}\n{WORDS}"),
    "inline marks": (f"<article><p>a<b>b</b> &lt;c&gt; d<br>e&nbsp;f&#x41;\n\n g <i>h</p><ul><li>{WORDS}<li>k</ul></article>", f"ab <c> d e fA g h\n{WORDS}\nk"),
    "comments and quotes": (f"<article><!-- <p>no</p> --><p title='a > b'>{WORDS}</p><p>1 < 2 & 3</p></article>", f"{WORDS}\n1 < 2 & 3"),
    "unclosed": (f"<article><p><b>{WORDS}<br><p>{WORDS}", f"{WORDS}\n{WORDS}"),
    "list in article": (f"<nav><ul><li>a<li>b</ul></nav><main><p>{WORDS}</p><ol><li>{WORDS}</li></ol><p>{WORDS}</p></main><p class=notice>We use cookies</p>", f"{WORDS}\n{WORDS}\n{WORDS}"),
    "nothing": ("<nav><ul><li>a</li></ul></nav><footer><p>foot</p></footer>", ""),
}


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return html_text.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@pytest.mark.parametrize("name", CASES)
def test_pages_of_other_shapes(weights, name):
    body, text = CASES[name]
    assert html_text.main_text(page(body), weights) == text


def test_pages_on_odd_rows(spark, weights):
    odd = [None, "", " ", "<", "<a", "</", "<p", "x < y", "<!-- open", "<script>open", "&amp", "<p>" * 3000, "<a href='x" * 500, "\x00<p>\x1c"]
    long = page("<article>" + f"<p>{WORDS}</p>" * 3000 + "</article>")
    rows = [(i, None, h) for i, h in enumerate(odd)] + [(None, "u", long), (None, "u", long)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit(1))
    got = pages.select("*", html_text.extract("html", weights).alias("found")).collect()
    assert len(got) == len(rows) and all(r.found is not None for r in got)
    assert [r.found for r in got if r.url] == ["\n".join([WORDS] * 3000)] * 2
    assert {r.html: r.found for r in got}["x < y"] == "x < y"
    assert {r.found for r in got if not (r.html or "").strip()} == {""}
    none = html_text.fit(pages.limit(0))
    assert html_text.main_text(page(CASES["plain article"][0]), none) == CASES["plain article"][1]
    assert pages.limit(0).select(html_text.extract("html", none)).count() == 0


def test_query_texts_equal_the_articles(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for row in QUERIES["op11_html_text"](spark, sf_dir).collect():
        article = re.search("(?s)<article>(.*?)</article>", pages[row.page_id])[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article))
        assert row.text == "\n".join(b for b in blocks if b) and row.n_chars == len(row.text)


# Alignment


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(tokenizer_path(), pieces_path())


def plain_groups(tok, text):
    """Groups of ids by the offsets where both end; nothing for texts without tokens."""
    if not text:
        return None
    ids = tok.a.encode(" " + text, add_special_tokens=False).ids, tok.b.encode(text)
    pieces = [[table[i] for i in side] for table, side in zip((tok.a_bytes, tok.b_bytes), ids)]
    if any(b"".join(side) != (" " + text).encode() for side in pieces):
        return None
    ends = [list(itertools.accumulate(map(len, side))) for side in pieces]
    found, at = [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        group = []
        for k in (0, 1):
            stop = ends[k].index(end, at[k]) + 1
            group.append(ids[k][at[k] : stop])
            at[k] = stop
        found.append(group)
    return found


def plain_rows(tok, docs):
    grouped = [(d, plain_groups(tok, t)) for d, t in docs]
    links = [[(a, b) for ga, gb in groups or [] for a in ga for b in gb] for _, groups in grouped]
    count = collections.Counter(link for found in links for link in set(found))
    top = collections.Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    for (doc_id, groups), found in zip(grouped, links):
        said = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups or [])
        yield (
            doc_id, sum(len(g[0]) for g in groups or []), sum(len(g[1]) for g in groups or []), len(groups or []), len(found),
            sum(count[x] == top[x[0]] for x in found), sum(count[x] for x in found), hashlib.sha256(said.encode()).hexdigest() if groups else "")


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_products_of_sparse_matrices(monkeypatch):
    rnd = np.random.default_rng(1)
    for limit in (alignment.PRODUCTS, 5):
        monkeypatch.setattr(alignment, "PRODUCTS", limit)
        for _ in range(40):
            n, m, k = rnd.integers(0, 8, 3)
            left, right = rnd.integers(0, 3, (n, m)), rnd.integers(0, 3, (m, k))
            made = []
            for dense in (left, right):
                rows, cols = np.nonzero(dense)
                made.append(alignment.Csr.of(rows, cols, dense[rows, cols], dense.shape))
            product = made[0] @ made[1]
            dense = np.zeros((n, k), np.int64)
            dense[product.rows, product.cols] = product.vals
            assert (dense == left @ right).all() and len(product.ptr) == n + 1


def test_alignment_of_odd_texts(spark, make_docs, tokenizers):
    rnd = random.Random(4)
    atoms = ["a", "the", "é", "中文字", " ", "  ", "\n", " \n ", "\t", "23", "'s", "▁", "<s>", "<|endoftext|>", "\U0001f600", "x" * 50, "\x00", "\xa0", "?!", "ing", "<0x41>", " of", " and", "\r\n", "\x1c", "\x85"]
    texts = [None, "", " ", "\n", "a" * 9000, "中文" * 2000, "  lead", "trail  ", "a\n b", "a \nb", "x\xa0 y z"] + ["".join(rnd.choices(atoms, k=rnd.randint(1, 25))) for _ in range(400)]
    rows = list(enumerate(texts)) + [(None, "the of"), (3, "the of"), (3, "the of")]
    docs = make_docs(rows).withColumn("n_a", F.lit("clash")).withColumn("a", F.lit(1))
    want = sorted(plain_rows(tokenizers, rows), key=str)
    for size in (alignment.BLOCK, 300):
        got = alignment.linked_counts(docs, tokenizer_path(), pieces_path(), size).select(*COLUMNS).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert alignment.linked_counts(docs.limit(0), tokenizer_path(), pieces_path()).count() == 0


def test_alignment_query(spark, sf_dir, tokenizers):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op12_alignment"](spark, sf_dir).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(plain_rows(tokenizers, docs))


def test_overlap_links_of_a_text(spark, make_docs, tokenizers):
    texts = ["Unbelievable naïveté, 12345 tokens!", "", None, "▁"]
    for row in make_docs(list(enumerate(texts))).select("text", alignment.align("text", tokenizer_path(), pieces_path()).alias("x")).collect():
        groups = plain_groups(tokenizers, row.text) or []
        assert [i for g in groups for i in g[0]] == row.x.a_ids and [i for g in groups for i in g[1]] == row.x.b_ids
        assert row.x.a_groups == [k for k, g in enumerate(groups) for _ in g[0]] and row.x.b_groups == [k for k, g in enumerate(groups) for _ in g[1]]
        spans = [[(e - len(t[i]), e) for i, e in zip(ids, itertools.accumulate(len(t[i]) for i in ids))] for t, ids in ((tokenizers.a_bytes, row.x.a_ids), (tokenizers.b_bytes, row.x.b_ids))]
        shared = [(i, j, min(a[1], b[1]) - max(a[0], b[0])) for i, a in enumerate(spans[0]) for j, b in enumerate(spans[1])]
        assert [tuple(o) for o in row.x.overlaps] == [s for s in shared if s[2] > 0]


# Spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_scan_of_sorted_blocks():
    rnd = random.Random(1)
    for _ in range(60):
        rows = []
        for k in range(rnd.randint(0, 4)):
            rows += [(k, w) for w in sorted({"".join(rnd.choices("abé", k=rnd.randint(0, 6))) for _ in range(rnd.randint(1, 40))})]
        left, right = spelling.near_rows(np.array([r[0] for r in rows]), [r[1] for r in rows])
        want = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if rows[i][0] == rows[j][0] and one_edit(rows[i][1], rows[j][1])]
        assert sorted(zip(left.tolist(), right.tolist())) == want


@pytest.mark.parametrize("block", [spelling.BLOCK, 30, 2])
def test_near_pairs_whatever_the_size_of_blocks(spark, block):
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choices("abcé", k=rnd.randint(6, 9))) for _ in range(700)} | {"same" + "".join(rnd.choices("xy", k=4)) + "tail" for _ in range(16)})
    pairs = spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), block).collect()
    assert sorted(map(tuple, pairs)) == [p for p in itertools.combinations(words, 2) if one_edit(*p)]


def plain_variants(docs):
    n = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: v if v and words[v] >= 5 * words[w] else None for w, v in best.items()}
    for w, k in words.items():
        root = w
        while form[root]:
            root = form[root]
        yield w, k, len(near[w]), form[w], words[form[w]] if form[w] else None, root


def test_variants_of_a_small_corpus(spark, make_docs):
    rnd = random.Random(8)
    chain = ["letters", "lettors", "lottors"]  # each five times as frequent as the next
    texts = [" ".join(rnd.choices(["hello", "Hellos", "heLlös", "Été", "banana", "bananas", "bandana", "ÉTÉETE", "ÉtÉete", "x" * 400, "x" * 401, "×÷×÷×÷", "a-b_c", "café9theque"], k=60)) for _ in range(60)]
    texts += [" ".join([chain[0]] * 200 + [chain[1]] * 36 + [chain[2]] * 6), None, "", "\n", "é" * 9000]
    rows = list(enumerate(texts)) + [(None, "banana Banana"), (4, texts[4]), (4, texts[4])]
    docs = make_docs(rows).withColumn("word", F.lit(1)).withColumn("n", F.lit("clash"))
    got = spelling.group_variants(docs).select("word", "n", "n_near", "form", "form_n", "root").collect()
    want = sorted(plain_variants(rows), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert {w: r for w, *_, r in want}["lottors"] == "letters"
    assert spelling.group_variants(docs.limit(0)).count() == 0


def test_roots_of_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(25)] + [("v", "w20")]
    got = spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()
    assert {tuple(r) for r in got} == {(w, "w25") for w, _ in forms}
