"""Operators over whole tables, against brute force on small fixtures, and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lakemason.llm import components, mixing, multi_index, ngram_lm, simhash, uniform_threshold
from lakemason.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

ODD = [None, "", " \n", "one", "one two", "Same Text here", "same text HERE"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    found = found.withColumns({c: F.col(c).cast("bigint") for c, kind in found.dtypes if kind == "int"})
    assert compare(found, connect(sf_dir), SQL[name].replace("::INTEGER", "::BIGINT")) is None


# Mixing


def level_targets(sizes, weights=(3, 1, 2), epochs=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, fixed = epochs * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        share = (budget - sum(fixed.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if weight[s] * share > most * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * share for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def test_mixing_reaches_targets_within_a_document(spark, make_docs):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 30)), rnd.choice(["a", "a", "a", "b", "é", None, "Z"])) for i in range(600)]
    rows += [(i, None, "a") for i in range(600, 605)] + [(5000, "w w", "tiny"), (5001, "dup dup dup", "b"), (5001, "dup dup dup", "b")]
    sized = make_docs(rows).select("doc_id", "source", mixing.words("text").alias("size"))
    out, again = mixing.mix(sized).collect(), mixing.mix(sized.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again)) and sum(r.rows for r in out) == len(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
        largest[source] = max(largest[source], len((text or "").split()))
    goal = level_targets(sizes)
    for r in out:
        assert r.copies in (0, 1, 2) and math.isclose(r.target, goal[r.source], rel_tol=1e-9) and r.source_size == sizes[r.source]
        taken[r.source] += r.size * r.copies * r.rows
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 2 * largest[s] + 1
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 2 * max(largest.values())


def test_mixed_documents_repeat_in_order_and_keep_columns(spark, make_docs):
    docs = make_docs([(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(50)]).withColumn("size", F.lit("clash")).withColumn("copies", F.lit(0))
    copies = {r.doc_id: r.copies for r in mixing.mix(docs.select("doc_id", "source", mixing.words("text").alias("size"))).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in copies.items() if v})
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
    nothing = make_docs([(1, "", "a"), (2, None, None)]).select("doc_id", "source", mixing.words("text").alias("size"))
    assert all(r.target == 0 for r in mixing.mix(nothing).collect())


# Vector searches


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("rank", F.lit("clash"))


def odd_vectors(rng, n=700, dim=12):
    rows = [(i, rng.normal(size=dim).astype(np.float32).tolist(), 0) for i in range(n)]
    rows += [(n + i, rows[5][1], 0) for i in range(40)] + [(20, rows[20][1], 1)]
    nan, inf = float("nan"), float("inf")
    return rows + [(None, rows[0][1], 0), (1000, None, 0), (1020, [], 0), (1040, [nan] * dim, 0), (1060, [inf] + [1.0] * (dim - 1), 0), (1080, [None] * dim, 0)]


def test_multi_index_recall_and_scores(spark):
    rows = odd_vectors(np.random.default_rng(1)) + [(1100, [0.0] * 12, 0)]
    real = {i: np.array(v, np.float64) for i, v, _ in rows if i is not None and i < 1000}
    got = defaultdict(list)
    for r in multi_index.search(vectors(spark, rows), "vec_id % 20 = 0", k=10, block_rows=200).orderBy("query_id", "rank").collect():
        assert math.isclose(r.score, float(real[r.query_id] @ real[r.vec_id]), rel_tol=1e-12, abs_tol=1e-12)
        got[r.query_id].append((-r.score, r.vec_id))
    hits = 0
    for q in (queries := [i for i in real if i % 20 == 0]):
        best = sorted((-float(real[q] @ real[i]), i) for i in real if i != q)[:10]
        assert got[q] == sorted(got[q]) and len(got[q]) == 10
        hits += len({i for _, i in best} & {i for _, i in got[q]})
    assert set(got) == set(queries) and hits / (10 * len(queries)) >= 0.9


def test_multi_index_recall_on_the_table(spark, sf_dir):
    found = {(r.query_id, r.vec_id) for r in QUERIES["op2_multi_index"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    best = {(q, int(ids[j])) for i, q in enumerate(ids.tolist()) if q % 20 == 0 for j in [j for j in np.argsort(-(x @ x[i]), kind="stable") if j != i][:20]}
    assert len(found) == len(best) and len(found & best) / len(best) >= 0.9


def test_searches_of_few_or_no_rows(spark):
    few, none = vectors(spark, [(0, [1.0, 2.0], 0), (100, [1.0, 2.0], 0)]), vectors(spark, [(1, None, 0)]).limit(0)
    assert [tuple(r) for r in multi_index.search(few, "vec_id % 20 = 0").orderBy("query_id").collect()] == [(0, 1, 100, 5.0), (100, 1, 0, 5.0)]
    assert [tuple(r) for r in uniform_threshold.top_k(few, "vec_id % 50 = 0").orderBy("query_id").collect()] == [(0, 1, 100, 256 * 256 * 5), (100, 1, 0, 256 * 256 * 5)]
    assert multi_index.search(none, "vec_id % 20 = 0").count() == uniform_threshold.top_k(none, "vec_id % 50 = 0").count() == 0


def test_searches_keep_rows_that_share_an_id_and_vectors_of_any_length(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=3).astype(np.float32).tolist(), 0) for i in range(100)]
    rows += [(i, rng.normal(size=2).astype(np.float32).tolist(), 0) for i in range(100, 201, 20)]
    rows += [(50, [1.0, 1.0, 0.0], 0), (50, [3.0, 1.0, 0.0], 0), (40, [9.0, 9.0, 9.0], 0), (40, [9.0, 9.0, 9.0], 0)]
    distinct = list({(i, tuple(v)): None for i, v, _ in rows})

    def best(scale, k, step):
        whole = [(i, np.floor(256 * np.array(v)) if scale else np.array(v)) for i, v in distinct]
        want = []
        for q in sorted({i for i, _ in whole if i % step == 0}):
            pairs = [(-float(a @ b), j) for i, a in whole if i == q for j, b in whole if j != q and len(a) == len(b)]
            want += [(q, rank, j, -s) for rank, (s, j) in enumerate(sorted(pairs)[:k], 1)]
        return want

    frame = vectors(spark, rows)
    assert [tuple(r) for r in uniform_threshold.top_k(frame, "vec_id % 50 = 0", block_rows=16).orderBy("query_id", "rank").collect()] == best(True, 5, 50)
    found = [tuple(r) for r in multi_index.search(frame, "vec_id % 20 = 0", k=5, block_rows=32).orderBy("query_id", "rank").collect()]
    want = best(False, 5, 20)
    assert {q for q, *_ in found} == {q for q, *_ in want} and len(found) == len(want)
    near = {(q, j) for q, _, j, _ in found} & {(q, j) for q, _, j, _ in want}
    assert len(near) >= 0.9 * len({(q, j) for q, _, j, _ in want})
    threes = [(i, list(v), 0) for i, v in distinct if len(v) == 3]  # the SQL keeps rows equal in id and vector, the operator counts them once
    connection = duckdb.connect()
    vectors(spark, threes).write.parquet(f"{tmp_path}/v")
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/v/*.parquet'")
    told = sorted(connection.execute(SQL["op10_uniform_threshold"]).fetchall())
    assert [tuple(r) for r in uniform_threshold.top_k(vectors(spark, threes), "vec_id % 50 = 0").orderBy("query_id", "rank").collect()] == told


@pytest.mark.parametrize("stretch", [1.0, 1e9])
def test_uniform_threshold_is_exact_with_ties(spark, stretch):
    rows = [(i, v and [x and x * stretch for x in v], l) for i, v, l in odd_vectors(np.random.default_rng(4), 300)]
    real = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, _ in rows if i is not None and i < 1000}
    got = [tuple(r) for r in uniform_threshold.top_k(vectors(spark, rows), "vec_id % 50 = 0", block_rows=64).orderBy("query_id", "rank").collect()] if stretch == 1 else None
    want = []
    for q in sorted(i for i in real if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(real[q], real[i])), i) for i in real if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    if stretch == 1:
        assert got == want
    else:  # sums beyond a long are refused, never wrong
        with pytest.raises(Exception):
            uniform_threshold.top_k(vectors(spark, rows), "vec_id % 50 = 0").collect()


# SimHash


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {p: p for p in set(prints.values())}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if a < b and (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    low = {}
    for i, p in prints.items():
        low[root(p)] = min(low.get(root(p), i), i)
    return {i: low[root(p)] for i, p in prints.items()}


def test_simhash_query_against_all_pairs(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    want = brute_components(prints)
    got = QUERIES["op9_simhash"](spark, sf_dir).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" for r in got)


def test_simhash_on_odd_rows(spark, make_docs):
    docs = make_docs([(i + 10, t) for i, t in enumerate(ODD + ODD)]).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(1))
    got = simhash.near_duplicates(docs).collect()
    want = brute_components({i + 10: plain_print(t) for i, t in enumerate(ODD + ODD)})
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted(want.items())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", [2, 3, 4, 5])
def test_links_connect_crowded_fingerprints(spark, partitions):
    rnd = random.Random(partitions)
    centre = rnd.getrandbits(64)
    prints = {centre, 0, (1 << 64) - 1}
    while len(prints) < 400:
        near = centre
        for _ in range(rnd.randint(1, 6)):
            near ^= 1 << rnd.randrange(64)
        prints |= {near, rnd.getrandbits(64)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.link(spark.createDataFrame(signed, "fp bigint"), 3, partitions, block=40).collect()  # crowded values are dealt over several blocks
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        parent[root(a)] = root(b)
    want = brute_components(dict(enumerate(prints)))
    groups = defaultdict(set)
    for i, p in enumerate(prints):
        groups[root(p)].add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_thresholds_are_the_cheapest_that_sum_up():
    rng = np.random.default_rng(0)
    costs = rng.random((50, 3, 5)).cumsum(axis=2)
    costs[:, :, 0] = 0
    chosen = simhash.allocate(costs, 1)
    assert (chosen.sum(axis=1) == 1).all()
    for q in range(50):
        every = [(a, b, 1 - a - b) for a in range(-1, 4) for b in range(-1, 4) if -1 <= 1 - a - b <= 3]
        price = lambda t: sum(costs[q, k, x + 1] for k, x in enumerate(t))  # noqa: E731, B023
        assert math.isclose(price(chosen[q]), min(map(price, every)))


def test_components_of_chains_stars_and_nulls(spark):
    rnd = random.Random(1)
    chain = list(range(100, 160))
    rnd.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(1, i) for i in range(2, 40)] + [(5, 5), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {**{i: 100 for i in chain}, **{i: 1 for i in range(1, 40)}, 200: 200, 201: 200}


# Language model


def brute_scores(texts, held_out):
    """The same model from dictionaries."""
    split = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    unigrams, pairs = Counter(), Counter()
    for i, words in split.items():
        if i not in held_out:
            unigrams.update(words)
            pairs.update(zip([None, *words], words))
    n, v = sum(unigrams.values()), len(unigrams)
    d = ngram_lm.discounts(np.array([sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)]))
    before, after = Counter(w for _, w in pairs), defaultdict(list)
    for (h, _), c in pairs.items():
        after[h].append(c)
    e = ngram_lm.discounts(np.array([sum(c == k for c in before.values()) for k in (1, 2, 3, 4)]))
    rest = sum(e[min(c, 3)] for c in before.values()) / len(pairs) if pairs else 1.0
    out = {}
    for i, words in split.items():
        base = score = 0.0
        for h, w in zip([None, *words], words):
            base += math.log10((unigrams[w] + 0.1) / (n + 0.1 * (v + 1)))
            p = max(before[w] - e[min(before[w], 3)], 0) / max(1, len(pairs)) + rest / (v + 1)
            if after[h]:
                c = pairs[h, w]
                p = (max(c - d[min(c, 3)], 0) + sum(d[min(x, 3)] for x in after[h]) * p) / sum(after[h])
            score += math.log10(p)
        out[i] = len(words), sum(unigrams[w] > 0 for w in words), n, base, score
    return out


def test_language_model_against_dictionaries(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    want = brute_scores(texts, out)
    for r in QUERIES["op3_ngram_lm"](spark, sf_dir).collect():
        n_tokens, n_known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id in out, n_tokens, n_known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_language_model_sums_to_one_and_takes_odd_rows(spark, make_docs):
    docs = make_docs(list(enumerate([*ODD, "a b a b c", "a a a"] * 2))).withColumn("score", F.lit("clash"))
    model = ngram_lm.train(docs.select(ngram_lm.text_column()), per_shard=8)  # frequent histories get several shards
    rows = docs.select("doc_id", "text", ngram_lm.score("text", model).alias("s")).collect()
    want = brute_scores({r.doc_id: r.text for r in rows}, set())
    for r in rows:
        assert (r.s.n_tokens, r.s.n_known) == want[r.doc_id][:2] and math.isclose(r.s.score, want[r.doc_id][4], rel_tol=1e-9)
    hashes = [xxhash.xxh64_intdigest(w) for w in (b"one", b"two", b"same", b"text", b"here", b"a", b"b", b"c", b"", b"unknown")]
    for history in (b"", b"a", b"never seen"):
        pairs = np.array([[xxhash.xxh64_intdigest(history), h] for h in hashes], np.uint64).ravel()
        p, _ = model.probabilities(pairs, np.zeros(1, np.int64))
        assert math.isclose(p[1::2].sum(), 1.0, rel_tol=1e-9)
    empty = ngram_lm.train(docs.limit(0).select(ngram_lm.text_column()))
    assert docs.select(ngram_lm.score("text", empty).alias("s")).filter("s.score = 0 AND s.base_score = 0").count() == docs.count()


# Pipeline


def test_pipeline_decisions_against_plain_versions(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    frame, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES:
        before = frame
        frame = stage(spark, frame, sf_dir).cache()
        ids = Counter(r.doc_id for r in frame.select("doc_id").collect())
        if name != "tokens":
            assert frame.columns == columns
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            clean = [i for i, toxic in labels.items() if not toxic]
            assert sum(i in ids for i in clean) >= 0.98 * len(clean) and len(ids) < len(docs)
        elif name == "near duplicates":
            left = {r.doc_id: plain_print(r.text) for r in before.collect()}
            assert set(ids) == set(brute_components(left).values()) and set(ids.values()) == {1}
        elif name == "secrets":
            assert set(ids) == set(kept)
            assert frame.filter(F.col("text").rlike("AKIA[A-Z0-9]{16}")).count() == 0
        elif name == "mixing":
            assert max(ids.values()) == 2 and set(ids) <= set(kept)
        else:
            assert frame.filter("decoded_sha256 <> sha2(text, 256)").count() == 0 and sum(ids.values()) == sum(kept.values())
        kept = ids
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == kept


def test_stages_take_odd_and_empty_tables(spark, sf_dir, make_docs):
    rows = make_docs([(i, t, [None, "a", "b"][i % 3]) for i, t in enumerate(ODD)] + [(None, "x y z", "a"), (3, "one", "a"), (3, "one", "a")])
    docs = rows.withColumn("score", F.lit(1)).withColumn("size", F.lit(2)).withColumn("root", F.lit(3))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() > 0, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name


def test_near_copies_are_dropped_by_component_not_by_id(spark, sf_dir, make_docs):
    alone = [" ".join(f"{name}{i}" for i in range(40)) for name in ("ant", "bee", "cat", "dog", "elk", "fox")]
    rows = [(None, alone[0]), (None, alone[1]), (7, alone[2]), (7, alone[3])]
    rows += [(1, alone[4]), (2, alone[4]), (2, alone[5]), (None, alone[5]), (9, alone[0]), (9, alone[0])]
    want = sorted([(9, alone[0]), (None, alone[1]), (7, alone[2]), (7, alone[3]), (1, alone[4]), (2, alone[5])], key=str)
    for docs in (make_docs(rows), make_docs(rows[::-1]).repartition(5)):
        out = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == want
