"""One query for each operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemason.llm import (
    alignment, byte_bpe, chat, html_text, mixing, multi_index, ngram_lm, quality, secret_scan, simhash, spelling, toxicity, uniform_threshold)
from lakemason.llm.labelled import held_out
from lakemason.sources.tables import read

# Fixed value: the conversation that every run adds.
ADDED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "source", mixing.words("text").alias("size"))
    mixed = mixing.mix(docs).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP1_SQL = r"""
WITH docs AS (SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
units AS (SELECT doc_id, source, size, count(*) AS n, size * count(*) AS unit, md5(COALESCE(doc_id::VARCHAR, 'null')) AS digest FROM docs GROUP BY doc_id, source, size),
sizes AS (SELECT source, sum(unit)::BIGINT AS source_size FROM units GROUP BY source),
listed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place, source_size * 2 AS cap FROM sizes),
weighed AS (SELECT *, [3.0, 1.0, 2.0][(place - 1) % 3 + 1]::DOUBLE AS weight FROM listed),
levelled AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - COALESCE(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS tried
  FROM weighed),
targets AS (
  SELECT source, place, source_size,
    COALESCE(least(cap::DOUBLE, weight * max(CASE WHEN tried < cap / weight THEN tried END) OVER ()), cap::DOUBLE) AS target
  FROM levelled),
queued AS (
  SELECT u.*, t.place, t.source_size, t.target,
    sum(unit) OVER (PARTITION BY t.place ORDER BY digest, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)::BIGINT AS done
  FROM units u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source),
arrivals AS (
  SELECT *, COALESCE((done + copy * source_size)::DOUBLE / nullif(target, 0), 0) AS finish
  FROM queued, (VALUES (0), (1)) AS c(copy)),
totals AS (
  SELECT *, sum(unit) OVER (ORDER BY finish, place, digest, doc_id NULLS FIRST, size, copy ROWS UNBOUNDED PRECEDING)::BIGINT AS until FROM arrivals),
budget AS (SELECT sum(target) AS budget FROM targets),
kept AS (
  SELECT doc_id, source, size, n, source_size, target, count(*) FILTER (WHERE until - unit / 2 <= budget) AS copies
  FROM totals, budget GROUP BY doc_id, source, size, n, source_size, target)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken
FROM (SELECT *, unnest(range(n)) FROM kept)
"""


def op2_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.search(read(spark, folder, "embeddings"), "vec_id % 20 = 0")


def op3_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    model = ngram_lm.train(docs.filter(~out).select(ngram_lm.text_column()))
    scored = docs.select("doc_id", out.alias("held_out"), ngram_lm.score("text", model).alias("s"))
    return scored.select("doc_id", "held_out", "s.n_tokens", "s.n_known", F.lit(model.words.total).cast("bigint").alias("train_tokens"), "s.base_score", "s.score")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    scored = docs.select("doc_id", held_out().alias("held_out"), quality.score("text", quality.fit(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations")
    rows = rows.unionByName(spark.createDataFrame(ADDED, rows.schema))
    formatted = chat.format_conversations(rows).withColumn("turns", chat.recovered(F.col("parsed")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    formatted = formatted.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    return formatted.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


OP5_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
told AS (
  SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?(?:INST\]|s>|SYS>>|ROLE>>|TURN>>))', '\1#\2\3', 'g')) AS shown,
    length(regexp_replace(role, '([\[<])(\\*)(/?(?:INST\]|s>|SYS>>|ROLE>>|TURN>>))', '\1#\2\3', 'g')) AS named
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))::BIGINT AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(shown + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 15 WHEN 'assistant' THEN 7 ELSE 26 + named END)::BIGINT AS formatted_chars
FROM told GROUP BY conv_id
"""


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.score("text", toxicity.fit(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    both = read(spark, folder, "documents").select("doc_id", byte_bpe.encode_decode("text", vocabulary_path()).alias("t"))
    n = (F.length("t.ids") / 4).cast("bigint")
    return both.select("doc_id", n.alias("n_tokens"), F.sha2("t.ids", 256).alias("ids_sha256"), F.sha2("t.decoded", 256).alias("decoded_sha256"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = read(spark, folder, "documents").select("doc_id", secret_scan.secrets("text").alias("s"))
    return found.select("doc_id", "s.n_assign", "s.n_access", "s.n_hex", F.sha2("s.base", 256).alias("base_sha256"), "s.spans")


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_uniform_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return uniform_threshold.top_k(read(spark, folder, "embeddings"), "vec_id % 50 = 0")


OP10_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM rows q JOIN rows c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""


def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    texts = pages.select("page_id", "url", html_text.extract("html", html_text.fit(pages)).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


# Pages of these tables name their main text: one article of headings and paragraphs.
OP11_SQL = r"""
WITH bodies AS (SELECT page_id, url, COALESCE(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '') AS body FROM pages),
blocks AS (
  SELECT page_id, url, list_transform(string_split_regex(body, '</?(?:h1|p)>'), lambda b:
    regexp_replace(regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;?', '"', 'g')) AS parts
  FROM bodies),
texts AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda b:
    trim(regexp_replace(regexp_replace(b, '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda b: b <> ''), chr(10)) AS text
  FROM blocks)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts
"""


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.linked_counts(read(spark, folder, "documents"), tokenizer_path(), pieces_path())


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(read(spark, folder, "documents")).select("word", "n", "n_near", "form", "form_n", "root")


# Fixed values in it: the CRC-32 remainders of the sixteen half bytes.
OP13_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY doc_id, run),
hexed AS (SELECT run, n, hex(encode(COALESCE(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(0, length(h)), lambda i: (strpos('0123456789ABCDEF', h[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END]) - 1)::BIGINT),
    lambda c, x: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
      3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][(xor(c, x) & 15) + 1]),
    4294967295::BIGINT)) AS crc
  FROM hexed),
made AS (
  SELECT n, CASE WHEN crc % 199 = 0 THEN left(run, (crc % length(run))::INTEGER) || substr(run, (crc % length(run))::INTEGER + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
formed AS (
  SELECT w.word, w.n, COALESCE(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND place = 1),
steps AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.root FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, e.root FROM formed f JOIN ends e ON e.word = f.word
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mixing, op2_multi_index, op3_ngram_lm, op4_quality, op5_chat, op6_toxicity, op7_byte_bpe, op8_secret_scan, op9_simhash, op10_uniform_threshold,
        op11_html_text, op12_alignment, op13_spelling)
}
SQL: dict[str, str] = {"op1_mixing": OP1_SQL, "op5_chat": OP5_SQL, "op10_uniform_threshold": OP10_SQL, "op11_html_text": OP11_SQL, "op13_spelling": OP13_SQL}
