"""A corpus from documents to tokens: reject toxic texts, drop near copies, remove secrets, mix sources, tokenise.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps with their columns (the last: tokens
as well). Stages are written as Parquet to the shared checkpoint folder and read again, so a lost executor
costs tasks of one stage. Empty tables pass through; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemason.llm import byte_bpe, mixing, secret_scan, simhash, toxicity
from lakemason.llm.queries import vocabulary_path
from lakemason.session import scratch
from lakemason.sources.tables import read

#: Score from which the toxicity stage rejects a document.
REJECT = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``REJECT`` by a grammar fitted on the labelled ones among them."""
    grammar = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score("text", grammar) < REJECT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the first by id (nulls last), then by text digest. The group alone
    decides: rows that share an id or have none stay if their texts are not near copies."""
    return simhash.one_of_each(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the secrets found in any layer; a null text stays null."""
    found = docs.withColumn("__found", secret_scan.secrets("text", redact=True)["redacted"])
    text = F.when(F.col("text").isNotNull(), F.col("__found"))
    clean = found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint"))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time it takes them, in mixed order."""
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its packed token ids, their number, and the text that they decode to."""
    both = docs.withColumn("__tokens", byte_bpe.encode_decode("text", vocabulary_path()))
    ids = F.col("__tokens.ids")
    return both.select(
        *[F.col(f"`{c}`") for c in docs.columns], (F.length(ids) / 4).cast("bigint").alias("n_tokens"), ids.alias("ids"),
        F.sha2("__tokens.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near duplicates", drop_near_copies),
    ("secrets", remove_secrets),
    ("mixing", mix_sources),
    ("tokens", tokenise),
]

#: The stages learn from labels, search and tokenise, which SQL cannot say; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
