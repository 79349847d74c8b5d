"""Labelled training rows, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemason.session import cut


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never read: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, target: str, max_rows: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``max_rows`` labelled documents that are not held out.

    The bound is what a fit may read; rows are chosen by a hash of the id, so the choice is spread over
    all labelled documents and reruns agree. A document with several labels counts by the largest, an id with
    several texts by the one with the smallest digest (kept where rows are read, so an id on many rows is no
    hot spot). The rows are written to the checkpoint folder once, as each fit reads them more than once.
    """
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(target).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    picked = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return cut(picked.select("doc_id", "text", "label"))
