"""Labelled examples for the classifiers: bounded, deterministic samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int, held: int) -> Column:
    """Whether crc32 of the id as text leaves `held`; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == held, F.lit(False))


def known(labels: DataFrame, label: str, folds: int, held: int, most: int, doc_id: str = "doc_id") -> DataFrame:
    """`doc_id` and `label` of labelled documents outside the held-out fold, at most `most` of them.

    They are the first in the order of a hash of their ids, so the choice depends on nothing but the ids.  Ids
    whose labels are null or contradict each other are left out.
    """
    return (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null")
        .where(~fold(F.col("doc_id"), folds, held)).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"), F.count("*").alias("n"), F.count("label").alias("full"))
        .where("label = most and n = full").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "label")
    )


def examples(docs: DataFrame, chosen: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `text` and `label` of the documents among the `known` ids, whose bounded number is sent to
    all executors, so no text is shuffled.  A document that comes several times gives several rows."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
