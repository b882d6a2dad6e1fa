"""From documents to packed training sequences, in stages.  Each stage reads what the one before has written."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.common import table
from siltstone.llm.decontaminate import clean
from siltstone.llm.packing import pack_documents
from siltstone.llm.quality import accepted
from siltstone.llm.secrets import redacted
from siltstone.llm.simhash import keep_first
from siltstone.sources.stage import scratch_path, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is trained on the labelled ones among them."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of SimHash near-duplicates."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced by a mark."""
    return redacted(docs, scratch_path(spark, "secret-ledger"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    import public_tokenizers

    return pack_documents(docs, os.fspath(public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secrets),
    ("best_fit_packing", packing),
]

#: Trained trees, fingerprints and tokens: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
