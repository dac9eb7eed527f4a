"""A corpus pipeline over ``documents``: each stage is one operator of ``depotwerk.llm``.

Stages take and return the columns of ``documents``; each is written as
Parquet and read again before the next one.  The last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotwerk.llm import exact_dedup, langid, near_dedup, packing, secret_scan
from depotwerk.llm.common import id_bucket, table, written
from depotwerk.llm.queries import WORD_TOKENIZER

LEAST_SHARE = 0.5  # of a document's letters in its language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, at least half of them in one language (operator 4)."""
    model = langid.fit(docs, train=id_bucket("doc_id", 3) != 1)
    return langid.identified(docs, model, LEAST_SHARE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id (operator 1)."""
    return _kept(docs, exact_dedup.exact_dedup(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: word shingles of five, similarity 0.8 (operator 9)."""
    return _kept(docs, near_dedup.near_dedup(docs, words=5, numerator=80))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked (operator 7)."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token sequences (operator 3): one row per piece."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("exact_dedup", exact), ("near_dedup", near), ("secrets", secrets), ("packing", packed),
]

# language identification and tokenisation are learned or given models: no SQL
ORACLE_SQL: str | None = None


def _kept(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id stays; ids are unique, a null id always stays."""
    gone = decided.where("not kept and doc_id is not null").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
