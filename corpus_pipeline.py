"""From raw documents to packed training sequences: five stages, each one operator.

Toxic documents go, then exact copies, then near copies (five-word shingles,
similarity 0.8 or more; the smallest id of each group stays). What is left is put
into an order that mixes the sources to their target weights, and packed: groups of
documents that are neighbours in that order share their sequences.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import read
from tickloom.llm.exact_dedup import drop_copies
from tickloom.llm.mix import mixed
from tickloom.llm.pack import neighbours, pack_documents
from tickloom.llm.parity_join import Similarity, drop_similar
from tickloom.llm.queries import tokenizer_spec
from tickloom.llm.toxicity import drop_toxic
from tickloom.session import checkpoint_dir

NEAR = Similarity(words=5, needed=80, parts=100)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_similar(docs, NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places; rows that stand together in the mixed files share sequences."""
    return pack_documents(docs, tokenizer_spec(), with_ids=False, group=neighbours(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("mix", mix),
    ("packing", packing),
]

# A trained network decides in the first stage, so there is no SQL for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each result is stored and read again."""
    folder = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
