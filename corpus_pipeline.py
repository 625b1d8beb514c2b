"""A corpus from raw documents to packed sequences; each stage reads what the one before it wrote.

Every stage works on all documents that its predecessor kept, and all but the last return the
columns of the input, whatever they are:

toxicity      documents that the classifier chain calls toxic go
exact dedup   of equal texts the largest doc_id stays
near dedup    of a group of near copies (five words, 0.8) the smallest doc_id stays
secret scan   secrets are replaced in the texts, and n_chars follows where it is a column
packing       the texts' tokens in sequences of 4096, one row for each piece with its ids

Null texts count as empty and stay null; documents without doc_id pass the near dedup; empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daytally import settings
from daytally.llm import chunk_dedup, packing, secrets, sketch_dedup, toxicity_chain
from daytally.sources.views import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER, END_ID = "word_bpe_49k.json", 2


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_chain.without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunk_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sketch_dedup.drop_near_copies(docs, width=5, threshold=0.8)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Trained models and a tokenizer take part, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; the stages' outputs stay in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = settings.new_run_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
