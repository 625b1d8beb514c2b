"""The text operators over the supplied tables, by query name."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm import chunk_dedup, context_tree, filter_audit, packing, partition_join, permutation_index, quality_trees, secrets, sketch_dedup, speculative_bpe, suffix_runs, toxicity_chain, whitening
from daytally.llm.common import ids_back, python_docs
from daytally.sources.views import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_dedup.near_groups(table(spark, sf_dir, "documents"), width=4, threshold=0.8)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.packed(table(spark, sf_dir, "documents"), path, end_id=2)
    columns = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32")]
    return pieces.select(*columns, "doc_tokens", "sequence_id", "offset", "sequence_cost")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_runs.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), digest)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scored(table(spark, sf_dir, "documents"), held_out=1)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scanned(table(spark, sf_dir, "documents"))
    counts = [secrets.counted(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    digest = F.sha2(secrets.shown(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secrets.shown(F.col("spans")).alias("spans"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_trees.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_chain.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded and decoded in one pass of the workers; only the digests leave them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, decode = speculative_bpe.encode_batches(path), speculative_bpe.decode_batches(path)

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in decode(encode(frames)):
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n_tokens": frame["ids"].map(len),
                    "ids_sha256": [hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in frame["ids"]],
                    "decoded_sha256": [hashlib.sha256(text.encode()).hexdigest() for text in frame["decoded"]],
                }
            )

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return ids_back(python_docs(table(spark, sf_dir, "documents")).mapInPandas(digests, kinds))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_join.joined(table(spark, sf_dir, "documents"), width=4, threshold=0.85)


def queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op")}
