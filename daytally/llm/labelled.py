"""The bounded sample of labelled documents that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier learns from at most (about 16 bytes each, so they may be broadcast).
SAMPLE_ROWS = 20_000


def remainder(parts: int = 5) -> Column:
    """crc32(doc_id as text) mod parts."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def sample(labels: DataFrame, columns: list[str], held_out: int = 0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents outside the held-out fold: those of the smallest hash of doc_id.

    A document labelled more than once counts as one, with its highest labels; rows whose labels
    are all null don't count.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.coalesce(*columns).isNotNull())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), *columns).where(remainder() != held_out)
    known = known.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns])
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
