"""What several text operators need: plain inputs, bundles of documents, blocks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally import settings

#: Text bytes that one numpy step works on; bounds the memory of a task.
BLOCK_BYTES = 2_000_000
#: Text bytes of one bundle of documents that a task holds together.
BUNDLE_BYTES = 16_000_000


def plain_docs(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, null texts empty; other columns can't clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


#: Stands for a missing doc_id inside Python steps, where a null would turn its column into floats.
NO_ID = -(1 << 63)


def python_docs(docs: DataFrame) -> DataFrame:
    """plain_docs with NO_ID for a missing doc_id; ids_back undoes that."""
    return plain_docs(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))


def ids_back(frame: DataFrame) -> DataFrame:
    return frame.withColumn("doc_id", F.expr(f"nullif(doc_id, {NO_ID + 1} - 1)"))


def stored(frame: DataFrame) -> DataFrame:
    """The rows kept in the shared checkpoint folder, so that they are computed once and lineage ends."""
    settings.ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def written(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows as a Parquet table of their own in the shared folder, and that table's folder."""
    path = settings.new_run_dir(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path


def tabled(frame: DataFrame, label: str) -> DataFrame:
    """The rows as a table that stays: computed once, lineage ends."""
    return written(frame, label)[0]


def blocks(frames: Iterator[pd.DataFrame], text: str = "text") -> Iterator[pd.DataFrame]:
    """The frames cut into pieces of about BLOCK_BYTES of text; one very long text is a piece of its own."""
    for frame in frames:
        sizes = frame[text].str.len().to_numpy(np.int64)
        part = np.cumsum(sizes) // BLOCK_BYTES
        for start, end in spans_of(part):
            yield frame.iloc[start:end]


def spans_of(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal neighbours."""
    if not len(values):
        return []
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    bounds = [0, *cuts.tolist(), len(values)]
    return list(zip(bounds[:-1], bounds[1:], strict=True))


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of flat[start : start + length]."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


def mix(keys: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    keys = keys ^ (keys >> np.uint64(30))
    keys = keys * np.uint64(0xBF58476D1CE4E5B9)
    keys = keys ^ (keys >> np.uint64(27))
    keys = keys * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one narrow aggregate, used to size partitions."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def in_bundles(docs: DataFrame, size: int = BUNDLE_BYTES) -> tuple[DataFrame, int]:
    """docs with a column ``bundle``: documents dealt by a hash of doc_id into bundles of about so many bytes.

    A source with a third of all rows is spread like any other; one document is never cut.
    """
    count = text_bytes(docs) // size + 1
    return docs.withColumn("bundle", F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int")), count


def partitions_for(spark: SparkSession, at_least: int) -> int:
    """Shuffle partitions for so many groups, not fewer than the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), at_least)
