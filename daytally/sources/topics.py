"""Topics of text records, on a message broker or in a folder of files.

With ``fmt="kafka"`` the broker options (servers, security, ``minPartitions``,
``maxOffsetsPerTrigger``) come from the caller. ``fmt="recordlog"`` is a record log
with offsets (``daytally.sources.records``). Any other format is a folder that
holds one ``topic=<name>`` sub-folder per topic, as the sink below writes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daytally.sources import records

# Fixed value: the pause between two micro-batches.
TRIGGER = "5 seconds"

FILE_TOPIC = "value string, topic string"


def stream_topic(
    spark: SparkSession,
    topic: str,
    fmt: str = "kafka",
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """A streaming frame with a ``value`` text column, starting at the newest records.

    From a broker or a record log it also has each record's own ``timestamp``; files
    have none.
    """
    if fmt == records.FORMAT:
        return records.stream_records(spark, path, topic, **options).select("value", "timestamp")
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        settings = {"subscribe": topic, "startingOffsets": "latest", **options}
        return reader.options(**settings).load().select(F.col("value").cast("string").alias("value"), "timestamp")
    # Read from the root: a sink's commit log there lists whole batches only.
    lines = reader.schema(FILE_TOPIC).options(**options).load(path)
    return lines.where(F.col("topic") == topic).select("value")


def read_topic(spark: SparkSession, topic: str, path: str) -> DataFrame:
    """The committed records of a file topic as a batch frame."""
    lines = spark.read.schema(FILE_TOPIC).text(path)
    return lines.where(F.col("topic") == topic).select("value")


def _started(writer, trigger: dict) -> StreamingQuery:
    return writer.trigger(**trigger).start()


def write_topics(
    routed: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    path: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Send (topic, value) records, each to the topic it names, without a key."""
    writer = (
        routed.select("topic", "value")
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    if name:
        writer = writer.queryName(name)
    if fmt != "kafka":
        writer = writer.partitionBy("topic").option("path", path)
    return _started(writer, trigger or {"processingTime": TRIGGER})


def append_log(
    lines: DataFrame, checkpoint: str, path: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append (value, logdate) lines as text files, one folder per day."""
    writer = (
        lines.select("value", "logdate")
        .writeStream.format("text")
        .outputMode("append")
        .partitionBy("logdate")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return _started(writer, trigger or {"processingTime": TRIGGER})


def write_batches(
    stream: DataFrame,
    checkpoint: str,
    *writers: Callable[[DataFrame, int], None],
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Hand every micro-batch to foreign sinks.

    With several sinks the batch is kept while they run, so that all of them see
    the same rows. A batch can be handed over again after a failure; writers must
    use the batch number to make that harmless.
    """

    def deliver(batch: DataFrame, number: int) -> None:
        if len(writers) == 1:
            writers[0](batch, number)
            return
        batch.persist()
        try:
            for write in writers:
                write(batch, number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(deliver).outputMode(mode).option("checkpointLocation", checkpoint)
    return _started(writer, trigger or {"processingTime": TRIGGER})
