"""The stream of database changes to order messages and order rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daytally import schemas
from daytally.operators.changes import checked_changes, checked_orders, order_messages_of_lines
from daytally.sources.keyed import KeyedTable
from daytally.sources.snapshots import DayTable
from daytally.sources.tables import stream_table
from daytally.sources.topics import write_batches, write_topics

#: The name by which the tables below know the batches of the stream that writes them.
WRITER = "order-changes"


def publish_orders(
    lines: DataFrame, checkpoint: str, subscription: str = ".*", **sink
) -> StreamingQuery:
    """Change lines to messages on the order topic, one per inserted order."""
    return write_topics(order_messages_of_lines(lines, subscription), checkpoint, **sink)


def order_stream(
    messages: DataFrame,
    checkpoint: str,
    path: str,
    trigger: dict | None = None,
    keep_days: int | None = None,
    files_per_day: int | None = None,
) -> StreamingQuery:
    """Order messages to the order table, each id of a day once.

    Messages that give no row are counted as rejected; ``changes.order_rejects`` shows
    them. With ``keep_days`` a day leaves the state once an order that many days younger
    has come.
    """
    checked = checked_orders(messages).observe(
        "orders", F.count(F.lit(1)).alias("received"), F.count("reason").alias("rejected")
    )
    rows = checked.where("reason is null").select(schemas.ORDER_INFO.fieldNames())
    key = ["create_date", "id"]
    if keep_days is None:
        rows = rows.dropDuplicates(key)
    else:
        midnight = F.timestamp_seconds(F.unix_date(F.col("create_date").cast("date")).cast("bigint") * 86_400)
        dated = rows.withColumn("midnight", midnight).withWatermark("midnight", f"{keep_days} days")
        rows = dated.dropDuplicates(["midnight", "id"]).drop("midnight")
    return stream_table(rows, checkpoint, path, "create_date", trigger, files_per_day)


def order_table(spark: SparkSession, path: str) -> KeyedTable:
    """Orders by id, as the change log leaves them."""
    return KeyedTable(spark, path, schemas.ORDER_INFO, "id", "create_date")


def reject_table(spark: SparkSession, path: str) -> DayTable:
    """Lines that gave no row, by reason."""
    return DayTable(spark, path, schemas.REJECTS, "reason")


def order_changes_stream(
    lines: DataFrame,
    checkpoint: str,
    path: str,
    rejects: str,
    subscription: str = ".*",
    trigger: dict | None = None,
    between: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Change lines to the order table, updates and deletes included, and what is no change to the table of rejects.

    Each line is parsed once for both. Both tables know the batches they have, so a batch that is delivered again
    after a failure, between them too, is in each of them once. ``between`` is a further sink, called between the two.
    """
    table, refused = order_table(lines.sparkSession, path), reject_table(lines.sparkSession, rejects)

    def keep(batch: DataFrame, number: int) -> None:
        table.append(batch.where("reason is null"), WRITER, number)

    def refuse(batch: DataFrame, number: int) -> None:
        refused.append(batch.where("reason is not null"), WRITER, number)

    checked = checked_changes(lines, subscription)
    sinks = (keep, between, refuse) if between else (keep, refuse)
    return write_batches(checked, checkpoint, *sinks, trigger=trigger)
