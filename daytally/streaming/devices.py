"""The stream that keeps one startup per device and day.

Spark's state store plays the part of the visited set: it is updated together
with the input offsets and the output, so a restart neither loses nor repeats a
device.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daytally import schemas
from daytally.operators.devices import KEY, new_on_day
from daytally.operators.ingest import checked_startups
from daytally.sources.tables import stream_table


def _thin_out(startups: DataFrame) -> DataFrame:
    """Keep the first row of each device and day in every Arrow batch."""
    key = list(KEY)

    # Defined here so that it travels to the workers by value.
    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name) for name in key}
            table = pa.table({**columns, "row": np.arange(batch.num_rows)})
            first = table.group_by(key, use_threads=False).aggregate([("row", "min")])
            yield batch.take(first["row_min"].combine_chunks())

    return startups.mapInArrow(first_rows, startups.schema)


def _midnight(logdate: Column) -> Column:
    """A moment per day, always 24 hours apart whatever the session's time zone."""
    return F.timestamp_seconds(F.unix_date(logdate.cast("date")).cast("bigint") * 86_400)


def dedupe_devices(startups: DataFrame, keep_days: int | None = None) -> DataFrame:
    """One record per device and day out of a stream of startups.

    Streaming deduplication has no step before its shuffle, so all records of a
    device would meet in one state partition. Each input task therefore drops the
    repeats within every Arrow batch first: a device that sends a third of all
    records is shuffled as one row per batch of some ten thousand.

    Without ``keep_days`` every day stays in the state and no record is ever
    dropped: right for replaying a stored table, whose files are in no time order.
    With it, a day leaves the state once a record that many days younger has been
    seen; records that come later still are dropped here and merged by
    :func:`late_devices`.
    """
    fewer = _thin_out(startups)
    if keep_days is None:
        return fewer.dropDuplicates(list(KEY))
    dated = fewer.withColumn("midnight", _midnight(F.col("logdate")))
    dated = dated.withWatermark("midnight", f"{keep_days} days")
    return dated.dropDuplicates(["midnight", "mid"]).drop("midnight")


def device_stream(
    lines: DataFrame,
    checkpoint: str,
    path: str,
    keep_days: int | None = None,
    trigger: dict | None = None,
    files_per_day: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Startup lines to the device table, with the row counts before and after.

    The counts ride on the query's progress events, so they cost no extra pass. Lines
    that give no record are counted as rejected; ``ingest.startup_rejects`` shows them.
    """
    checked = checked_startups(lines).observe(
        "startups", F.count(F.lit(1)).alias("received"), F.count("reason").alias("rejected")
    )
    startups = checked.where("reason is null").select(schemas.DAU_COLUMNS)
    devices = dedupe_devices(startups, keep_days)
    counted = devices.observe("devices", F.count(F.lit(1)).alias("kept"))
    return stream_table(
        counted.select(schemas.DAU_COLUMNS),
        checkpoint,
        path,
        "logdate",
        trigger,
        files_per_day,
        name,
    )


def late_devices(raw_startups: DataFrame, devices: DataFrame) -> DataFrame:
    """Devices of the raw log that the stream dropped as too late.

    Run in batch on days that have left the stream's state; the rows replace those days
    in a table of their own (``tables.replace_days``), which is read together with the
    stream's. ``devices`` is the stream's table alone, so that running it again changes
    nothing.
    """
    return new_on_day(raw_startups, devices.select(*KEY))
