"""The partitioned fact tables: daily active devices and orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daytally import schemas
from daytally.operators.devices import first_per_device
from daytally.sources import files
from daytally.sources.snapshots import DayTable
from daytally.sources.topics import TRIGGER


def _read(spark: SparkSession, schema: T.StructType, paths: tuple[str, ...]) -> DataFrame:
    # One read per path: a streaming sink's commit log is honoured only when
    # its folder is read on its own.
    frames = [spark.read.schema(schema).parquet(path) for path in paths]
    return reduce(DataFrame.unionByName, frames).select(schema.fieldNames())


def read_dau(spark: SparkSession, *paths: str) -> DataFrame:
    """The daily-active-device table; filters on ``logdate`` prune partitions."""
    return _read(spark, schemas.DAU, paths)


def read_devices(spark: SparkSession, *paths: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The first startup of each device from ``first`` to ``last``, out of plain and versioned tables.

    A versioned table of the bounded stream may hold a later startup of a device beside the first one, as
    may a table of late ones, so the first is taken over all of them.
    """
    versioned = [DayTable(spark, path, schemas.DAU, "logdate") for path in paths if files.exists(spark, f"{path}/versions")]
    plain = [path for path in paths if not files.exists(spark, f"{path}/versions")]
    frames = [table.read(first, last) for table in versioned] + ([read_dau(spark, *plain)] if plain else [])
    found = reduce(DataFrame.unionByName, frames)
    for bound, keep in ((first, lambda day, b: day >= b), (last, lambda day, b: day <= b)):
        if bound:
            found = found.where(keep(F.col("logdate"), bound))
    return first_per_device(found) if versioned else found


def read_orders(spark: SparkSession, *paths: str) -> DataFrame:
    """The order table; filters on ``create_date`` prune partitions."""
    return _read(spark, schemas.ORDER_INFO, paths)


def read_visited(spark: SparkSession, *paths: str) -> DataFrame:
    """Who was seen on which day: two columns of the device table."""
    return read_dau(spark, *paths).select("logdate", "mid")


def append_table(rows: DataFrame, path: str, day_column: str) -> None:
    """Append to a day-partitioned table.

    The rebalance hint lets adaptive execution gather each day into files of even
    size and split a day that holds most of the rows.
    """
    rows.hint("rebalance", F.col(day_column)).write.mode("append").partitionBy(day_column).parquet(path)


def replace_days(rows: DataFrame, path: str, day_column: str) -> None:
    """Write the days that ``rows`` holds, in place of what a day-partitioned table had of them."""
    writer = rows.hint("rebalance", F.col(day_column)).write.mode("overwrite").partitionBy(day_column)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def append_dau(devices: DataFrame, path: str) -> None:
    append_table(devices.select(schemas.DAU_COLUMNS), path, "logdate")


def append_orders(orders: DataFrame, path: str) -> None:
    append_table(orders.select(schemas.ORDER_INFO.fieldNames()), path, "create_date")


def stream_table(
    rows: DataFrame,
    checkpoint: str,
    path: str,
    day_column: str,
    trigger: dict | None = None,
    files_per_day: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a day-partitioned table, each batch committed once.

    Every task writes one file per day it holds. ``files_per_day`` gathers the rows
    of a batch into at most that many files per day, for one more shuffle.
    """
    if files_per_day:
        spread = F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_day))
        rows = rows.repartition(F.col(day_column), spread)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(day_column)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": TRIGGER})).start()
