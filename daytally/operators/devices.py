"""One startup per device and day, and the set of devices already seen.

Day and device together are the key everywhere, so a batch that spans midnight or
arrives late is compared with its own day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.functions.calendar import day_of, hour_of

KEY = ("logdate", "mid")


def first_per_device(startups: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The earliest whole record of each device and day.

    Spark keeps one candidate per key in every input task before it shuffles, so a
    device with a large part of all rows reaches the final task as one row per
    input task.
    """
    ranked = Window.partitionBy(*KEY).orderBy(*order)
    return startups.withColumn("rank", F.row_number().over(ranked)).where("rank = 1").drop("rank")


def first_seen(startups: DataFrame) -> DataFrame:
    """Key, first ``ts`` and its hour only.

    A plain minimum of a number, so it runs as a hash aggregate with a partial
    step before the shuffle and needs no sort; enough for every count.
    """
    seen = startups.groupBy(*KEY).agg(F.min("ts").alias("ts"))
    return seen.withColumn("loghour", hour_of(F.col("ts")))


def unvisited(startups: DataFrame, visited: DataFrame) -> DataFrame:
    """Startups of devices not seen before on their day.

    The visited set grows with the number of devices, so no broadcast is asked
    for: it happens only below the session's size threshold, and otherwise
    adaptive execution splits a device that holds too many rows.
    """
    return startups.join(visited.select(*KEY), list(KEY), "left_anti")


def new_on_day(
    startups: DataFrame, visited: DataFrame, order: tuple[str, ...] = ("ts",)
) -> DataFrame:
    """Rows to append to the device table: first of their key and not yet visited.

    Reducing to one row per key first gives the same rows as filtering first, and
    the join then reuses the partitioning of the reduced rows.
    """
    return unvisited(first_per_device(startups, order), visited)


def visited_union(visited: DataFrame, startups: DataFrame) -> DataFrame:
    """The visited set with the devices of one more batch."""
    return visited.select(*KEY).union(startups.select(*KEY)).distinct()


def new_devices(startups: DataFrame) -> DataFrame:
    """Devices per day that were never seen on an earlier day."""
    first = startups.groupBy("mid").agg(F.min("ts").alias("ts"))
    days = first.select(day_of(F.col("ts")).alias("logdate"))
    return days.groupBy("logdate").agg(F.count(F.lit(1)).alias("new_devices"))
