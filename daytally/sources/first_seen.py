"""Which device was first seen on which day: a table that grows by a day at a time.

The table (mid, logdate) is partitioned by the first day, so the new devices of a day are one partition's
rows, and bucketed by device, so that a day's devices meet all earlier ones bucket by bucket: only the day
is shuffled, whatever the history holds. Adding a day again replaces its partition. A day may also come
late; the devices that it takes from later days then leave those.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally import settings
from daytally.sources import files

#: Buckets of a new table; fixed for its life.
BUCKETS = 64


class FirstSeen:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, files.full(spark, path.rstrip("/")), buckets
        self.name = f"first_seen_{hashlib.md5(self.path.encode()).hexdigest()}"

    def table(self) -> DataFrame:
        """The whole table; the session's catalog learns of it, and of new partitions, here."""
        self.spark.sql(
            f"create table if not exists {self.name} (mid string, logdate string) using parquet "
            f"partitioned by (logdate) clustered by (mid) into {self.buckets} buckets location '{self.path}'"
        )
        files.folder(self.spark, self.path)
        self.spark.sql(f"msck repair table {self.name}")
        return self.spark.table(self.name)

    def day(self, logdate: str) -> DataFrame:
        """Devices first seen on a day: one partition."""
        return self.table().where(F.col("logdate") == logdate)

    def _put(self, rows: DataFrame) -> None:
        """Replace the days that ``rows`` has; every bucket of a day is one file."""
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows.select("mid", "logdate").write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)

    def load(self, startups: DataFrame) -> None:
        """Fill the table from a whole history: one aggregation."""
        self.table()
        firsts = startups.groupBy("mid").agg(F.min("logdate").alias("logdate"))
        self._put(firsts.repartition(self.buckets, "mid"))

    def fresh(self, startups: DataFrame, logdate: str) -> DataFrame:
        """Devices of the day that no earlier day has; the history is read in buckets and not shuffled."""
        today = startups.where(F.col("logdate") == logdate).select("mid").distinct()
        earlier = self.table().where(F.col("logdate") < logdate).select("mid")
        return today.repartition(self.buckets, "mid").join(earlier, "mid", "left_anti")

    def add_day(self, startups: DataFrame, logdate: str) -> None:
        """Put in, or put in again, the devices of one day."""
        # Written apart first: a table can't be replaced by what is read from it.
        staged = settings.new_run_dir(self.spark, "first-seen")
        self.fresh(startups, logdate).withColumn("logdate", F.lit(logdate)).write.parquet(f"{staged}/day")
        fresh = self.spark.read.schema("mid string, logdate string").parquet(f"{staged}/day")
        later = self.table().where(F.col("logdate") > logdate)
        taken = later.join(fresh.select("mid"), "mid", "left_semi").select("logdate").distinct()
        # Days, not devices, come to the driver.
        days = [row["logdate"] for row in taken.collect()]
        if days:
            left = later.where(F.col("logdate").isin(days)).join(fresh.select("mid"), "mid", "left_anti")
            left.write.parquet(f"{staged}/later")
            self._put(self.spark.read.schema("mid string, logdate string").parquet(f"{staged}/later").repartition(self.buckets, "mid"))
            kept = self.spark.read.schema("mid string, logdate string").parquet(f"{staged}/later").select("logdate").distinct()
            emptied = set(days) - {row["logdate"] for row in kept.collect()}
            for day in sorted(emptied):
                self._drop(day)
        if fresh.isEmpty():
            self._drop(logdate)
        else:
            self._put(fresh.repartition(self.buckets, "mid"))
        files.remove(self.spark, staged)

    def _drop(self, logdate: str) -> None:
        self.spark.sql(f"alter table {self.name} drop if exists partition (logdate = '{logdate}')")
        files.remove(self.spark, f"{self.path}/logdate={logdate}")


def new_devices(first_seen: FirstSeen, logdate: str) -> DataFrame:
    """One row: the day and its new devices, 0 if there are none."""
    counted = first_seen.day(logdate).agg(F.count(F.lit(1)).alias("new_devices"))
    return counted.select(F.lit(logdate).alias("logdate"), "new_devices")
