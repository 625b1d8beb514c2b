"""A record log: topics of text records in partitions, each record with an offset and a time.

It stands where no broker is: producers append batches, streams read by offset. A topic is a folder with
the records as Parquet (``data``) and one small list per batch (``batches``) that names its files with the
offsets and times they hold. A batch is there once its list is; the list's name is the batch's, so that
appending the same batch again changes nothing. Records of a partition have offsets without gaps, in the
order of their times within a batch.

The stream source keeps an offset for every partition in the query's checkpoint. It starts at the newest
records, at the oldest, at given offsets or at a time; a batch that failed is read again from exactly the
same offsets to the same offsets, also in the middle of a file. ``maxRecordsPerBatch`` bounds a batch (for
triggers that go on; ``availableNow`` takes what it is given at its start as one batch, so leave it out there).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from daytally.sources import files

FORMAT = "recordlog"
SCHEMA = "value string, partition int, offset bigint, timestamp timestamp"
#: Records of one file, which is the least that a task of the stream reads a part of.
FILE_RECORDS = 1_000_000


def _segments(spark: SparkSession, root: str) -> list[dict]:
    return [segment for path in files.listed(spark, f"{root}/batches", ".json") for segment in json.loads(files.text_of(spark, path))]


def append_records(
    lines: DataFrame,
    path: str,
    topic: str,
    batch: str,
    partitions: int,
    timestamp: Column | None = None,
    key: Column | None = None,
) -> bool:
    """Append the ``value`` texts as one batch; False if a batch of that name is there already.

    Records of one ``key`` go to one partition, in time order; without a key they are spread. Each
    partition is written by one task, as a broker's partition has one leader, so a topic needs partitions
    in proportion to its records. ``timestamp`` is by default the time of the call. One producer at a time.
    """
    spark, root = lines.sparkSession, f"{path.rstrip('/')}/{topic}"
    if files.exists(spark, f"{root}/batches/{batch}.json"):
        return False
    following: dict[int, int] = {}
    for segment in _segments(spark, root):
        following[segment["partition"]] = max(following.get(segment["partition"], 0), segment["last"] + 1)
    # A failed attempt of this batch may have left files.
    folder = f"{root}/data/{batch}"
    moment = F.current_timestamp() if timestamp is None else timestamp
    place = F.pmod(F.xxhash64(F.col("value") if key is None else key), F.lit(partitions)).cast("int")
    placed = lines.select("value", moment.alias("timestamp"), place.alias("partition"))
    order = Window.partitionBy("partition").orderBy("timestamp", "value")
    starts = F.array(*[F.lit(following.get(p, 0)).cast("bigint") for p in range(partitions)])
    offset = F.get(starts, F.col("partition")) + F.row_number().over(order) - 1
    rows = placed.withColumn("offset", offset).select("value", "offset", "timestamp", "partition")
    rows.write.mode("overwrite").partitionBy("partition").option("maxRecordsPerFile", FILE_RECORDS).parquet(folder)
    # One row per file comes to the driver.
    written = spark.read.schema("offset bigint, timestamp timestamp, partition int").parquet(folder)
    ms = F.unix_millis("timestamp")
    found = written.groupBy(F.input_file_name().alias("file"), "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.min(ms).alias("since"), F.max(ms).alias("until")
    )
    segments = [row.asDict() for row in found.orderBy("partition", "first").collect()]
    files.put_text(spark, f"{root}/batches/{batch}.json", json.dumps(segments))
    return True


@dataclass
class Span(InputPartition):
    """Records of one file, from an offset to before another."""

    file: str
    partition: int
    first: int
    end: int


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class RecordReader(DataSourceStreamReader):
    """Plans batches by offsets; offsets are those of the next record to read, by partition."""

    def __init__(self, options: dict):
        self.root = f"{options['path'].rstrip('/')}/{options['topic']}"
        self.starting = options.get("startingOffsets", "latest")
        self.since = options.get("startingTimestamp")
        self.most = int(options.get("maxRecordsPerBatch", 0))
        self.known: dict[str, list[dict]] = {}
        self.reached: dict[str, int] | None = None

    def segments(self) -> list[dict]:
        system, root = _file_system(self.root)
        for entry in system.get_file_info(pafs.FileSelector(f"{root}/batches", allow_not_found=True)):
            # Names that begin with a dot are not finished.
            if entry.base_name.endswith(".json") and not entry.base_name.startswith(".") and entry.path not in self.known:
                with system.open_input_stream(entry.path) as stream:
                    self.known[entry.path] = json.loads(stream.read())
        return [segment for found in self.known.values() for segment in found]

    def ends(self) -> dict[str, int]:
        found: dict[str, int] = {}
        for segment in self.segments():
            name = str(segment["partition"])
            found[name] = max(found.get(name, 0), segment["last"] + 1)
        return found

    def first_at(self, since: int) -> dict[str, int]:
        """Offsets of the first records of that time (epoch ms) or later; the end where there is none."""
        found = self.ends()
        for segment in self.segments():
            if segment["until"] >= since:
                offset = segment["first"]
                if segment["since"] < since:
                    system, path = _file_system(segment["file"])
                    times = ds.dataset(path, filesystem=system).to_table(["offset", "timestamp"])
                    late = [o for o, t in zip(times["offset"].to_pylist(), times["timestamp"].cast(pa.timestamp("ms", "UTC")).cast("int64").to_pylist(), strict=True) if t >= since]
                    offset = min(late)
                name = str(segment["partition"])
                found[name] = min(found[name], offset)
        return found

    def initialOffset(self) -> dict:
        if self.since is not None:
            start = self.first_at(int(self.since))
        elif self.starting == "latest":
            start = self.ends()
        elif self.starting == "earliest":
            start = {name: 0 for name in self.ends()}
        else:
            start = {name: 0 for name in self.ends()} | json.loads(self.starting)
        self.reached = start
        return start

    def latestOffset(self) -> dict:
        ends = self.ends()
        if not self.most:
            return ends
        if self.reached is None:
            # Asked before anything else, so the query is new.
            self.initialOffset()
        # Every partition that has records left gets an equal share of the batch.
        waiting = [name for name, end in ends.items() if end > self.reached.get(name, 0)]
        share = max(1, self.most // max(1, len(waiting)))
        return {name: min(end, self.reached.get(name, 0) + share) for name, end in ends.items()}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        # Spark also calls this with an empty range when it restarts, which tells where it stands.
        self.reached = end
        spans = []
        for segment in self.segments():
            name = str(segment["partition"])
            first = max(segment["first"], start.get(name, 0))
            last = min(segment["last"] + 1, end.get(name, 0))
            if first < last:
                spans.append(Span(segment["file"], segment["partition"], first, last))
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(partition.file)
        within = (ds.field("offset") >= partition.first) & (ds.field("offset") < partition.end)
        for batch in ds.dataset(path, filesystem=system).to_batches(["value", "offset", "timestamp"], filter=within):
            if batch.num_rows:
                place = pa.array([partition.partition] * batch.num_rows, pa.int32())
                moment = batch["timestamp"].cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([batch["value"], place, batch["offset"], moment], ["value", "partition", "offset", "timestamp"])


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> RecordReader:
        return RecordReader(self.options)


def stream_records(spark: SparkSession, path: str, topic: str, **options: str) -> DataFrame:
    """A streaming frame of a topic: value, partition, offset, timestamp."""
    # Spark looks a source up in the session that is active in this thread, which may be another one.
    getattr(spark._jvm, "org.apache.spark.sql.classic.SparkSession").setActiveSession(spark._jsparkSession)
    try:
        spark.dataSource.register(RecordLog)
    except AnalysisException as known:
        if known.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
    return spark.readStream.format(FORMAT).options(path=path, topic=topic, **options).load()
