"""First startups per device and day with state for a stated number of days, losing nothing.

The state keeps, for every device and day, the time of the earliest startup seen. It is dealt into SLICES
slices of each day, by a hash of the device: one step of the state takes all startups of a slice together,
since a step costs Python a thousand times what a row costs. The first startup of a
key goes out at once, and again an earlier one if it comes later, so that the earliest of what went out is
the earliest of all: ``devices.first_per_device`` over the sink gives the batch answer. A timer ends a slice
once a startup ``keep_days`` younger than the end of its day has been seen. Startups that come after that
go out marked as late, one per device, day and batch.

Spark drops rows that are behind the watermark, so the rows themselves carry no watermark time; a row of
its own for each Arrow batch, the tick, carries the newest time and moves it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daytally import schemas
from daytally.operators.devices import KEY
from daytally.operators.ingest import checked_startups
from daytally.sources.snapshots import DayTable
from daytally.sources.topics import write_batches

DAY_MS = 86_400_000
#: The device of ticks; startups without a device are rejected before.
TICK = ""
#: Slices of a day's state; fixed for the life of a checkpoint. A batch rewrites the slices that it touches.
SLICES = 32
MARKED = T.StructType([*schemas.DAU.fields, T.StructField("late", T.BooleanType())])


def earliest_and_tick(startups: DataFrame) -> DataFrame:
    """The earliest row of each key in every Arrow batch, and one tick with the batch's newest time."""
    key = list(KEY)
    columns = schemas.DAU_COLUMNS

    # Defined here so that it travels to the workers by value.
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moment = pa.timestamp("us", "UTC")
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).sort_by([(name, "ascending") for name in ("ts", *(c for c in columns if c != "ts"))])
            places = table.select(key).append_column("row", pa.array(range(table.num_rows)))
            first = places.group_by(key, use_threads=False).aggregate([("row", "min")])["row_min"]
            rows = table.take(first).append_column("clock", pa.nulls(len(first), moment))
            yield from rows.combine_chunks().to_batches()
            newest = table["ts"][-1].as_py()
            tick = {name: pa.nulls(1, batch.schema.field(name).type) for name in columns}
            tick |= {"mid": pa.array([TICK]), "logdate": table["logdate"].slice(table.num_rows - 1).combine_chunks(), "clock": pa.array([newest * 1000], moment)}
            yield pa.RecordBatch.from_arrays([tick[n] for n in (*columns, "clock")], names=[*columns, "clock"])

    schema = T.StructType([*schemas.DAU.fields, T.StructField("clock", T.TimestampType())])
    return startups.select(columns).mapInArrow(thin, schema)


def packed(devices: pd.DataFrame) -> bytes:
    """mid and ts of a slice's devices as they lie in the state."""
    sink = pa.BufferOutputStream()
    table = pa.table({"mid": pa.array(devices["mid"], pa.string()), "ts": pa.array(devices["ts"], pa.int64())})
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(pa.py_buffer(bytes(data))) as reader:
        return reader.read_all().to_pandas()


def closes(logdate: str, keep_days: int) -> int:
    midnight = dt.datetime.fromisoformat(logdate).replace(tzinfo=dt.timezone.utc)
    return int(midnight.timestamp() * 1000) + DAY_MS + keep_days * DAY_MS


def earliest_of_slice(keep_days: int):
    order = ["mid", "ts", *[c for c in schemas.DAU_COLUMNS if c not in ("mid", "ts")]]

    def step(key: tuple[str, int], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for frame in frames:
            frame = frame.loc[frame["mid"] != TICK, schemas.DAU_COLUMNS]
            frame = frame if best is None else pd.concat([best, frame])
            best = frame.sort_values(order).drop_duplicates("mid")
        end = closes(key[0], keep_days)
        late = state.getCurrentWatermarkMs() >= end
        if not late and state.exists:
            known = unpacked(state.get[0])
            before = best["mid"].map(pd.Series(known["ts"].to_numpy(), known["mid"]))
            # A missing time compares as false.
            best = best[~(before <= best["ts"])]
        if not late and (state.exists or len(best)):
            if len(best):
                devices = best[["mid", "ts"]]
                if state.exists:
                    devices = pd.concat([known[~known["mid"].isin(best["mid"])], devices])
                state.update((packed(devices),))
            state.setTimeoutTimestamp(end)  # holds for one call
        if len(best):
            yield best.assign(late=late)

    return step


def earliest_devices(startups: DataFrame, keep_days: int, slices: int = SLICES) -> DataFrame:
    """Startups that are the earliest of their key so far, and late ones, marked by ``late``."""
    thin = earliest_and_tick(startups).withColumn("slice", F.pmod(F.xxhash64("mid"), F.lit(slices)).cast("int"))
    dealt = thin.withWatermark("clock", "0 seconds").groupBy("logdate", "slice")
    return dealt.applyInPandasWithState(earliest_of_slice(keep_days), MARKED, "devices binary", "update", GroupStateTimeout.EventTimeTimeout)


def bounded_device_stream(
    lines: DataFrame, checkpoint: str, path: str, late_path: str, keep_days: int, trigger: dict | None = None
) -> StreamingQuery:
    """Startup lines to a day table, and what came after its day had left the state to a second one.

    Every batch reaches each table once, also if it is delivered again after a failure between them.
    """
    spark = lines.sparkSession
    checked = checked_startups(lines).observe("startups", F.count(F.lit(1)).alias("received"), F.count("reason").alias("rejected"))
    marked = earliest_devices(checked.where("reason is null"), keep_days)
    on_time, late = (DayTable(spark, place, schemas.DAU, "logdate") for place in (path, late_path))

    def keep(table: DayTable, condition: str):
        return lambda batch, number: table.append(batch.where(condition), "devices", number)

    return write_batches(marked, checkpoint, keep(on_time, "not late"), keep(late, "late"), trigger=trigger, mode="update")
