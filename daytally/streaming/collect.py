"""Client log lines: stamp with the arrival time, route to topics, keep a raw log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daytally.functions.calendar import day_of
from daytally.functions.logs import MALFORMED
from daytally.operators.ingest import route_lines
from daytally.sources.topics import append_log, write_topics


def arrival_clock(lines: DataFrame) -> Column:
    """When a line was received, in epoch milliseconds.

    That is the broker record's time where there is one, so that a backlog keeps its
    own days, and otherwise the time of the micro-batch.
    """
    if "timestamp" in lines.columns:
        return F.unix_millis("timestamp")
    return F.unix_millis(F.current_timestamp())


def collect_logs(
    lines: DataFrame, checkpoint: str, clock: Column | None = None, **sink
) -> StreamingQuery:
    """Stamp and route a stream of client lines into topics, malformed ones apart."""
    routed = route_lines(lines, arrival_clock(lines) if clock is None else clock)
    counted = routed.observe(
        "collected",
        F.count(F.lit(1)).alias("received"),
        F.count(F.when(F.col("topic") == MALFORMED, 1)).alias("malformed"),
    )
    return write_topics(counted, checkpoint, **sink)


def keep_raw_log(
    lines: DataFrame, checkpoint: str, path: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append stamped lines, as read back from the topics, to text files per day."""
    ts = F.get_json_object("value", "$.ts").try_cast("bigint")
    dated = lines.select("value", day_of(ts).alias("logdate"))
    return append_log(dated, checkpoint, path, trigger)
