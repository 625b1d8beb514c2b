"""Collected app log lines: stamp, route, and typed startup records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally import schemas
from daytally.functions import logs
from daytally.functions.calendar import day_of, hour_of


def route_lines(lines: DataFrame, clock: Column, keep_malformed: bool = True) -> DataFrame:
    """Client lines to (topic, value) records stamped with ``clock`` in epoch ms.

    Each line is parsed once. A malformed line keeps its text and goes to its own
    topic, or nowhere when ``keep_malformed`` is false.
    """
    parsed = logs.parse_objects(lines)
    record = F.col("record")
    if not keep_malformed:
        parsed = parsed.where(record.isNotNull())
    kind = logs.text_field(record, "type")
    topic = F.when(record.isNull(), logs.MALFORMED).otherwise(logs.topic_of(kind))
    others = [name for name in lines.columns if name != "value"]
    return logs.stamp(parsed, clock).select(*others, topic.alias("topic"), "value")


def malformed_lines(lines: DataFrame) -> DataFrame:
    return logs.malformed(lines)


# Why a startup line is no startup record.
MALFORMED, NO_DEVICE, BAD_TIME = "malformed", "no device", "bad time"
# How far ahead of the clock a record's time may be, in milliseconds.
AHEAD = 86_400_000


def checked_startups(
    lines: DataFrame, keep: tuple[str, ...] = (), clock: Column | None = None
) -> DataFrame:
    """Startup lines to ``keep``, ``value``, the columns of the device table, and ``reason``.

    ``reason`` is NULL for a record and otherwise says why there is none: the line is
    not one JSON object, its device is missing or empty, or its ``ts`` is missing, no
    whole number (quoted or not), before 1970 or more than AHEAD after ``clock`` (epoch
    ms, the time of the batch by default). So nothing is lost silently, and one absurd
    time can't move a watermark.
    """
    parsed = logs.parse_lines(lines.select(*keep, "value"), schemas.STARTUP_WIRE)
    now = F.unix_millis(F.current_timestamp()) if clock is None else clock
    ts = F.when(F.col("ts").rlike("^[0-9]{1,18}$"), F.col("ts").try_cast("bigint"))
    timely = F.coalesce(ts <= now + AHEAD, F.lit(False))
    reason = (
        F.when(~F.col("readable"), MALFORMED)
        .when(F.coalesce(F.length("mid"), F.lit(0)) == 0, NO_DEVICE)
        .when(~timely, BAD_TIME)
    )
    dated = parsed.withColumn("reason", reason).withColumn("ts", F.when(F.col("reason").isNull(), ts))
    dated = dated.withColumns({"logdate": day_of(F.col("ts")), "loghour": hour_of(F.col("ts"))})
    return dated.select(*keep, "value", *schemas.DAU_COLUMNS, "reason")


def startup_records(
    lines: DataFrame, keep: tuple[str, ...] = (), clock: Column | None = None
) -> DataFrame:
    """Startup lines to the columns of the device table, ``keep`` columns first."""
    good = checked_startups(lines, keep, clock).where("reason is null")
    return good.select(*keep, *schemas.DAU_COLUMNS)


def startup_rejects(
    lines: DataFrame, keep: tuple[str, ...] = (), clock: Column | None = None
) -> DataFrame:
    """The lines that give no startup record, with the reason."""
    bad = checked_startups(lines, keep, clock).where("reason is not null")
    return bad.select(*keep, "value", "reason")
