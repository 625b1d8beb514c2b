"""Explicit schemas of every record the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# A startup record as it arrives. The collector's ts is read as text, so that a
# value of the wrong kind can be told from a missing one.
STARTUP_WIRE = T.StructType(_strings("type", "mid", "uid", "os", "appid", "area", "ch", "vs", "ts"))

# The daily-active-device table, in its column order.
DAU = T.StructType(
    _strings("mid", "uid", "appid", "area", "os", "ch", "type", "vs", "logdate", "loghour")
    + [T.StructField("ts", T.LongType())]
)
DAU_COLUMNS = DAU.fieldNames()

# The order fact table. The dashboard reads only the last three columns.
ORDER_INFO = T.StructType(
    _strings("id", "create_date", "create_hour")
    + [T.StructField("total_amount", T.DoubleType())]
)

# One database change record: a header and the row images after the change.
CHANGE_COLUMN = T.StructType(_strings("name", "value"))
CHANGE_ROW = T.StructType([T.StructField("afterColumns", T.ArrayType(CHANGE_COLUMN))])
CHANGE_ENVELOPE = T.StructType(
    _strings("entryType", "schemaName", "tableName", "eventType")
    + [T.StructField("rowDatas", T.ArrayType(CHANGE_ROW))]
)

# The same with its place in the change log and the images before the change, which deletes and changed keys need.
CHANGE_ROW_BOTH = T.StructType([T.StructField(name, T.ArrayType(CHANGE_COLUMN)) for name in ("beforeColumns", "afterColumns")])
CHANGE_LOG = T.StructType(
    _strings("entryType", "schemaName", "tableName", "eventType")
    + [T.StructField("position", T.LongType()), T.StructField("rowDatas", T.ArrayType(CHANGE_ROW_BOTH))]
)

# What an order message carries once it is flattened.
ORDER_MESSAGE = T.StructType(_strings("id", "total_amount", "create_time"))

# Lines that gave no row.
REJECTS = T.StructType(_strings("value", "reason"))
