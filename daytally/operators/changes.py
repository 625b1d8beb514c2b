"""Database change records to order messages and order rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally import schemas
from daytally.functions import logs
from daytally.functions.calendar import DAY
from daytally.functions.changes import row_image

# The entry type, table and operation whose rows become messages.
ROW_ENTRY = "ROWDATA"
ORDER_TABLE = "order_info"
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"

# Why a line is no change record, or a message no order row.
MALFORMED, NO_ID, BAD_TIME, BAD_AMOUNT, NO_PLACE = "malformed", "no id", "bad time", "bad amount", "no position"


def envelopes(lines: DataFrame) -> DataFrame:
    """JSON change records to their columns; malformed lines give no row."""
    return logs.parse_records(lines, schemas.CHANGE_ENVELOPE)


def change_rejects(lines: DataFrame) -> DataFrame:
    """Change lines that are not one JSON object each, with the reason."""
    bad = logs.parse_lines(lines.select("value"), schemas.CHANGE_ENVELOPE).where("not readable")
    return bad.select("value", F.lit(MALFORMED).alias("reason"))


def possible_inserts(lines: DataFrame) -> DataFrame:
    """Leave out lines that cannot be an order insert, without parsing them.

    A wanted record names its entry type, table and operation as plain text unless
    something in it is escaped, so no wanted line is lost.
    """
    value = F.col("value")
    named = value.contains(ROW_ENTRY) & value.contains(ORDER_TABLE) & value.contains(INSERT)
    return lines.where(named | value.contains("\\"))


def inserted_rows(changes: DataFrame, subscription: str = ".*") -> DataFrame:
    """Row images of inserted orders, one map per row.

    ``subscription`` is a pattern that must match ``schema.table`` as a whole.
    Updates, deletes and other tables are dropped before rows are unpacked.
    """
    full_name = F.concat_ws(".", "schemaName", "tableName")
    wanted = changes.where(
        (F.col("entryType") == ROW_ENTRY)
        & (F.col("tableName") == ORDER_TABLE)
        & (F.col("eventType") == INSERT)
        & full_name.rlike(f"^(?:{subscription})$")
    )
    rows = wanted.select(F.explode("rowDatas").alias("row"))
    return rows.select(row_image(F.col("row.afterColumns")).alias("image"))


def order_messages(changes: DataFrame, subscription: str = ".*") -> DataFrame:
    """Inserted orders as (topic, value) records ready for the order topic."""
    rows = inserted_rows(changes, subscription)
    return rows.select(F.lit(logs.ORDER).alias("topic"), F.to_json("image").alias("value"))


def order_messages_of_lines(lines: DataFrame, subscription: str = ".*") -> DataFrame:
    """Change lines straight to order messages; most other changes are never parsed."""
    return order_messages(envelopes(possible_inserts(lines)), subscription)


def checked_orders(messages: DataFrame) -> DataFrame:
    """Order messages to ``value``, the columns of the order table, and ``reason``.

    ``reason`` is NULL for a row and otherwise says why there is none: the message is
    not one JSON object, has no id, no readable day and hour, or no readable amount.
    """
    parsed = logs.parse_lines(messages.select("value"), schemas.ORDER_MESSAGE)
    columns, fault = _order_columns()
    reason = F.when(~F.col("readable"), MALFORMED).otherwise(fault)
    return parsed.select("value", *columns, reason.alias("reason"))


def _order_columns() -> tuple[list, Column]:
    """The columns of the order table from id, create_time and total_amount as text, and why they make no row."""
    day, hour = F.substring("create_time", 1, 10), F.substring("create_time", 12, 2)
    amount = F.col("total_amount").try_cast("double")
    timed = F.try_to_date(day, DAY).isNotNull() & hour.rlike("^([01][0-9]|2[0-3])$")
    finite = amount.isNotNull() & ~F.isnan(amount) & (F.abs(amount) < float("inf"))
    fault = (
        F.when(F.coalesce(F.length("id"), F.lit(0)) == 0, NO_ID)
        .when(~F.coalesce(timed, F.lit(False)), BAD_TIME)
        .when(~F.coalesce(finite, F.lit(False)), BAD_AMOUNT)
    )
    return [F.col("id"), day.alias("create_date"), hour.alias("create_hour"), amount.alias("total_amount")], fault


def order_rows(messages: DataFrame) -> DataFrame:
    """Order messages to rows of the order table.

    Only inserts become messages, so a later change of an order is not seen here.
    """
    return checked_orders(messages).where("reason is null").drop("value", "reason")


def order_rejects(messages: DataFrame) -> DataFrame:
    """The messages that give no order row, with the reason."""
    return checked_orders(messages).where("reason is not null").select("value", "reason")


def single_orders(orders: DataFrame) -> DataFrame:
    """One row per order id, since change logs and topics deliver at least once.

    Copies of a message are equal; of different rows with one id the least stays,
    whole. Spark keeps one candidate per id in every input task before it shuffles.
    """
    order = Window.partitionBy("id").orderBy("create_date", "create_hour", "total_amount")
    return orders.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def checked_changes(lines: DataFrame, subscription: str = ".*") -> DataFrame:
    """Change lines to ``value``, the columns of the order table, ``at``, ``deleted`` and ``reason``.

    Inserts and updates give the row as it is afterwards, deletes its id alone, and an update that changes the
    id a delete of the old one as well. ``at`` is the record's position in the change log and the row's place in
    the record. ``reason`` says why there is no change: the line is not one JSON object, has no position, or a
    row in it has no id, day and hour, or amount. Records of other tables give nothing.
    """
    parsed = logs.parse_lines(lines.select("value"), schemas.CHANGE_LOG)
    full_name = F.concat_ws(".", "schemaName", "tableName")
    wanted = (
        (F.col("entryType") == ROW_ENTRY)
        & (F.col("tableName") == ORDER_TABLE)
        & F.col("eventType").isin(INSERT, UPDATE, DELETE)
        & full_name.rlike(f"^(?:{subscription})$")
    )
    broken = ~F.col("readable")
    found = parsed.where(broken | F.coalesce(wanted, F.lit(False)))
    none = F.struct(F.lit(None).cast("array<struct<name:string,value:string>>").alias("beforeColumns"),
                    F.lit(None).cast("array<struct<name:string,value:string>>").alias("afterColumns"))
    # A line without rows that can be read is one row here, so that it can be reported.
    images = F.when(broken | F.col("position").isNull(), F.array(none)).otherwise(F.col("rowDatas"))
    rows = found.select("value", "readable", "position", "eventType", F.posexplode(images).alias("place", "row"))
    before, after = row_image(F.col("row.beforeColumns")), row_image(F.col("row.afterColumns"))
    rows = rows.select("value", "readable", "position", "eventType", "place", before.alias("before"), after.alias("after"))
    old, new = F.try_element_at("before", F.lit("id")), F.try_element_at("after", F.lit("id"))
    change = lambda image, deleted: F.struct(F.col(image).alias("image"), F.lit(deleted).alias("deleted"))
    several = (
        F.when(F.col("eventType") == DELETE, F.array(change("before", True)))
        .when((F.col("eventType") == UPDATE) & (old != new), F.array(change("before", True), change("after", False)))
        .otherwise(F.array(change("after", False)))
    )
    each = rows.select("value", "readable", "position", "place", F.explode(several).alias("change"))
    image = lambda name: F.try_element_at("change.image", F.lit(name)).alias(name)
    flat = each.select(
        "value", "readable", F.struct("position", "place").alias("at"), "change.deleted",
        image("id"), image("create_time"), image("total_amount"),
    )
    columns, fault = _order_columns()
    no_id = F.coalesce(F.length("id"), F.lit(0)) == 0
    reason = (
        F.when(~F.col("readable"), MALFORMED)
        .when(F.col("at.position").isNull(), NO_PLACE)
        .otherwise(F.when(F.col("deleted"), F.when(no_id, NO_ID)).otherwise(fault))
    )
    return flat.select("value", *columns, "at", "deleted", reason.alias("reason"))


def order_changes(lines: DataFrame, subscription: str = ".*") -> DataFrame:
    """The changes of the order table that the lines hold, in whatever order."""
    return checked_changes(lines, subscription).where("reason is null").drop("value", "reason")
