"""The job inputs as views over the supplied tables (see FIXTURES.md).

Day bounds are put on the raw timestamp columns, so that they reach the Parquet
scan; a filter on the derived day text would not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.calendar import DAY, HOUR
from daytally.schemas import DAU_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _midnight(day: dt.date) -> Column:
    return F.expr(f"timestamp_ntz'{day.isoformat()} 00:00:00'")


def in_days(moment: Column, first: str | None, last: str | None) -> Column:
    """Range condition for ``first`` to ``last`` inclusive, either of them open."""
    condition = F.lit(True)
    if first:
        condition = condition & (moment >= _midnight(dt.date.fromisoformat(first)))
    if last:
        after = dt.date.fromisoformat(last) + dt.timedelta(days=1)
        condition = condition & (moment < _midnight(after))
    return condition


def day_earlier(day: str) -> str:
    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()


def app_log_of(events: DataFrame) -> DataFrame:
    """App log columns of the events table; views stand for startups."""
    user, kind, ts = F.col("user_id"), F.col("event_type"), F.col("ts")
    on_ios = user % 10 < 3
    return events.select(
        "event_id",
        F.when(kind == "view", "startup").otherwise("event").alias("type"),
        F.concat(F.lit("mid_"), user).alias("mid"),
        F.concat(F.lit("uid_"), user).alias("uid"),
        F.when(on_ios, "ios").otherwise("android").alias("os"),
        F.lit("app1").alias("appid"),
        F.concat(F.lit("area_"), user % 10).alias("area"),
        F.when(on_ios, "appstore").otherwise(F.concat(F.lit("ch_"), user % 7)).alias("ch"),
        F.concat(F.lit("v"), user % 4).alias("vs"),
        kind.alias("evid"),
        F.get_json_object("props", "$.k").cast("int").alias("itemid"),
        F.unix_millis(ts.cast("timestamp")).alias("ts"),
        F.date_format(ts, DAY).alias("logdate"),
        F.date_format(ts, HOUR).alias("loghour"),
    )


def startup_log_of(events: DataFrame) -> DataFrame:
    """The startups alone; the raw column is filtered, which Parquet can do."""
    startups = app_log_of(events.where(F.col("event_type") == "view"))
    return startups.select(*DAU_COLUMNS, "event_id")


def app_log(
    spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return app_log_of(events.where(in_days(F.col("ts"), first, last)))


def startup_log(
    spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    events = table(spark, sf_dir, "events").where(in_days(F.col("ts"), first, last))
    return startup_log_of(events)


def startup_line() -> Column:
    """The wire text of a startup record."""
    return F.to_json(F.struct("type", "mid", "uid", "os", "appid", "area", "ch", "vs", "ts"))


def client_line() -> Column:
    """The wire text a client sends: no ``ts``, fields according to the record type."""
    startup = F.struct("type", "mid", "uid", "os", "appid", "area", "ch", "vs")
    event = F.struct("type", "mid", "uid", "os", "appid", "area", "evid", "itemid")
    return F.when(F.col("type") == "startup", F.to_json(startup)).otherwise(F.to_json(event))


def order_info(
    spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    ts = F.col("ts")
    return (
        table(spark, sf_dir, "events")
        .where((F.col("event_type") == "purchase") & in_days(ts, first, last))
        .select(
            F.col("event_id").alias("id"),
            F.col("value").alias("total_amount"),
            F.date_format(ts, DAY).alias("create_date"),
            F.date_format(ts, HOUR).alias("create_hour"),
        )
    )


def change_lines_of(events: DataFrame) -> DataFrame:
    """Database change records as JSON text, one row image per record."""
    key, ts = F.col("event_id"), F.col("ts")
    flat = events.where(F.col("event_type") == "purchase").select(
        key.cast("string").alias("id"),
        F.when(key % 10 == 0, "TRANSACTIONBEGIN").otherwise("ROWDATA").alias("entryType"),
        F.when(key % 7 == 0, "other").otherwise("shop").alias("schemaName"),
        F.when(key % 5 == 1, "user_info").otherwise("order_info").alias("tableName"),
        F.when(key % 4 == 0, "UPDATE")
        .when(key % 4 == 1, "DELETE")
        .otherwise("INSERT")
        .alias("eventType"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("total_amount"),
        F.concat_ws(" ", F.date_format(ts, DAY), F.date_format(ts, HOUR)).alias("create_time"),
    )
    image = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(name).alias("value"))
            for name in ("id", "total_amount", "create_time")
        ]
    )
    rows = F.array(F.struct(image.alias("afterColumns"))).alias("rowDatas")
    envelope = F.struct("entryType", "schemaName", "tableName", "eventType", rows)
    # Unpacked from an array, so that a filter on the text does not build it again.
    return flat.select(F.explode(F.array(F.to_json(envelope))).alias("value"))


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_lines_of(table(spark, sf_dir, "events"))


def order_log_of(events: DataFrame) -> DataFrame:
    """event_id, step and value: the change log of orders that are inserted, updated, deleted, inserted again or renamed.

    Some lines are spoiled on purpose: without a position (step 7), cut off (8), or with an amount that is none (6).
    """
    key, ts = F.col("event_id"), F.col("ts")
    steps = F.filter(
        F.array(
            F.lit(1), F.when(key % 3 == 0, 2), F.when(key % 5 == 0, 3), F.when(key % 30 == 0, 4),
            F.when((key % 7 == 0) & (key % 5 != 0), 5), F.when(key % 17 == 0, 6), F.when(key % 11 == 0, 7), F.when(key % 13 == 0, 8),
        ),
        lambda step: step.isNotNull(),
    )
    flat = events.where(F.col("event_type") == "purchase").select("event_id", "value", "ts", F.explode(steps).alias("step"))
    step, id_ = F.col("step"), key.cast("string")
    more = F.when(step == 4, 2).when((step == 2) | ((step == 5) & (key % 3 == 0)), 1).otherwise(0)
    amount = F.when(step == 6, "much").otherwise((F.col("value").cast("decimal(18,2)") + more).cast("string"))
    time = F.concat_ws(" ", F.date_format(ts, DAY), F.date_format(ts, HOUR))

    def image(own: Column) -> Column:
        pairs = (("id", own), ("total_amount", amount), ("create_time", time))
        return F.array(*[F.struct(F.lit(name).alias("name"), value.alias("value")) for name, value in pairs])

    before = F.when(step.isin(2, 3, 5, 6), image(id_))
    after = F.when(step != 3, image(F.when(step == 5, F.concat(F.lit("x"), id_)).otherwise(id_)))
    envelope = F.struct(
        F.lit("ROWDATA").alias("entryType"),
        F.lit("shop").alias("schemaName"),
        F.lit("order_info").alias("tableName"),
        F.when(step == 3, "DELETE").when(step.isin(2, 5, 6), "UPDATE").otherwise("INSERT").alias("eventType"),
        F.when(step != 7, key * 10 + step).alias("position"),
        F.array(F.struct(before.alias("beforeColumns"), after.alias("afterColumns"))).alias("rowDatas"),
    )
    line = F.to_json(envelope)
    return flat.select("event_id", "step", F.when(step == 8, F.substring(line, 1, 40)).otherwise(line).alias("value"))


SALE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def sale_detail(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    """Order lines with product name, buyer's gender and age; ``dt`` is the order month.

    The order lines meet the parts and the orders of the month first, which leave
    few of them for the join with the buyers. No join is hinted: sizes decide
    between broadcast and shuffle, and adaptive execution splits keys that hold too
    many rows.
    """
    orders = table(spark, sf_dir, "orders")
    if month:
        first = dt.date.fromisoformat(month)
        following = (first.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        last = (following - dt.timedelta(days=1)).isoformat()
        orders = orders.where(in_days(F.col("o_orderdate"), month, last))
    bought = orders.select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-01").alias("dt")
    )
    lines = table(spark, sf_dir, "lineitem")
    named = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    ordered = named.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    buyer = F.col("c_custkey")
    return ordered.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == buyer).select(
        *SALE_KEY,
        "dt",
        F.col("p_name").alias("sku_name"),
        F.when(buyer % 2 == 0, "F").otherwise("M").alias("user_gender"),
        (12 + buyer % 45).cast("int").alias("user_age"),
    )
