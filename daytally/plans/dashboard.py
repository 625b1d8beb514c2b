"""Answers of the dashboard: key figures, hourly maps, one metric by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions.calendar import day_before
from daytally.operators import measures

# Ids and labels of the key figures, and the placeholder count
# that stands for new devices until they are measured.
DAU_ID, DAU_NAME = "dau", "新增日活"
NEW_MID_ID, NEW_MID_NAME = "new_mid", "新增设备"
ORDER_AMOUNT_ID, ORDER_AMOUNT_NAME = "order_amount", "新增交易额"
NEW_MID_PLACEHOLDER = 33333


def _figure(value: DataFrame, column: str, figure_id: str, name: str) -> DataFrame:
    return value.select(
        F.lit(figure_id).alias("id"), F.lit(name).alias("name"), F.col(column).alias("value")
    )


def key_figures(devices: DataFrame, day: str) -> DataFrame:
    """Active devices of the day and the placeholder for new ones."""
    total = measures.device_total(devices, day)
    placeholder = F.lit(NEW_MID_PLACEHOLDER).cast("bigint")
    figures = F.array(
        F.struct(F.lit(DAU_ID).alias("id"), F.lit(DAU_NAME).alias("name"), F.col("ct").alias("value")),
        F.struct(
            F.lit(NEW_MID_ID).alias("id"),
            F.lit(NEW_MID_NAME).alias("name"),
            placeholder.alias("value"),
        ),
    )
    return total.select(F.inline(figures))


def measured_figures(
    devices: DataFrame, new_per_day: DataFrame, orders: DataFrame, day: str
) -> DataFrame:
    """All three key figures, with new devices counted instead of assumed."""
    total = measures.device_total(devices, day).select(F.col("ct").cast("double").alias("v"))
    fresh = new_per_day.where(F.col("logdate") == day).agg(
        F.coalesce(F.sum("new_devices"), F.lit(0)).cast("double").alias("v")
    )
    amount = measures.order_total(orders, day).select(F.col("total_amount").alias("v"))
    return (
        _figure(total, "v", DAU_ID, DAU_NAME)
        .unionByName(_figure(fresh, "v", NEW_MID_ID, NEW_MID_NAME))
        .unionByName(_figure(amount, "v", ORDER_AMOUNT_ID, ORDER_AMOUNT_NAME))
    )


def figures_json(figures: DataFrame) -> DataFrame:
    """The key figures as one JSON list, ordered by id."""
    listed = F.sort_array(F.collect_list(F.struct("id", "name", "value")))
    return figures.agg(F.to_json(listed).alias("json"))


def hour_map(compared: DataFrame, hour_column: str) -> DataFrame:
    """Two-day comparison as ``{"today": {hour: value}, "yesterday": {…}}``.

    An hour without a value is not in its map. There are at most 24 rows to gather.
    """

    def by_hour(column: str) -> Column:
        pair = F.struct(F.col(hour_column).alias("h"), F.col(column).alias("v"))
        pairs = F.sort_array(F.collect_list(F.when(F.col(column).isNotNull(), pair)))
        return F.map_from_entries(pairs).alias(column)

    both = compared.agg(by_hour("today"), by_hour("yesterday"))
    return both.select(F.to_json(F.struct("today", "yesterday")).alias("json"))


def metric_hours(devices: DataFrame, orders: DataFrame) -> DataFrame:
    """Hourly values of every metric in one long (metric, date, hour, value) frame."""
    active = devices.groupBy(F.col("logdate").alias("date"), F.col("loghour").alias("hour")).agg(
        measures.rows().cast("double").alias("value")
    )
    sold = orders.groupBy(F.col("create_date").alias("date"), F.col("create_hour").alias("hour")).agg(
        measures.money(F.col("total_amount")).alias("value")
    )
    return active.select(F.lit(DAU_ID).alias("metric"), "date", "hour", "value").unionByName(
        sold.select(F.lit(ORDER_AMOUNT_ID).alias("metric"), "date", "hour", "value")
    )


def dispatch(metrics: DataFrame, metric: str, day: str) -> DataFrame:
    """Hours of one metric for a day and the day before; empty for an unknown metric.

    The metric is a constant in each branch, so the others are not even scanned.
    """
    dates = F.col("date").isin(F.lit(day), day_before(F.lit(day)))
    return metrics.where((F.col("metric") == metric) & dates)
