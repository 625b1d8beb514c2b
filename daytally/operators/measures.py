"""Daily totals, hourly values and the comparison of two days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions.calendar import day_before


def rows() -> Column:
    return F.count(F.lit(1))


def money(amount: Column) -> Column:
    """Sum of amounts in cents-exact decimals, so the order of adding cannot matter."""
    return F.sum(amount.cast("decimal(18,2)")).cast("double")


def device_total(devices: DataFrame, day: str) -> DataFrame:
    """Devices of a day; 0 when there are none."""
    return devices.where(F.col("logdate") == day).agg(rows().alias("ct"))


def device_hours(devices: DataFrame, day: str) -> DataFrame:
    """Devices per hour of a day; hours without any are absent."""
    return devices.where(F.col("logdate") == day).groupBy("loghour").agg(rows().alias("ct"))


def order_total(orders: DataFrame, day: str) -> DataFrame:
    """Order amount of a day; NULL when there are no orders."""
    found = orders.where(F.col("create_date") == day)
    return found.agg(money(F.col("total_amount")).alias("total_amount"))


def order_hours(orders: DataFrame, day: str) -> DataFrame:
    """Order amount per hour of a day."""
    found = orders.where(F.col("create_date") == day)
    return found.groupBy("create_hour").agg(money(F.col("total_amount")).alias("sum_order_amount"))


def _two_days(frame: DataFrame, day_column: str, day: str) -> tuple[DataFrame, Column, Column]:
    today, yesterday = F.lit(day), day_before(F.lit(day))
    stamp = F.col(day_column)
    return frame.where(stamp.isin(today, yesterday)), stamp == today, stamp == yesterday


def device_hour_compare(devices: DataFrame, day: str) -> DataFrame:
    """Devices per hour today and yesterday from one scan; NULL where a day has none."""
    found, is_today, is_yesterday = _two_days(devices, "logdate", day)
    return found.groupBy("loghour").agg(
        F.sum(F.when(is_today, 1)).alias("today"),
        F.sum(F.when(is_yesterday, 1)).alias("yesterday"),
    )


def order_hour_compare(orders: DataFrame, day: str) -> DataFrame:
    """Order amount per hour today and yesterday from one scan."""
    found, is_today, is_yesterday = _two_days(orders, "create_date", day)
    amount = F.col("total_amount")
    return found.groupBy("create_hour").agg(
        money(F.when(is_today, amount)).alias("today"),
        money(F.when(is_yesterday, amount)).alias("yesterday"),
    )
