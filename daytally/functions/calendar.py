"""Days and hours of a record, cut in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of a day and of an hour.
DAY = "yyyy-MM-dd"
HOUR = "HH"


def instant(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def day_of(ms: Column) -> Column:
    """Epoch milliseconds to a ``yyyy-MM-dd`` string."""
    return F.date_format(instant(ms), DAY)


def hour_of(ms: Column) -> Column:
    """Epoch milliseconds to a zero-padded ``HH`` string."""
    return F.date_format(instant(ms), HOUR)


def day_before(day: Column) -> Column:
    """The previous day as a string, NULL when ``day`` is not a real date."""
    return F.date_format(F.date_sub(F.try_to_date(day, DAY), 1), DAY)
