"""Percentages and age bands of the sale report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The age bands run below 20, from 20 to 30 inclusive, above 30.
UNDER_20 = "under_20"
FROM_20_TO_30 = "20_to_30"
OVER_30 = "over_30"
BANDS = (UNDER_20, FROM_20_TO_30, OVER_30)


def percent(part: Column, total: Column) -> Column:
    """Share in percent, rounded half up to one decimal; NULL when total is 0."""
    whole = F.nullif(total, F.lit(0).cast("bigint")).cast("double")
    return F.floor(part * F.lit(1000.0) / whole + F.lit(0.5)) / F.lit(10.0)


def age_band(age: Column) -> Column:
    """Band of an age given as number or text; NULL when it is neither."""
    years = age.try_cast("int")
    return (
        F.when(years < 20, UNDER_20)
        .when(years <= 30, FROM_20_TO_30)
        .when(years > 30, OVER_30)
    )
