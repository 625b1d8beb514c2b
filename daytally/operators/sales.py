"""Search on sale details: filter, count, page, facets and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.functions.shares import BANDS, age_band, percent
from daytally.functions.text import has_all_words

# How many buckets the two facets return.
GENDER_BUCKETS = 2
AGE_BUCKETS = 100

GENDERS = ("M", "F")


def search(sales: DataFrame, date: str, keyword: str) -> DataFrame:
    """Sale lines of a date whose product name holds every word of the keyword."""
    return sales.where(
        (F.col("dt") == date) & has_all_words(F.col("sku_name"), F.lit(keyword))
    )


def hit_count(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("total"))


def page(hits: DataFrame, order: tuple[str, ...], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of the hits in the given order, which must be unique.

    Every task keeps only the rows up to the end of the page. To walk far into a
    result, continue with :func:`page_after` instead of high page numbers.
    """
    return hits.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(hits: DataFrame, order: tuple[str, ...], last: tuple, size: int) -> DataFrame:
    """The page that follows the row with key ``last``; its cost does not grow with depth."""
    key = F.struct(*order)
    given = F.struct(
        *[F.lit(value).cast(hits.schema[name].dataType).alias(name) for name, value in zip(order, last)]
    )
    return hits.where(key > given).orderBy(*order).limit(size)


def terms(hits: DataFrame, field: str, size: int) -> DataFrame:
    """The ``size`` most frequent values of a field with their counts."""
    counted = hits.where(F.col(field).isNotNull()).groupBy(field).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), field).limit(size)


def gender_terms(hits: DataFrame) -> DataFrame:
    return terms(hits, "user_gender", GENDER_BUCKETS)


def age_terms(hits: DataFrame) -> DataFrame:
    return terms(hits, "user_age", AGE_BUCKETS)


def profile(hits: DataFrame) -> DataFrame:
    """All counts of the share reports in one pass: one row, whatever the hits.

    The shares use every hit, also where there are more ages than facet buckets.
    """
    gender, band = F.col("user_gender"), age_band(F.col("user_age"))
    return hits.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(gender == g, 1)).alias(f"gender_{g}") for g in GENDERS],
        *[F.count(F.when(band == b, 1)).alias(f"age_{b}") for b in BANDS],
    )


def _shares(counts: DataFrame, name: str, prefix: str, values: tuple[str, ...]) -> DataFrame:
    options = [
        F.struct(
            F.lit(value).alias(name),
            F.col(prefix + value).alias("n"),
            percent(F.col(prefix + value), F.col("total")).alias("ratio"),
        )
        for value in values
    ]
    return counts.select(F.inline(F.array(*options)))


def gender_shares(hits: DataFrame) -> DataFrame:
    """Count and percent per gender; 0 for a gender without hits."""
    return _shares(profile(hits), "user_gender", "gender_", GENDERS)


def age_shares(hits: DataFrame) -> DataFrame:
    """Count and percent per age band."""
    return _shares(profile(hits), "age_band", "age_", BANDS)
