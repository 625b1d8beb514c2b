"""The sale report: total, gender and age shares, and one page of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally import settings
from daytally.functions.shares import FROM_20_TO_30, OVER_30, UNDER_20, percent
from daytally.operators import sales

# Titles and labels of the report.
GENDER_TITLE = "性别占比"
GENDER_LABELS = {"M": "男", "F": "女"}
AGE_TITLE = "年龄段占比"
AGE_LABELS = {UNDER_20: "20岁以下", FROM_20_TO_30: "20岁到30岁", OVER_30: "30岁以上"}


def _stat(title: str, prefix: str, labels: dict[str, str]):
    options = F.array(
        *[
            F.struct(
                F.lit(label).alias("name"),
                F.coalesce(percent(F.col(prefix + key), F.col("total")), F.lit(0.0)).alias("value"),
            )
            for key, label in labels.items()
        ]
    )
    return F.struct(F.lit(title).alias("title"), options.alias("options"))


def sale_report(
    sale_lines: DataFrame,
    date: str,
    keyword: str,
    number: int,
    size: int,
    order: tuple[str, ...],
) -> DataFrame:
    """One row: ``total``, ``stat`` and ``detail``, the last two as JSON.

    The hits feed both the shares and the page, so they are written once to the
    shared checkpoint folder instead of running the joins behind them twice.
    """
    settings.ensure_checkpoint_dir(sale_lines.sparkSession)
    hits = sales.search(sale_lines, date, keyword).checkpoint()
    counts = sales.profile(hits)
    stat = F.array(
        _stat(GENDER_TITLE, "gender_", GENDER_LABELS), _stat(AGE_TITLE, "age_", AGE_LABELS)
    )
    shares = counts.select("total", F.to_json(stat).alias("stat"))
    fields = [F.col(name) for name in order]
    others = [F.col(name) for name in hits.columns if name not in order]
    line = F.struct(*fields, *others)
    shown = sales.page(hits, order, number, size).select(line.alias("line"))
    # Both parts are bounded by the report itself: one row and one page.
    parts = shares.withColumn("line", F.lit(None).cast(shown.schema["line"].dataType)).unionByName(
        shown, allowMissingColumns=True
    )
    return parts.agg(
        F.max("total").alias("total"),
        F.max("stat").alias("stat"),
        F.to_json(F.sort_array(F.collect_list("line"))).alias("detail"),
    )
