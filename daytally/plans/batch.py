"""The daily-device step run in batch, with its row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from daytally.operators.devices import KEY, unvisited


def counted_step(
    startups: DataFrame, visited: DataFrame, order: tuple[str, ...] = ("ts",)
) -> tuple[DataFrame, tuple[Observation, Observation]]:
    """The step's rows plus its counts: received, not yet visited, kept.

    Rows are reduced to the first of their key and a count of them before anything
    is shuffled or joined, so the count of unvisited rows needs no join of the raw
    rows. The figures are collected while the rows flow by; read them once an
    action on the frame has finished.
    """
    record, rank = F.struct(*startups.columns), F.struct(*order)
    firsts = startups.groupBy(*KEY).agg(
        F.min_by(record, rank).alias("record"), F.count(F.lit(1)).alias("n")
    )
    before, after = Observation("before"), Observation("after")
    n = F.coalesce(F.sum("n"), F.lit(0))
    counted = firsts.observe(before, n.alias("received"))
    fresh = unvisited(counted, visited).observe(
        after, n.alias("unvisited"), F.count(F.lit(1)).alias("kept")
    )
    return fresh.select("record.*"), (before, after)
