"""Row images of database change records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_image(columns: Column) -> Column:
    """Array of (name, value) to a map of strings.

    A repeated name keeps its last value and a NULL value becomes an empty text,
    whatever the session's policy for duplicate map keys is. Rows without a repeated
    name, nearly all, take one pass over their columns.
    """
    listed = F.coalesce(columns, F.array().cast("array<struct<name:string,value:string>>"))
    full = F.transform(
        listed, lambda c: F.struct(c["name"].alias("name"), F.coalesce(c["value"], F.lit("")).alias("value"))
    )
    names = F.transform(listed, lambda c: c["name"])

    def last(name: Column) -> Column:
        return F.element_at(F.filter(full, lambda c: c["name"] == name), -1)

    single = F.size(F.array_distinct(names)) == F.size(names)
    return F.map_from_entries(F.when(single, full).otherwise(F.transform(F.array_distinct(names), last)))
