"""JSON log lines: reading, time-stamping and routing.

A record is a line that holds exactly one JSON object. The line is wrapped in
brackets together with a closing mark before it is parsed, so that anything else
(broken text, a bare number, trailing garbage, two objects, a bracket that ends the
array early) shows in the array that comes out: the object first, the mark with the
line's checksum second, and nothing else. The array is unpacked by a generator: no
later use or filter can make Spark parse again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STARTUP = "startup"
EVENT = "event"
ORDER = "order"
MALFORMED = "malformed"

# The name of the closing mark's only field.
MARK = "line checksum"

# The fields of a line as text, and with their JSON types.
TEXT_FIELDS = "map<string,string>"
TYPED_FIELDS = "map<string,variant>"


def _one_object(lines: DataFrame, object_type: T.StructType | str) -> DataFrame:
    """Add ``record``, the line's object, or NULL for a line that is not just one.

    A struct type gets the mark's field too, which callers leave out.
    """
    checksum = F.crc32(F.col("value").cast("binary")).cast("string")
    if isinstance(object_type, str):
        array_type = f"array<{object_type}>"
        mark = F.try_element_at(F.get("objects", F.lit(1)), F.lit(MARK))
    else:
        array_type = T.ArrayType(T.StructType([*object_type.fields, T.StructField(MARK, T.StringType())]))
        mark = F.get("objects", F.lit(1))[MARK]
    closing = F.concat(F.lit(f',{{"{MARK}":"'), checksum, F.lit('"}]'))
    text = F.concat(F.lit("["), F.col("value"), closing)
    parsed = lines.withColumn("objects", F.from_json(text, array_type))
    whole = (F.size("objects") == 2) & (mark == checksum)
    single = F.when(whole, F.slice("objects", 1, 1))
    return parsed.select(*lines.columns, F.explode_outer(single).alias("record"))


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """All lines with the columns of ``schema`` and ``readable``, whether they hold one object."""
    found = _one_object(lines, schema)
    fields = [F.col("record")[name].alias(name) for name in schema.fieldNames()]
    return found.select(*lines.columns, *fields, F.col("record").isNotNull().alias("readable"))


def parse_records(lines: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """``value`` JSON lines to typed columns; malformed lines give no row."""
    found = parse_lines(lines.select(*keep, "value"), schema).where("readable")
    return found.select(*keep, *schema.fieldNames())


def parse_objects(lines: DataFrame) -> DataFrame:
    """Add ``record``, the line's fields as text, NULL if malformed."""
    return _one_object(lines, TEXT_FIELDS)


def malformed(lines: DataFrame) -> DataFrame:
    """The lines that hold no JSON object, unchanged."""
    bad = parse_objects(lines).where(F.col("record").isNull())
    return bad.select(*lines.columns)


def _tidy(record: Column) -> Column:
    """True when every field name occurs once."""
    names = F.map_keys(record)
    return F.size(F.array_distinct(names)) == F.size(names)


def text_field(record: Column, name: str) -> Column:
    """A top-level field as text; the last one counts if the name is repeated."""
    same = F.filter(F.map_entries(record), lambda entry: entry["key"] == name)
    last = F.try_element_at(same, F.lit(-1))["value"]
    return F.when(_tidy(record), F.try_element_at(record, F.lit(name))).otherwise(last)


def _last_wins(record: Column) -> Column:
    entries = F.map_entries(record)
    last = F.transform(
        F.array_distinct(F.map_keys(record)),
        lambda name: F.element_at(F.filter(entries, lambda entry: entry["key"] == name), -1),
    )
    return F.map_from_entries(last)


def stamp(parsed: DataFrame, clock: Column) -> DataFrame:
    """Set ``ts`` to ``clock`` in the ``value`` of parsed lines, replacing any client ``ts``.

    Other fields keep their types and a malformed line stays as it is. A line
    without a ``ts`` is extended as text. Only where a field must go is the line
    read with its types and written anew.
    """
    record, value, typed = F.col("record"), F.col("value"), F.col("typed")
    extensible = (
        _tidy(record)
        & (F.size(record) > 0)
        & ~F.map_contains_key(record, "ts")
        & value.endswith("}")
    )
    marked = parsed.withColumn("extensible", F.coalesce(extensible, F.lit(False)))
    read = marked.withColumn(
        "typed",
        F.when(record.isNotNull() & ~F.col("extensible"), F.from_json(value, TYPED_FIELDS)),
    )
    moment = clock.cast("string")
    head = F.left(value, F.length(value) - 1)
    extended = F.concat(head, F.lit(',"ts":'), moment, F.lit("}"))
    fields = F.when(_tidy(record), typed).otherwise(_last_wins(typed))
    others = F.map_filter(fields, lambda name, _: name != "ts")
    rebuilt = F.to_json(F.map_concat(others, F.create_map(F.lit("ts"), F.parse_json(moment))))
    stamped = (
        F.when(F.col("extensible"), extended).when(typed.isNotNull(), rebuilt).otherwise(value)
    )
    return read.withColumn("value", stamped).drop("extensible", "typed")


def topic_of(kind: Column) -> Column:
    """Startup records go to their own topic, every other record to events."""
    return F.when(kind.eqNullSafe(F.lit(STARTUP)), STARTUP).otherwise(EVENT)
