"""Day tables with versions: batches count once, compaction switches at one moment."""

import pytest
from pyspark.sql import types as T

from daytally.sources import files, snapshots
from daytally.sources.snapshots import DayTable, bins
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.StringType())])


@pytest.fixture
def table(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "table"), SCHEMA, "day")


def some(spark, *pairs):
    return spark.createDataFrame(pairs, SCHEMA).coalesce(1)


def count_files(table):
    version = table.version()
    return {day: len(found) for day, found in table.files_of(version, version["days"]).items()}


def test_a_batch_counts_once(spark, table):
    assert table.read().count() == 0
    assert table.append(some(spark, (1, "a"), (2, "b")), "w", 0)
    assert not table.append(some(spark, (1, "a"), (2, "b")), "w", 0)
    assert table.append(some(spark, (3, "a")), "w", 1)
    assert table.append(some(spark, (4, "c")), "other", 0)
    assert rows(table.read()) == [(1, "a"), (2, "b"), (3, "a"), (4, "c")]
    assert rows(table.read("b", "b")) == [(2, "b")]
    assert table.days("b") == ["b", "c"]
    assert table.version()["number"] == 3


def test_reading_a_day_opens_its_files_alone(spark, table):
    for day in "abc":
        table.append(some(spark, (1, day)))
    paths = table.read("b", "b").inputFiles()
    assert len(paths) == 1 and "_day=b" in paths[0]


def test_compaction_keeps_rows_and_open_days(spark, table):
    for i in range(12):
        table.append(some(spark, (i, "a"), (i, "b"), (i, "z")))
    old = table.version()
    assert table.compact("z") == 22
    assert count_files(table) == {"a": 1, "b": 1, "z": 12}
    assert rows(table.read()) == sorted((i, day) for i in range(12) for day in "abz")
    # Whoever reads the version before goes on with its files, until they are removed.
    assert table.read(version=old).count() == 36
    assert table.compact("z") == 0
    assert table.vacuum(1) == 24
    assert rows(table.read()) == sorted((i, day) for i in range(12) for day in "abz")
    assert len(table.versions()) == 1
    assert table.append(some(spark, (99, "a"))) and table.read("a", "a").count() == 13


def test_files_of_the_target_size(spark, table):
    for i in range(9):
        table.append(some(spark, (i, "a")))
    size = table.files_of(table.version(), ["a"])["a"][0]["bytes"]
    table.compact("z", 3 * size + 10)
    assert count_files(table) == {"a": 3}
    assert table.read().count() == 9


def test_crash_between_rewrite_and_switch(spark, table, monkeypatch):
    for i in range(4):
        table.append(some(spark, (i, "a")))
    real = files.put_text

    def lost(session, path, text):
        if "/versions/" in path:
            raise OSError("lost")
        real(session, path, text)

    monkeypatch.setattr(snapshots.files, "put_text", lost)
    with pytest.raises(OSError):
        table.compact("z")
    with pytest.raises(OSError):
        table.append(some(spark, (9, "a")), "w", 0)
    monkeypatch.setattr(snapshots.files, "put_text", real)
    assert count_files(table) == {"a": 4}
    assert rows(table.read()) == [(i, "a") for i in range(4)]
    assert table.append(some(spark, (9, "a")), "w", 0)
    assert table.compact("z") == 4 and table.vacuum(1) == 7
    assert rows(table.read()) == [(0, "a"), (1, "a"), (2, "a"), (3, "a"), (9, "a")]


def test_a_backlog_of_batches(spark, table):
    table.append(some(spark, (0, "a")), "w", 0)
    backlog = spark.createDataFrame([(i, "ab"[i % 2], i % 5) for i in range(20)], "id long, day string, batch int")
    assert table.append_batches(backlog, "batch", "w") == 4
    assert table.append_batches(backlog, "batch", "w") == 0
    assert table.version()["writers"] == {"w": 4} and len(table.versions()) == 5
    assert rows(table.read()) == sorted([(0, "a"), *((i, "ab"[i % 2]) for i in range(20) if i % 5)])


def test_replace_days(spark, table):
    table.append(some(spark, (1, "a"), (2, "b"), (3, "c")))
    assert table.replace(some(spark, (7, "a"), (8, "c")), ["a", "b"], "m", 4)
    assert not table.replace(some(spark, (9, "a")), ["a"], "m", 4)
    assert rows(table.read()) == [(3, "c"), (7, "a")]


@pytest.mark.parametrize("sizes", [[], [5], [9, 9, 9], [1] * 100, [10, 11, 3, 3, 4, 7, 7], [0, 0]])
def test_bins(sizes):
    found = bins(sizes, 10)
    assert sorted(i for group in found for i in group) == list(range(len(sizes)))
    assert all(len(group) == 1 or sum(sizes[i] for i in group) <= 10 for group in found)
    assert len(found) <= 2 * sum(min(s, 10) for s in sizes) / 10 + 1
