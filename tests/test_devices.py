"""First record per device and day, against brute force and with a heavy device."""

import random

from pyspark.sql import functions as F

from daytally.operators import devices
from daytally.operators.measures import device_hour_compare, device_hours, device_total
from daytally.plans.batch import counted_step
from tests.conftest import rows

HOUR = 3_600_000
DAY = 24 * HOUR
START = 1705276800000  # 2024-01-15 00:00 UTC
SCHEMA = "mid string, ts bigint, note bigint"


def startups(spark, records):
    from daytally.functions.calendar import day_of, hour_of

    frame = spark.createDataFrame(records, SCHEMA)
    return frame.withColumns({"logdate": day_of(F.col("ts")), "loghour": hour_of(F.col("ts"))})


def heavy(count=6000, seed=1):
    """A third of all rows belong to one device."""
    pick = random.Random(seed)
    return [
        (
            "hot" if i % 3 == 0 else f"m{pick.randrange(400)}",
            START + pick.randrange(3 * DAY),
            i,
        )
        for i in range(count)
    ]


def brute_first(records):
    best = {}
    for mid, ts, note in records:
        key = (ts // DAY, mid)
        if key not in best or (ts, note) < best[key]:
            best[key] = (ts, note)
    return {(mid, ts, note) for (_, mid), (ts, note) in best.items()}


def test_first_per_device_equals_brute_force(spark):
    records = heavy()
    found = devices.first_per_device(startups(spark, records), ("ts", "note"))
    assert {(r.mid, r.ts, r.note) for r in found.collect()} == brute_first(records)
    assert found.count() == len(brute_first(records))


def test_first_seen_agrees_with_whole_records(spark):
    frame = startups(spark, heavy())
    whole = devices.first_per_device(frame, ("ts", "note")).select("logdate", "mid", "ts", "loghour")
    assert rows(devices.first_seen(frame)) == rows(whole)


def test_midnight_span_gives_two_rows(spark):
    frame = startups(spark, [("m1", START - 60_000, 0), ("m1", START + 60_000, 1), ("m1", START + 5, 2)])
    assert rows(devices.first_seen(frame).select("logdate", "mid")) == [
        ("2024-01-14", "m1"),
        ("2024-01-15", "m1"),
    ]


def test_unvisited_looks_at_the_records_own_day(spark):
    frame = startups(spark, [("m1", START, 0), ("m1", START + DAY, 1), ("m2", START, 2)])
    visited = spark.createDataFrame([("2024-01-15", "m1")], "logdate string, mid string")
    assert rows(devices.unvisited(frame, visited).select("mid", "logdate")) == [
        ("m1", "2024-01-16"),
        ("m2", "2024-01-15"),
    ]


def test_step_order_does_not_matter(spark):
    records = heavy(seed=2)
    frame = startups(spark, records)
    visited = frame.where(F.col("loghour") < "06").select(*devices.KEY).distinct()
    late = frame.where(F.col("loghour") >= "06")
    reduced_first = devices.new_on_day(late, visited, ("ts", "note"))
    filtered_first = devices.first_per_device(devices.unvisited(late, visited), ("ts", "note"))
    assert rows(reduced_first.select("mid", "ts", "note")) == rows(filtered_first.select("mid", "ts", "note"))


def test_counted_step(spark):
    frame = startups(spark, heavy(seed=3))
    visited = frame.where(F.col("loghour") < "06").select(*devices.KEY).distinct()
    late = frame.where(F.col("loghour") >= "06")
    step, (before, after) = counted_step(late, visited, ("ts", "note"))
    kept = rows(step.select("mid", "ts", "note"))
    fresh = devices.unvisited(late, visited)
    assert kept == rows(devices.first_per_device(fresh, ("ts", "note")).select("mid", "ts", "note"))
    assert before.get == {"received": late.count()}
    assert after.get == {"unvisited": fresh.count(), "kept": len(kept)}


def test_visited_union_has_no_repeats(spark):
    frame = startups(spark, heavy(seed=4))
    visited = spark.createDataFrame([("2024-01-15", "hot"), ("2020-01-01", "old")], "logdate string, mid string")
    merged = rows(devices.visited_union(visited, frame))
    assert merged == sorted({("2020-01-01", "old")} | {(r.logdate, r.mid) for r in frame.collect()})


def test_new_devices_count_first_days(spark):
    frame = startups(spark, [("m1", START, 0), ("m1", START + DAY, 1), ("m2", START + DAY, 2)])
    assert rows(devices.new_devices(frame)) == [("2024-01-15", 1), ("2024-01-16", 1)]


def test_empty_day(spark):
    frame = startups(spark, [("m1", START, 0)])
    assert rows(device_total(frame, "2024-02-01")) == [(0,)]
    assert rows(device_hours(frame, "2024-02-01")) == []


def test_hour_missing_on_one_day_is_null(spark):
    frame = startups(spark, [("m1", START, 0), ("m2", START - DAY + 5 * HOUR, 1), ("m3", START + HOUR, 2)])
    found = {row.loghour: (row.today, row.yesterday) for row in device_hour_compare(frame, "2024-01-15").collect()}
    assert found == {"00": (1, None), "01": (1, None), "05": (None, 1)}


def test_heavy_device_is_split_in_the_visited_join(spark, tmp_path):
    """Beyond the broadcast size, adaptive execution splits the heavy device."""
    frame = startups(spark, heavy(60_000))
    frame.write.parquet(f"{tmp_path}/log")
    visited = startups(spark, heavy(300, seed=9)).where("mid != 'hot'").select(*devices.KEY).distinct()
    visited.write.parquet(f"{tmp_path}/visited")
    session = spark.newSession()
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "50",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }.items():
        session.conf.set(key, value)
    log = session.read.parquet(f"{tmp_path}/log").repartition(8)
    seen = session.read.parquet(f"{tmp_path}/visited")
    found = devices.unvisited(log, seen)
    got = found.count()
    query = found.select("mid", "logdate", "ts")
    collected = query.collect()
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    keys = {(r.logdate, r.mid) for r in seen.collect()}
    assert got == len(collected) == sum((r.logdate, r.mid) not in keys for r in frame.collect())
