"""Streams fed file by file, compared with the batch operators."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from daytally import settings
from daytally.functions.logs import EVENT, MALFORMED, ORDER, STARTUP
from daytally.operators import devices
from daytally.operators.ingest import startup_records
from daytally.sources import tables, topics
from daytally.streaming.collect import collect_logs, keep_raw_log
from daytally.streaming.devices import device_stream, late_devices
from daytally.streaming.orders import order_stream, publish_orders
from tests.conftest import rows
from tests.test_changes import envelope

HOUR = 3_600_000
DAY = 24 * HOUR
START = 1705276800000  # 2024-01-15 00:00 UTC
DRAIN = {"availableNow": True}


class Topic:
    """A folder that receives one file after the other."""

    def __init__(self, root, name=STARTUP):
        self.root, self.name, self.number = str(root), name, 0
        os.makedirs(f"{root}/topic={name}")

    def drop(self, *texts):
        path = f"{self.root}/topic={self.name}/{self.number:03d}.txt"
        with open(path, "w") as out:
            out.writelines(text + "\n" for text in texts)
        os.utime(path, (1_700_000_000 + self.number,) * 2)
        self.number += 1

    def stream(self, session):
        return topics.stream_topic(session, self.name, "text", self.root, maxFilesPerTrigger="1")


def startup(mid, ts):
    return json.dumps({"type": "startup", "mid": mid, "ts": ts})


@pytest.fixture
def session(spark):
    return settings.stream_session(spark, 3)


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "in")


def run_devices(session, topic, home, **options):
    query = device_stream(
        topic.stream(session), f"{home}/checkpoint", f"{home}/table", trigger=DRAIN, **options
    )
    query.awaitTermination()
    return query


def keys(frame):
    return rows(frame.select("mid", "logdate"))


@pytest.mark.parametrize("keep_days", [None, 3])
def test_repeats_within_and_across_batches(session, topic, tmp_path, keep_days):
    topic.drop(startup("m1", START + 1), startup("m1", START + 2), startup("m2", START + 3))
    topic.drop(startup("m1", START + 4), "not json", "", startup("m3", START + 5))
    topic.drop(startup("m1", START + 2 * DAY))
    topic.drop(startup("m4", START - 60_000), startup("m4", START + 60_000))
    run_devices(session, topic, tmp_path, keep_days=keep_days)
    assert keys(tables.read_dau(session, f"{tmp_path}/table")) == [
        ("m1", "2024-01-15"),
        ("m1", "2024-01-17"),
        ("m2", "2024-01-15"),
        ("m3", "2024-01-15"),
        ("m4", "2024-01-14"),
        ("m4", "2024-01-15"),
    ]


def random_drops(topic, count=4, size=400, seed=11):
    """Records in no time order; one device sends a third of them."""
    pick = random.Random(seed)
    for _ in range(count):
        topic.drop(
            *[
                startup("hot" if i % 3 == 0 else f"m{pick.randrange(60)}", START + pick.randrange(9 * DAY))
                for i in range(size)
            ]
        )


@pytest.mark.parametrize("rows_per_arrow_batch", ["10000", "7"])
def test_unordered_replay_equals_batch(session, topic, tmp_path, rows_per_arrow_batch):
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_arrow_batch)
    random_drops(topic)
    query = run_devices(session, topic, tmp_path, files_per_day=2)
    batch = startup_records(topics.read_topic(session, STARTUP, topic.root))
    table = tables.read_dau(session, f"{tmp_path}/table")
    assert keys(table) == keys(devices.first_per_device(batch))
    # Every stored row is one of the records that came in.
    assert table.exceptAll(batch).count() == 0
    counted = [progress.observedMetrics for progress in query.recentProgress]
    assert sum(c["startups"]["received"] for c in counted) == batch.count()
    assert sum(c["devices"]["kept"] for c in counted) == table.count()


def test_restart_goes_on_where_it_stopped(session, topic, tmp_path):
    topic.drop(startup("m1", START), startup("m2", START))
    run_devices(session, topic, tmp_path)
    topic.drop(startup("m1", START + 9), startup("m3", START + 9))
    run_devices(session, topic, tmp_path)
    run_devices(session, topic, tmp_path)
    assert [key[0] for key in keys(tables.read_dau(session, f"{tmp_path}/table"))] == ["m1", "m2", "m3"]


def test_heavy_device_is_thinned_out_before_the_shuffle(session, topic, tmp_path):
    """The state operator sees one row per Arrow batch of the device, not all."""
    topic.drop(*[startup("hot", START + i) for i in range(5000)], startup("m1", START))
    query = run_devices(session, topic, tmp_path)
    (batch,) = [p for p in query.recentProgress if p.numInputRows]
    dropped = sum(op.customMetrics["numDroppedDuplicateRows"] for op in batch.stateOperators)
    assert dropped < 10
    assert tables.read_dau(session, f"{tmp_path}/table").count() == 2


def test_old_days_leave_the_state(session, topic, tmp_path):
    for day in range(8):
        topic.drop(*[startup(f"m{i}", START + day * DAY + i) for i in range(50)])
    query = run_devices(session, topic, tmp_path, keep_days=2)
    assert tables.read_dau(session, f"{tmp_path}/table").count() == 400
    held = [sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress]
    assert max(held) <= 200


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_days_are_those_of_the_session_time_zone(session, topic, tmp_path, zone):
    session.conf.set("spark.sql.session.timeZone", zone)
    for day in range(3):
        topic.drop(*[startup("m1", START + day * DAY + hour * HOUR) for hour in range(24)])
    run_devices(session, topic, tmp_path, keep_days=2)
    batch = startup_records(topics.read_topic(session, STARTUP, topic.root))
    assert keys(tables.read_dau(session, f"{tmp_path}/table")) == keys(devices.first_per_device(batch))


def test_late_devices_are_counted_and_merged(session, topic, tmp_path):
    topic.drop(startup("m1", START), startup("m2", START))
    topic.drop(startup("m1", START + 10 * DAY))
    topic.drop(startup("m1", START + 10 * DAY + 1))  # the bound takes effect one batch later
    topic.drop(startup("late", START + 5), startup("m2", START + 6), startup("m5", START + 10 * DAY))
    query = run_devices(session, topic, tmp_path, keep_days=2)
    table = tables.read_dau(session, f"{tmp_path}/table")
    assert ("late", "2024-01-15") not in keys(table)
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 2
    raw = startup_records(topics.read_topic(session, STARTUP, topic.root))
    for _ in range(2):  # merging again adds nothing
        known = tables.read_dau(session, f"{tmp_path}/table")
        if os.path.exists(f"{tmp_path}/late"):
            known = tables.read_dau(session, f"{tmp_path}/table", f"{tmp_path}/late")
        tables.append_dau(late_devices(raw, known), f"{tmp_path}/late")
    both = tables.read_dau(session, f"{tmp_path}/table", f"{tmp_path}/late")
    assert keys(both) == keys(devices.first_per_device(raw))


def test_collected_lines_are_stamped_routed_and_logged(session, tmp_path):
    source = Topic(tmp_path / "in", "client")
    source.drop('{"type":"startup","mid":"m1","ts":1}', '{"mid":"m2"}', "not json", "")
    source.drop('{"type":"event","mid":"m3","itemid":7}')
    query = collect_logs(
        source.stream(session), f"{tmp_path}/c1", fmt="text", path=f"{tmp_path}/topics", trigger=DRAIN
    )
    query.awaitTermination()
    counted = [p.observedMetrics["collected"] for p in query.recentProgress]
    assert sum(c["received"] for c in counted) == 5
    assert sum(c["malformed"] for c in counted) == 2

    def stored(name):
        return [r["value"] for r in topics.read_topic(session, name, f"{tmp_path}/topics").collect()]

    (started,) = map(json.loads, stored(STARTUP))
    assert started["mid"] == "m1" and started["ts"] > START
    events = {e["mid"]: e for e in map(json.loads, stored(EVENT))}
    assert set(events) == {"m2", "m3"} and events["m3"]["itemid"] == 7
    assert sorted(stored(MALFORMED)) == ["", "not json"]

    lines = topics.stream_topic(session, STARTUP, "text", f"{tmp_path}/topics").union(
        topics.stream_topic(session, EVENT, "text", f"{tmp_path}/topics")
    )
    keep_raw_log(lines, f"{tmp_path}/c2", f"{tmp_path}/raw", DRAIN).awaitTermination()
    raw = session.read.schema("value string, logdate string").text(f"{tmp_path}/raw")
    assert sorted(r["value"] for r in raw.collect()) == sorted(stored(STARTUP) + stored(EVENT))
    assert raw.where(F.col("logdate") < "2024-01-15").count() == 0


def test_order_changes_become_messages_and_rows(session, tmp_path):
    source = Topic(tmp_path / "in", "changes")
    image = [("id", "1"), ("total_amount", "12.50"), ("create_time", "2024-01-15 09:00:01")]
    source.drop(envelope(image), envelope(image, event="UPDATE"), "broken")
    source.drop(envelope([("id", "2"), *image[1:]], image[:1]))
    publish_orders(
        source.stream(session), f"{tmp_path}/c1", "shop.*", fmt="text", path=f"{tmp_path}/topics", trigger=DRAIN
    ).awaitTermination()
    messages = topics.stream_topic(session, ORDER, "text", f"{tmp_path}/topics")
    order_stream(messages, f"{tmp_path}/c2", f"{tmp_path}/orders", DRAIN).awaitTermination()
    stored = {tuple(r) for r in tables.read_orders(session, f"{tmp_path}/orders").collect()}
    assert stored == {("1", "2024-01-15", "09", 12.5), ("2", "2024-01-15", "09", 12.5)}


def test_several_sinks_see_the_same_batch(session, topic, tmp_path):
    topic.drop("a", "b")
    topic.drop("c")
    tagged = topic.stream(session).withColumn("tag", F.expr("uuid()"))

    def to(name):
        def write(batch, number):
            batch.write.mode("overwrite").parquet(f"{tmp_path}/{name}/batch={number}")

        return write

    topics.write_batches(
        tagged, f"{tmp_path}/checkpoint", to("one"), to("two"), trigger=DRAIN
    ).awaitTermination()
    one, two = (session.read.parquet(f"{tmp_path}/{name}") for name in ("one", "two"))
    assert rows(one.select("value", "tag", "batch")) == rows(two.select("value", "tag", "batch"))
    assert one.count() == 3


def test_broker_source_is_a_setting(session):
    """No broker here: the request must get as far as the missing connector."""
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.stream_topic(session, STARTUP, **{"kafka.bootstrap.servers": "host:9092"})
