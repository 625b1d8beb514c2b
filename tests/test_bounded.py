"""Startups in any order, with state for a few days, against the batch operator."""

import random

import pytest

from daytally import schemas, settings
from daytally.operators.devices import first_per_device
from daytally.operators.ingest import startup_records
from daytally.sources.snapshots import DayTable
from daytally.streaming import bounded
from tests.conftest import rows
from tests.test_streams import DAY, DRAIN, HOUR, START, Topic, startup


@pytest.fixture
def session(spark):
    return settings.stream_session(spark, 2)


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "in")


def run(session, topic, home, keep_days):
    query = bounded.bounded_device_stream(topic.stream(session), f"{home}/c", f"{home}/table", f"{home}/late", keep_days, DRAIN)
    query.awaitTermination()
    return query


def tables(session, home):
    return [DayTable(session, f"{home}/{name}", schemas.DAU, "logdate").read() for name in ("table", "late")]


def test_an_earlier_startup_replaces_a_later_one(session, topic, tmp_path):
    topic.drop(startup("m1", START + 5 * HOUR), startup("m1", START + 6 * HOUR), "no json")
    topic.drop(startup("m1", START + 7 * HOUR), startup("m2", START + HOUR))
    topic.drop(startup("m1", START + 2 * HOUR))
    run(session, topic, tmp_path, 2)
    found, late = tables(session, tmp_path)
    assert late.count() == 0
    assert rows(found.select("mid", "ts")) == [("m1", START + 2 * HOUR), ("m1", START + 5 * HOUR), ("m2", START + HOUR)]
    assert rows(first_per_device(found).select("mid", "loghour")) == [("m1", "02"), ("m2", "01")]


def test_late_startups_are_kept_and_state_ends(session, topic, tmp_path):
    topic.drop(*(startup(f"m{i}", START + i) for i in range(20)))
    topic.drop(startup("new", START + 5 * DAY))
    topic.drop(startup("new", START + 5 * DAY + 1))
    query = run(session, topic, tmp_path, 2)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 20
    topic.drop(startup("m3", START + 1), startup("m99", START + 2), startup("m99", START + 1))
    run(session, topic, tmp_path, 2)
    found, late = tables(session, tmp_path)
    assert rows(late.select("mid", "ts")) == [("m3", START + 1), ("m99", START + 1)]
    assert found.count() == 21
    merged = first_per_device(found.union(late))
    assert rows(merged.where("mid in ('m3', 'm99')").select("mid", "ts")) == [("m3", START + 1), ("m99", START + 1)]


@pytest.mark.parametrize("keep_days", [0, 3])
def test_any_order_gives_the_batch_answer(session, topic, tmp_path, keep_days):
    pick = random.Random(keep_days)
    lines = [startup(f"m{pick.randint(0, 8)}", START + pick.randint(0, 8 * DAY)) for _ in range(150)]
    for at in range(0, 150, 30):
        topic.drop(*lines[at : at + 30])
    run(session, topic, tmp_path, keep_days)
    found, late = tables(session, tmp_path)
    assert late.count() > 0
    want = first_per_device(startup_records(session.createDataFrame([(x,) for x in lines], "value string")))
    columns = schemas.DAU_COLUMNS
    assert repr(rows(first_per_device(found.union(late)).select(columns))) == repr(rows(want.select(columns)))


def test_steps_of_the_state_are_slices_and_not_devices(session, topic, tmp_path):
    topic.drop(*(startup(f"m{i}", START + 2 * HOUR + i) for i in range(400)))
    topic.drop(*(startup(f"m{i}", START + HOUR + i if i % 2 else START + 3 * HOUR) for i in range(300, 500)))
    query = run(session, topic, tmp_path, 2)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= bounded.SLICES
    found, late = tables(session, tmp_path)
    assert late.count() == 0
    assert found.count() == 400 + 50 + 100
    assert first_per_device(found).where("loghour = '01'").count() == 100
