"""The first-seen table: day by day equal to the whole history, no shuffle of history, one day read."""

import random
import re

import pytest

from daytally.operators.devices import new_devices
from daytally.sources import first_seen
from daytally.sources.first_seen import FirstSeen
from tests.conftest import rows

DAYS = [f"2024-01-{day:02d}" for day in range(1, 8)]


@pytest.fixture
def table(spark, tmp_path):
    return FirstSeen(spark, str(tmp_path / "seen"), 4)


def history(spark, seed, count=300):
    pick = random.Random(seed)
    return spark.createDataFrame([(f"m{pick.randint(0, 80)}", pick.choice(DAYS)) for _ in range(count)], "mid string, logdate string")


def firsts(startups):
    return rows(startups.groupBy("mid").agg({"logdate": "min"}))


@pytest.mark.parametrize("order", [DAYS, DAYS[::-1], random.Random(1).sample(DAYS, 7)])
def test_days_in_any_order(spark, table, order):
    startups = history(spark, 5)
    for day in order:
        table.add_day(startups, day)
    assert rows(table.table().select("mid", "logdate")) == firsts(startups)
    table.add_day(startups, DAYS[2])
    assert rows(table.table().select("mid", "logdate")) == firsts(startups)


def test_loaded_and_continued(spark, table):
    startups = history(spark, 6, 60)
    table.load(startups.where(f"logdate <= '{DAYS[3]}'"))
    for day in DAYS[4:]:
        table.add_day(startups, day)
    assert rows(table.table().select("mid", "logdate")) == firsts(startups)
    counts = {day: first_seen.new_devices(table, day).first()["new_devices"] for day in DAYS}
    stamped = startups.selectExpr("mid", "unix_millis(to_timestamp(logdate)) as ts")
    assert {day: n for day, n in counts.items() if n} == dict(rows(new_devices(stamped)))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_history_is_not_shuffled_and_one_day_is_read(spark, table):
    startups = history(spark, 7)
    table.load(startups.where(f"logdate < '{DAYS[5]}'"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(table.fresh(startups, DAYS[5]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = plan.index("first_seen_")
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    # Between the join and the history's scan there is a sort, and no exchange.
    join = max(plan.rfind(name, 0, scan) for name in ("+- *(", ":- *("))
    assert "Exchange" not in plan[join:scan]
    assert plan.count("Exchange") <= 2
    read = table.day(DAYS[1])
    assert len({path.split("logdate=")[1][:10] for path in read.inputFiles()}) == 1
    assert re.search(rf"PartitionFilters: .*logdate#[0-9]+ = {DAYS[1]}", plan_of(read))
