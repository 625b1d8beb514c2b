"""Dates, key figures, hourly maps and the metric switch."""

import json

import pytest
from pyspark.sql import functions as F

from daytally.functions.calendar import day_before, day_of, hour_of
from daytally.plans import dashboard
from tests.conftest import rows

DEVICES = "logdate string, mid string, loghour string"
ORDERS = "id string, create_date string, create_hour string, total_amount double"


@pytest.mark.parametrize(
    "day, before",
    [
        ("2024-01-15", "2024-01-14"),
        ("2024-03-01", "2024-02-29"),
        ("2024-01-01", "2023-12-31"),
        ("2024-13-45", None),
        ("soon", None),
    ],
)
def test_day_before(spark, day, before):
    assert spark.range(1).select(day_before(F.lit(day))).first()[0] == before


@pytest.mark.parametrize(
    "ms, day, hour",
    [
        (0, "1970-01-01", "00"),
        (1705363199999, "2024-01-15", "23"),
        (1705363200000, "2024-01-16", "00"),
        (-1, "1969-12-31", "23"),
    ],
)
def test_day_and_hour(spark, ms, day, hour):
    assert tuple(spark.range(1).select(day_of(F.lit(ms)), hour_of(F.lit(ms))).first()) == (day, hour)


@pytest.fixture
def devices(spark):
    records = [("2024-01-15", f"m{i}", f"{i % 3:02d}") for i in range(7)]
    return spark.createDataFrame(records + [("2024-01-14", "m0", "05")], DEVICES)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([("1", "2024-01-15", "09", 2.5), ("2", "2024-01-14", "09", 1.0)], ORDERS)


def test_key_figures(devices):
    assert dashboard.key_figures(devices, "2024-01-15").collect() == [
        ("dau", "新增日活", 7),
        ("new_mid", "新增设备", 33333),
    ]
    assert dashboard.key_figures(devices, "2000-01-01").first()["value"] == 0


def test_measured_figures(spark, devices, orders):
    fresh = spark.createDataFrame([("2024-01-15", 3)], "logdate string, new_devices bigint")
    found = dashboard.measured_figures(devices, fresh, orders, "2024-01-15")
    assert {r.id: r.value for r in found.collect()} == {"dau": 7.0, "new_mid": 3.0, "order_amount": 2.5}
    nothing = dashboard.measured_figures(devices, fresh, orders, "2000-01-01")
    assert {r.id: r.value for r in nothing.collect()} == {"dau": 0.0, "new_mid": 0.0, "order_amount": None}


def test_figures_json(devices):
    text = dashboard.figures_json(dashboard.key_figures(devices, "2024-01-15")).first()["json"]
    assert json.loads(text) == [
        {"id": "dau", "name": "新增日活", "value": 7},
        {"id": "new_mid", "name": "新增设备", "value": 33333},
    ]


def test_hour_map(spark):
    compared = spark.createDataFrame(
        [("01", 3, None), ("00", 2, 5)], "loghour string, today bigint, yesterday bigint"
    )
    assert dashboard.hour_map(compared, "loghour").first()["json"] == (
        '{"today":{"00":2,"01":3},"yesterday":{"00":5}}'
    )
    assert dashboard.hour_map(compared.where("false"), "loghour").first()["json"] == (
        '{"today":{},"yesterday":{}}'
    )


def test_dispatch(devices, orders):
    metrics = dashboard.metric_hours(devices, orders)
    assert rows(dashboard.dispatch(metrics, "dau", "2024-01-15")) == [
        ("dau", "2024-01-14", "05", 1.0),
        ("dau", "2024-01-15", "00", 3.0),
        ("dau", "2024-01-15", "01", 2.0),
        ("dau", "2024-01-15", "02", 2.0),
    ]
    assert rows(dashboard.dispatch(metrics, "order_amount", "2024-01-15")) == [
        ("order_amount", "2024-01-14", "09", 1.0),
        ("order_amount", "2024-01-15", "09", 2.5),
    ]
    assert rows(dashboard.dispatch(metrics, "other", "2024-01-15")) == []
