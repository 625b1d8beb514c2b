"""Database changes to order messages and rows."""

import json

import pytest

from daytally.operators import changes
from daytally.operators.measures import order_hour_compare, order_hours, order_total
from tests.conftest import rows


def envelope(*images, entry="ROWDATA", schema="shop", table="order_info", event="INSERT"):
    return json.dumps(
        {
            "entryType": entry,
            "schemaName": schema,
            "tableName": table,
            "eventType": event,
            "rowDatas": [
                {"afterColumns": [{"name": name, "value": value} for name, value in image]}
                for image in images
            ],
        }
    )


def messages(frame, subscription="shop.*"):
    found = changes.order_messages(changes.envelopes(frame), subscription)
    direct = changes.order_messages_of_lines(frame, subscription)
    values = sorted(row["value"] for row in found.collect())
    assert values == sorted(row["value"] for row in direct.collect())
    return values


def test_repeated_column_keeps_last_value(lines):
    assert messages(lines(envelope([("id", "1"), ("x", "a"), ("id", "2")]))) == ['{"id":"2","x":"a"}']


def test_null_value_becomes_empty_text(lines):
    assert messages(lines(envelope([("id", None)]))) == ['{"id":""}']


def test_every_row_of_an_envelope_is_a_message(lines):
    assert messages(lines(envelope([("id", "1")], [("id", "2")]))) == ['{"id":"1"}', '{"id":"2"}']


def test_row_without_columns(lines):
    assert messages(lines(envelope([]))) == ["{}"]


@pytest.mark.parametrize(
    "other",
    [
        {"event": "UPDATE"},
        {"event": "DELETE"},
        {"table": "user_info"},
        {"schema": "other"},
        {"entry": "TRANSACTIONBEGIN"},
    ],
)
def test_everything_else_is_dropped(lines, other):
    assert messages(lines(envelope([("id", "1")], **other), "broken", "")) == []


def test_escaped_names_are_found(lines):
    text = envelope([("id", "1")]).replace("order_info", "\\u006frder_info")
    assert "order_info" not in text
    assert messages(lines(text)) == ['{"id":"1"}']


def test_subscription_matches_the_whole_name(lines):
    frame = lines(envelope([("id", "1")], schema="myshop"))
    assert messages(frame, "shop.*") == []
    assert messages(frame, ".*shop.order_info") == ['{"id":"1"}']


def test_order_rows(lines):
    frame = lines(
        '{"id":"7","total_amount":"12.50","create_time":"2024-01-15 09:30:00"}',
        '{"id":"8","total_amount":"","create_time":""}',
        "broken",
    )
    assert rows(changes.order_rows(frame)) == [("7", "2024-01-15", "09", 12.5)]
    assert rows(changes.order_rejects(frame)) == [
        ("broken", "malformed"),
        ('{"id":"8","total_amount":"","create_time":""}', "bad time"),
    ]


@pytest.mark.parametrize(
    ("message", "reason"),
    [
        ('{"id":"1","total_amount":"x","create_time":"2024-01-15 09"}', "bad amount"),
        ('{"id":"1","total_amount":"NaN","create_time":"2024-01-15 09"}', "bad amount"),
        ('{"id":"1","create_time":"2024-01-15 09"}', "bad amount"),
        ('{"id":"1","total_amount":"1","create_time":"2024-13-15 09"}', "bad time"),
        ('{"id":"1","total_amount":"1","create_time":"2024-01-15 24"}', "bad time"),
        ('{"id":"","total_amount":"1","create_time":"2024-01-15 09"}', "no id"),
        ('{"total_amount":"1","create_time":"2024-01-15 09"}', "no id"),
        ('{"id":"1"}] lost', "malformed"),
    ],
)
def test_order_rejects(lines, message, reason):
    frame = lines(message)
    assert changes.order_rows(frame).count() == 0
    assert rows(changes.order_rejects(frame)) == [(message, reason)]


def test_change_rejects(lines):
    good = envelope([("id", "1")])
    bad = ["broken", "", good + "] lost", good + "],[" + good]
    assert rows(changes.change_rejects(lines(good, *bad))) == sorted((line, "malformed") for line in bad)


def test_one_row_per_order(spark):
    frame = spark.createDataFrame(
        [("1", "2024-01-15", "09", 5.0), ("1", "2024-01-15", "09", 5.0), ("2", "2024-01-15", "09", 1.0)], ORDERS
    )
    assert rows(changes.single_orders(frame)) == [("1", "2024-01-15", "09", 5.0), ("2", "2024-01-15", "09", 1.0)]


ORDERS = "id string, create_date string, create_hour string, total_amount double"


def test_order_sums(spark):
    frame = spark.createDataFrame(
        [
            ("1", "2024-01-15", "09", 0.1),
            ("2", "2024-01-15", "09", 0.2),
            ("3", "2024-01-15", "10", 1.0),
            ("4", "2024-01-14", "10", 2.0),
            ("5", "2024-01-13", "10", 4.0),
        ],
        ORDERS,
    )
    assert rows(order_total(frame, "2024-01-15")) == [(1.3,)]
    assert rows(order_hours(frame, "2024-01-15")) == [("09", 0.3), ("10", 1.0)]
    assert order_hour_compare(frame, "2024-01-15").orderBy("create_hour").collect() == [
        ("09", 0.3, None),
        ("10", 1.0, 2.0),
    ]


def test_day_without_orders_has_no_amount(spark):
    frame = spark.createDataFrame([], ORDERS)
    assert rows(order_total(frame, "2024-01-15")) == [(None,)]
    assert rows(order_hours(frame, "2024-01-15")) == []
