"""Keyword search, pages, facets and shares."""

import json
import random

import pytest
from pyspark.sql import functions as F

from daytally.functions.shares import age_band, percent
from daytally.functions.text import has_all_words
from daytally.operators import sales
from daytally.plans.sale_report import sale_report
from tests.conftest import rows

SCHEMA = "key bigint, dt string, sku_name string, user_gender string, user_age int"


@pytest.mark.parametrize(
    "name, keyword, expected",
    [
        ("Small RED ring", "red ring", True),
        ("Small RED ring", "ring, Red!", True),
        ("small redring", "red ring", False),
        ("red", "red ring", False),
        ("red-ring", "ring", True),
        ("Café Größe", "größe", True),
        ("red", "", False),
        ("red", " - ", False),
        ("", "red", False),
        ("red red", "red red", True),
    ],
)
def test_all_words(spark, name, keyword, expected):
    frame = spark.createDataFrame([(name,)], "name string")
    assert frame.select(has_all_words(F.col("name"), F.lit(keyword))).first()[0] is expected


def test_age_edges(spark):
    frame = spark.createDataFrame([("19",), ("20",), ("30",), ("31",), ("x",), (None,)], "age string")
    bands = [row[0] for row in frame.select(age_band(F.col("age"))).collect()]
    assert bands == ["under_20", "20_to_30", "20_to_30", "over_30", None, None]


@pytest.mark.parametrize("part, total, expected", [(1, 3, 33.3), (1, 16, 6.3), (1, 2000, 0.1), (0, 5, 0.0), (0, 0, None)])
def test_percent(spark, part, total, expected):
    frame = spark.createDataFrame([(part, total)], "part bigint, total bigint")
    assert frame.select(percent(F.col("part"), F.col("total"))).first()[0] == expected


def lines_of(spark, count=300, seed=5):
    pick = random.Random(seed)
    names = ["red ring", "red widget", "small ring", "ring of red"]
    return spark.createDataFrame(
        [
            (
                key,
                "d1" if pick.random() < 0.8 else "d2",
                pick.choice(names),
                pick.choice(["F", "M", None]),
                pick.choice([19, 20, 30, 31, None]),
            )
            for key in range(count)
        ],
        SCHEMA,
    )


def test_search_pages_and_facets_equal_brute_force(spark):
    frame = lines_of(spark)
    expected = [
        r for r in frame.collect() if r.dt == "d1" and {"red", "ring"} <= set(r.sku_name.split())
    ]
    hits = sales.search(frame, "d1", "ring red")
    assert rows(hits.select("key")) == sorted((r.key,) for r in expected)
    assert rows(sales.hit_count(hits)) == [(len(expected),)]
    keys = sorted(r.key for r in expected)
    for number in (1, 2, 3, 100):
        got = [r.key for r in sales.page(hits, ("key",), number, 7).collect()]
        assert got == keys[(number - 1) * 7 : number * 7]
    genders = dict(rows(sales.gender_terms(hits)))
    assert genders == {g: sum(r.user_gender == g for r in expected) for g in ("F", "M")}
    ages = dict(rows(sales.age_terms(hits)))
    assert ages == {a: sum(r.user_age == a for r in expected) for a in (19, 20, 30, 31)}
    bands = {row[0]: row[1] for row in sales.age_shares(hits).collect()}
    assert bands == {"under_20": ages[19], "20_to_30": ages[20] + ages[30], "over_30": ages[31]}


def test_walking_by_key_gives_the_same_pages(spark):
    hits = sales.search(lines_of(spark), "d1", "ring").select("sku_name", "key")
    order = ("sku_name", "key")
    whole = [tuple(r) for r in hits.orderBy(*order).collect()]
    walked, batch = [], [tuple(r) for r in sales.page(hits, order, 1, 50).collect()]
    while batch:
        walked += batch
        batch = [tuple(r) for r in sales.page_after(hits, order, batch[-1], 50).collect()]
    assert walked == whole


def test_facet_keeps_the_most_frequent(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,), (None,), (None,)], "g string")
    assert sales.terms(frame, "g", 2).collect() == [("b", 2), ("a", 1)]


def test_missing_gender_counts_as_zero(spark):
    frame = spark.createDataFrame([(1, "d", "x", "F", 25)], SCHEMA)
    assert rows(sales.gender_shares(frame)) == [("F", 1, 100.0), ("M", 0, 0.0)]


def test_shares_of_no_hits_are_null(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert rows(sales.gender_shares(frame)) == [("F", 0, None), ("M", 0, None)]


def test_report(spark):
    frame = lines_of(spark)
    (row,) = sale_report(frame, "d1", "red ring", 2, 5, ("key",)).collect()
    hits = sales.search(frame, "d1", "red ring")
    assert row["total"] == hits.count()
    page = [r.key for r in sales.page(hits, ("key",), 2, 5).collect()]
    assert [line["key"] for line in json.loads(row["detail"])] == page
    gender, age = json.loads(row["stat"])
    assert [option["name"] for option in gender["options"]] == ["男", "女"]
    assert [option["name"] for option in age["options"]] == ["20岁以下", "20岁到30岁", "30岁以上"]
    shares = {r.user_gender: r.ratio for r in sales.gender_shares(hits).collect()}
    assert [option["value"] for option in gender["options"]] == [shares["M"], shares["F"]]


def test_report_without_hits(spark):
    (row,) = sale_report(lines_of(spark), "d1", "nothing", 1, 5, ("key",)).collect()
    assert row["total"] == 0 and row["detail"] == "[]"
    assert {o["value"] for stat in json.loads(row["stat"]) for o in stat["options"]} == {0.0}
