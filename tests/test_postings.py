"""Ranked search: scores against a plain count of words, pages, days put in again, and what a search reads."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daytally.functions.text import has_all_words
from daytally.sources.postings import B, K1, Postings, lines_of

SCHEMA = "key bigint, side string, dt string, sku_name string"
KEY = ("key", "side")
TWO = StructType().add("key", "long").add("side", "string")
DAY, NEXT = "2024-01-01", "2024-01-02"


def some_lines(count, seed, day):
    draw = random.Random(seed)
    names = ["red", "ring", "Blue", "café", "small", "box"]
    found = [(i, "ab"[i % 2], day, draw.choice([" ", "-", ", "]).join(draw.choices(names, k=draw.randint(1, 9)))) for i in range(count)]
    return found + [(-1, "a", day, None), (-2, "a", day, ""), (-3, "a", day, " - ")]


def split(name):
    cleaned = "".join(c if c.isalnum() else " " for c in (name or "").lower())
    return cleaned.split()


def by_hand(lines, day, keyword):
    """(score, key, side) of the hits, best first."""
    docs = [(key, side, split(name)) for key, side, dt, name in lines if dt == day and split(name)]
    wanted = sorted(set(split(keyword)))
    if not docs or not wanted:
        return []
    mean = sum(len(words) for *_, words in docs) / len(docs)
    df = {word: sum(word in words for *_, words in docs) for word in wanted}
    found = []
    for key, side, words in docs:
        if all(word in words for word in wanted):
            score = 0.0
            for word in wanted:
                tf, rarity = words.count(word), math.log(1 + (len(docs) - df[word] + 0.5) / (df[word] + 0.5))
                score += rarity * tf / (tf + K1 * (1 - B + B * len(words) / mean))
            found.append((-round(score, 6), key, side))
    return [(-score, key, side) for score, key, side in sorted(found)]


def told(frame):
    return [(row["score"], row["key"], row["side"]) for row in frame.collect()]


def same(found, expected):
    assert [hit[1:] for hit in found] == [hit[1:] for hit in expected]
    assert [hit[0] for hit in found] == pytest.approx([hit[0] for hit in expected], abs=1.1e-6)


@pytest.fixture(scope="module")
def data():
    return some_lines(300, 1, DAY) + some_lines(80, 2, NEXT)


@pytest.fixture(scope="module")
def table(spark, data, tmp_path_factory):
    made = Postings(spark, str(tmp_path_factory.mktemp("postings")), TWO)
    made.add(spark.createDataFrame(data, SCHEMA))
    return made


@pytest.mark.parametrize("day, keyword", [(DAY, "red ring"), (DAY, "RING-ring"), (NEXT, "Café blue, small"), (DAY, "box")])
def test_scores_equal_a_plain_count(table, data, day, keyword):
    expected = by_hand(data, day, keyword)
    hits = table.hits(day, keyword)
    assert expected
    same(told(table.page(hits, 1, 1000)), expected)


def test_hits_are_those_of_the_unranked_search(spark, table, data):
    lines = spark.createDataFrame(data, SCHEMA)
    plain = lines.where((F.col("dt") == DAY) & has_all_words(F.col("sku_name"), F.lit("red box")))
    assert sorted(row["key"] for row in plain.collect()) == sorted(row["key"] for row in table.hits(DAY, "red box").collect())


@pytest.mark.parametrize("day, keyword", [(DAY, ""), (DAY, " - "), (DAY, "red missing"), ("2024-02-01", "red")])
def test_nothing_matches(table, day, keyword):
    hits = table.hits(day, keyword)
    assert hits.collect() == []
    assert hits.columns == [*KEY, "score"]


def test_pages_by_number_and_by_last_hit(spark, table, data):
    hits, every = table.hits(DAY, "red"), by_hand(data, DAY, "red")
    walked, page = [], told(table.page(hits, 1, 7))
    while page:
        walked += page
        page = told(table.page_after(hits, page[-1], 7))
    same(walked, every)
    same(told(table.page(hits, 3, 7)), every[14:21])
    whole = lines_of(table.page(hits, 1, 7), spark.createDataFrame(data, SCHEMA), KEY)
    assert {row["key"] for row in whole.collect()} == {key for _, key, _ in every[:7]}
    assert whole.columns == ["key", "side", "dt", "sku_name", "score"]


def test_a_day_put_in_again_replaces_itself_alone(spark, data, tmp_path):
    made = Postings(spark, str(tmp_path / "p"), TWO)
    made.add(spark.createDataFrame(data, SCHEMA))
    again = some_lines(40, 3, NEXT)
    for _ in range(2):
        made.add(spark.createDataFrame(again, SCHEMA))
    same(told(made.page(made.hits(NEXT, "red"), 1, 1000)), by_hand(again, NEXT, "red"))
    same(told(made.page(made.hits(DAY, "red"), 1, 1000)), by_hand(data, DAY, "red"))


def test_an_empty_table(spark, tmp_path):
    made = Postings(spark, str(tmp_path / "p"), TWO)
    made.add(spark.createDataFrame([], SCHEMA))
    assert made.hits(DAY, "red").collect() == []


def test_a_common_word_with_a_very_long_name(spark, tmp_path):
    long = [(i, "a", DAY, "red " * 3) for i in range(2000)] + [(5000, "b", DAY, "red " * 20_000 + "ring")]
    made = Postings(spark, str(tmp_path / "p"), TWO)
    made.add(spark.createDataFrame(long, SCHEMA))
    same(told(made.page(made.hits(DAY, "red ring"), 1, 10)), by_hand(long, DAY, "red ring"))
    same(told(made.page(made.hits(DAY, "red"), 1, 5)), by_hand(long, DAY, "red")[:5])


def test_a_search_reads_its_day_and_words_only(table):
    hits = table.hits(DAY, "red ring")
    plan = table.page(hits, 1, 10)._jdf.queryExecution().executedPlan().toString()
    assert "In(word, [red,ring])" in plan
    assert "PartitionFilters: [isnotnull(dt" in plan and f"= {DAY})" in plan
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
