import hashlib

import pytest
from pyspark.sql import functions as F

from daytally.llm import chunk_dedup

LONG = "some words and then a line\nof others, " * 3000


def brute(rows):
    out = []
    for doc, text in rows:
        same = [d for d, t in rows if (t or "") == (text or "")]
        keep = max((d for d in same if d is not None), default=None)
        out.append((doc, keep, len(same), doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (1, "a text"), (2, "a text"), (3, "a text "), (4, ""), (5, None), (6, LONG), (7, LONG + "x"), (8, LONG),
    (8, LONG), (9, "é" * 20_000), (10, "e" * 20_000), (11, "A text"), (None, "a text"), (None, "alone"), (12, "\x00퟿"),
]


def found(frame):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("fingerprint", [F.xxhash64, lambda chunk: F.length(chunk).cast("long")])
def test_matches_brute_force_whatever_the_fingerprint(spark, fingerprint):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert found(chunk_dedup.exact_groups(docs, fingerprint)) == brute(ROWS)


def test_clashing_chunks_of_one_length(spark):
    rows = [(i, letter * 600) for i, letter in enumerate("abcab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(chunk_dedup.exact_groups(docs, lambda chunk: F.length(chunk).cast("long"))) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, recipe int, kept string")
    assert chunk_dedup.exact_groups(docs).count() == 0
    docs = spark.createDataFrame([(1, "t", 3, "x"), (2, "t", 4, None)], "doc_id long, text string, recipe int, kept string")
    assert [tuple(r) for r in chunk_dedup.drop_copies(docs).collect()] == [(2, "t", 4, None)]


def test_chunks_join_to_the_text_and_survive_an_insertion(spark):
    text = " ".join(f"{'bcdfgh'[i * 7919 % 997 % 6]}ord{'nrstaeiou'[i * 31 % 89 % 9]}" for i in range(8000))
    docs = spark.createDataFrame([(text,), ("intro " + text,)], "text string")
    (first,), (second,) = docs.select(chunk_dedup.chunks_of(F.col("text"))).collect()
    assert "".join(first) == text and len(first) > 20
    assert len(set(first) & set(second)) > len(first) / 2


def test_native_plan(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = chunk_dedup.exact_groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
