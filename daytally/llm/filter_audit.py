"""What each filter of a chain removes, in every order of the filters, from one pass over the texts.

Five filters look at a document; it fails
A  with under 100 words (maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive),
B  when 100 * distinct words < 80 * words,
C  when 100 * characters in A-Z > 10 * code points,
D  when it holds any of ``#$%&*|``,
E  when a row with a smaller doc_id has the identical text, whether that row is removed or not.

A subset of the filters is a number of five bits. Each document becomes a 32-bit word whose bit S says
whether the document survives subset S: the truth table of "no filter of S fails", which is the
conjunction of one constant word for each failing filter. Positional popcounts of the words, taken in
tasks with carry-save adders, give for every part and label the survivors of all subsets; whatever an
order of the filters removes is a difference of two of those counts. So the texts are read once, and
what is shuffled for the counts is one row of 32 numbers for each task, part and label.

Only the digest of a text (SHA-256) is shuffled for filter E. A text with a third of all rows is
spread over SALTS keys, here and in the join that brings the smallest doc_id back.

Defined cases: a null text is empty (it fails A only, and E where it repeats); a null lang is the part
''; rows without doc_id are no copies of others and have no label, and others are no copies of them;
rows that share a doc_id are not each other's copies; a doc_id with several labels is good (toxic) if
one of them says so; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import tabled

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
# The thresholds and patterns of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
BREAK, SYMBOLS, CAPITALS = r"[\x20\x09-\x0D]+", "[#$%&*|]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Keys over which rows of one text are spread.
SALTS = 64

#: For each filter the word of the subsets that lack it: all that survive its failure.
LACKING = [sum(1 << s for s in range(SUBSETS) if not s >> i & 1) for i in range(len(FILTERS))]


def text_failures(text: Column, words: Column) -> list[Column]:
    """Whether a text fails A, B, C and D; ``words`` are its words."""
    count, length = F.size(words).cast("long"), F.length(text).cast("long")
    capitals = length - F.length(F.translate(text, CAPITALS, ""))
    return [
        count < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)).cast("long") < LEAST_DISTINCT * count,
        100 * capitals > MOST_CAPITALS * length,
        text.rlike(SYMBOLS),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, failed (bits A to D), digest of the text, and a salt; nothing is shuffled."""
    text = F.coalesce("text", F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    worded = plain.withColumn("words", F.array_remove(F.split("text", BREAK), ""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(F.col("text"), F.col("words")))]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed + bit
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    return worded.select("doc_id", "part", failed.alias("failed"), F.unhex(F.sha2("text", 256)).alias("digest"), salt.alias("salt"))


def with_copies(rows: DataFrame) -> DataFrame:
    """The rows with bit E set where a smaller doc_id has the same digest."""
    salted = rows.groupBy("digest", "salt").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    firsts = salted.groupBy("digest").agg(F.min("least").alias("first"), F.sum("n").alias("n")).where("n > 1")
    back = salted.select("digest", "salt").join(firsts.select("digest", "first"), "digest")
    found = rows.join(back, ["digest", "salt"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return found.select("doc_id", "part", (F.col("failed") + F.when(copy, SUBSETS // 2).otherwise(0)).alias("failed"), "salt")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with good and toxic; rows without doc_id are spread by their salt."""
    says = lambda name: F.coalesce(F.max(F.col(name) == 1), F.lit(False))
    named = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    flags = named.agg(says("quality").alias("good"), says("toxic").alias("toxic")).where("good or toxic")
    apart = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.col("salt")).otherwise(0))
    found = apart.join(flags.withColumn("salt", F.lit(0)), ["doc_id", "salt"], "left")
    return found.select("part", *[F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")], "failed")


def survival_word(failed: Column) -> Column:
    """The 32-bit word of surviving subsets, as a long."""
    word = F.lit((1 << SUBSETS) - 1).cast("long")
    for i, lacking in enumerate(LACKING):
        hit = failed.bitwiseAND(F.lit(1 << i)) != 0
        word = word.bitwiseAND(F.when(hit, F.lit(lacking)).otherwise(F.lit((1 << SUBSETS) - 1)).cast("long"))
    return word


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set.

    Carry-save adders take three words of one weight to a sum word of that weight and a carry word of
    twice the weight, until each weight has at most two words left, whose bits are then counted.
    """
    counts = np.zeros(SUBSETS, np.int64)
    level, weight = words.astype(np.uint32), 1
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c, rest = level[:third], level[third : 2 * third], level[2 * third : 3 * third], level[3 * third :]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, rest])
        counts += weight * (level[:, None] >> np.arange(SUBSETS, dtype=np.uint32) & np.uint32(1)).sum(axis=0, dtype=np.int64)
        level, weight = np.concatenate([*carries, np.empty(0, np.uint32)]), 2 * weight
    return counts


def survivors(rows: DataFrame) -> DataFrame:
    """part, good, toxic, and s0 to s31: documents that survive each subset of the filters."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (part, good, toxic), own in frame.groupby(["part", "good", "toxic"]):
                counts = positional_popcounts(own["word"].to_numpy())
                yield pd.DataFrame({"part": [part], "good": [good], "toxic": [toxic], "counts": [counts]})

    words = rows.select("part", "good", "toxic", survival_word(F.col("failed")).alias("word"))
    counted = words.mapInPandas(count, "part string, good boolean, toxic boolean, counts array<long>")
    sums = [F.sum(F.get("counts", F.lit(s))).alias(f"s{s}") for s in range(SUBSETS)]
    return counted.groupBy("part", "good", "toxic").agg(*sums)


def steps() -> list[dict]:
    """Every step of every order: its filter, and the subsets before and after it."""
    found = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, 1):
            name = "".join(FILTERS[j] for j in order)
            found.append({"filter_order": name, "step": step, "filter": i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    return found


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For every part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rows = tabled(measured(docs), "audit")
    counted = survivors(with_labels(with_copies(rows), labels))
    of = lambda s, condition: F.coalesce(F.sum(F.when(F.expr(condition), F.col(f"s{s}"))), F.lit(0))
    arrays = {"n": "true", "g": "good", "t": "toxic"}
    parts = counted.groupBy("part").agg(*[F.array(*[of(s, condition) for s in range(SUBSETS)]).alias(name) for name, condition in arrays.items()])
    lost = lambda name, before, after: F.get(name, before) - F.get(name, after)
    shares = []
    for i in range(len(FILTERS)):
        total = F.lit(0).cast("long")
        for s in range(SUBSETS):
            if not s >> i & 1:
                size = s.bit_count()
                total = total + factorial(size) * factorial(len(FILTERS) - 1 - size) * lost("n", F.lit(s), F.lit(s | 1 << i))
        shares.append(total)
    parts = parts.withColumn("shares", F.array(*shares))
    kinds = "array<struct<filter_order:string,step:int,filter:int,before:int,after:int>>"
    rows = parts.select("*", F.inline(F.from_json(F.lit(json.dumps(steps())), kinds)))
    own, everything = F.expr("shiftleft(1, filter)"), SUBSETS - 1
    removed = lost("n", F.col("before"), F.col("after"))
    return rows.select(
        "part",
        "filter_order",
        "step",
        F.get("n", F.col("after")).alias("kept"),
        removed.alias("removed"),
        (lost("n", F.lit(0), own) - removed).alias("redundant"),
        lost("n", F.lit(everything) - own, F.lit(everything)).alias("unique_fails"),
        lost("g", F.col("before"), F.col("after")).alias("good_lost"),
        lost("t", F.col("before"), F.col("after")).alias("toxic_lost"),
        F.get("shares", F.col("filter")).alias("shapley"),
    )
